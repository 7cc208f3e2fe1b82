"""The sentences of incidents and fixes, which must equal the reference's wording.

%s and %d stand for names and counts that the operators fill in.
"""

# pattern -> (root cause, suggested fix)
INCIDENTS = {
    "Tool Timeout Loop": (
        "%s failed %d times in %s agent. Error: %s",
        "Add max_retries=2 and timeout=10s to %s in the %s agent tool configuration. "
        "Consider exponential backoff between retries."),
    "Empty Result Loop": (
        "%s called %d times successfully but produced no actionable output (0 trades). "
        "Tool may be returning empty or low-quality results.",
        "Add result quality validation after %s calls. If result is empty or below quality "
        "threshold, fail fast rather than retrying with same parameters."),
    "Hyperactive Polling Loop": (
        "%s called %d times successfully by %s agent. Agent is polling without reaching a decision threshold. "
        "Total time in tool calls: %sms.",
        "Add a max_iterations cap to %s agent's %s loop (e.g. max_calls=3). Force a decision step "
        "once the cap is hit. Consider caching results between calls to avoid redundant fetches."),
    "Context Spiral": (
        "%s agent consumed %s tokens with 0 trades produced. Agent gathered context without reaching a decision.",
        "Add a hard token budget to the %s agent (e.g. max_tokens=%d). Force a decision step if "
        "budget is reached without a recommendation."),
    "Pipeline Break": (
        "%s agent completed but %s never started. Last %s step: %s (outcome: %s)",
        "Check for uncaught exceptions between %s and %s steps. Add try/except around the "
        "%s -> %s handoff. Ensure %s agent errors are propagated, not silently swallowed."),
    "Silent Exit": (
        "Session ended with 0 trades and no terminal reason logged. No tool errors detected. "
        "Likely a logic path that skips both trade entry and explicit rejection.",
        "Add explicit terminal_reason logging for all exit paths in the orchestrator (e.g. 'no_opportunity', "
        "'risk_rejected', 'market_closed'). Every session should record why it ended."),
    "Tool Call Fabrication": (
        "%d tool call(s) completed in under %sms with success status. External API calls take 100ms+. "
        "Affected agents: %s. Tools: %s.",
        "Verify that tool calls are making real external requests. Add response validation: check that tool "
        "output is consistent with what the actual API returns (schema, latency, value ranges). "
        "Enable request logging in tool wrappers to confirm HTTP calls are made."),
    "Cost Anomaly": (
        "Session cost USD%.4f is %.1f standard deviations above the mean (USD%.4f). "
        "Significantly higher than typical sessions.",
        "Investigate which agent consumed the excess cost. Mean session cost is USD%.4f. "
        "Check token usage by agent in Session Deep Dive."),
    "Handoff Schema Break": (
        "%s agent completed successfully but %s agent errored on its first trace. %s output did not match %s "
        "agent's expected schema. Error at handoff: %s",
        "Add schema validation at the %s -> %s handoff. Define a typed contract (Pydantic model or "
        "TypedDict) for what %s must return before passing to %s. Fail fast with a clear error if "
        "the contract is violated, rather than letting %s agent crash on bad input."),
    "Error Misinterpretation": (
        "%d HTTP error(s) received but agent(s) %s continued processing instead of aborting or retrying "
        "correctly. Errors: %s",
        "Add explicit HTTP error code handlers in tool wrappers: 429 = exponential backoff + retry; "
        "401 = surface credential error to operator, do not continue; 400 = log malformed request and abort "
        "the tool call chain; 503 = circuit breaker open, fail fast."),
}

# pattern -> detailed fix
FIXES = {
    "Tool Timeout Loop": "1. Add timeout=10 to %s calls in the %s agent.\n2. Add max_retries=2 with exponential backoff (2s, 4s).\n"
                         "3. If all retries fail, return a structured error — do not loop.\n"
                         "4. Consider a fallback data source if %s is unavailable.",
    "Context Spiral": "1. Set a hard token budget on the research agent (recommended: %s tokens max).\n"
                      "2. Add a 'decide or abort' checkpoint after each information-gathering step.\n"
                      "3. Log the reason if the agent exits without a recommendation.",
    "Pipeline Break": "1. Wrap the research -> orchestrator handoff in try/except.\n"
                      "2. Log a terminal_reason on any uncaught exception.\n"
                      "3. Add a health check after research completes before calling orchestrator.",
    "Cost Anomaly": "1. Review Session Deep Dive for this session to find the high-cost agent.\n"
                    "2. Add per-session cost budgets with early abort if exceeded.\n"
                    "3. Set alerts at mean + 1.5 sigma for proactive notification.",
    "Silent Exit": "1. Add terminal_reason logging to every orchestrator exit path.\n"
                   "2. Ensure the orchestrator always records 'no_opportunity', 'risk_rejected', or another explicit reason.\n"
                   "3. Treat a session with 0 trades and no reason as a bug, not normal operation.",
    "Empty Result Loop": "1. Add result quality validation after %s returns.\n"
                         "2. If result is empty, below quality threshold, or missing required fields: fail fast, do not retry "
                         "with same parameters.\n3. Log what %s returned when quality check fails.",
}
