"""Evidence frames (D13/B14), root-cause annotation (E1), fix texts (E2) and summaries (E3),
with DuckDB oracles that restate each pattern's evidence rule in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.columns import K
from runlens.plans.catalog import DET_BODIES, ERR_SQL, TOOL_SQL, _inputs, _sql, incidents_sql, query

TOK = "CAST(coalesce(tokens_input, 0) + coalesce(tokens_output, 0) AS BIGINT)"
FRAME_SEL = f"tenant_id, session_id, seq, agent, tool_name, {TOK} AS tokens, created_at"


def _fired(pattern: str) -> str:
    return f"(SELECT tenant_id, session_id FROM (WITH {DET_BODIES[pattern].strip()}))"


def _last(rows_sql: str, pattern: str, n: int) -> str:
    return f"""SELECT tenant_id, session_id, '{pattern}' AS pattern_name, seq, agent, tool_name, tokens FROM (
  SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at DESC, seq DESC) AS rn
  FROM (SELECT {FRAME_SEL} FROM ({rows_sql}) x
        WHERE (tenant_id, session_id) IN {_fired(pattern)})) WHERE rn <= {n}"""


FRAMES_BODY = f"""
fr AS (
SELECT * FROM (WITH e AS (SELECT *, coalesce(nullif(tool_name, ''), 'unknown_tool') AS tool FROM traces
                          WHERE {TOOL_SQL} AND {ERR_SQL}),
  e2 AS (SELECT *, count(*) OVER (PARTITION BY tenant_id, session_id, tool) AS n,
                row_number() OVER (PARTITION BY tenant_id, session_id, tool ORDER BY created_at, seq) AS rn FROM e),
  f AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at, seq) AS wr
        FROM e2 WHERE rn = 1 AND n >= 3)
  SELECT e.tenant_id, e.session_id, 'Tool Timeout Loop' AS pattern_name, e.seq, e.agent, e.tool_name, {TOK} AS tokens
  FROM e JOIN (SELECT tenant_id, session_id, tool FROM f WHERE wr = 1) w USING (tenant_id, session_id, tool))
UNION ALL
{_last("SELECT * FROM traces WHERE lower(coalesce(agent, '')) = 'research'", "Context Spiral", 20)}
UNION ALL
{_last("SELECT * FROM traces WHERE lower(coalesce(agent, '')) = 'research'", "Pipeline Break", 10)}
UNION ALL
SELECT * FROM (WITH ok AS (SELECT *, coalesce(nullif(tool_name, ''), 'unknown') AS tool FROM traces
                           WHERE {TOOL_SQL} AND coalesce(outcome, '') = 'success'),
  g AS (SELECT tenant_id, session_id, tool, min(seq) AS fs FROM ok GROUP BY ALL HAVING count(*) >= 3),
  w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY fs) AS wr FROM g)
        JOIN s USING (tenant_id, session_id) WHERE wr = 1 AND trades = 0)
  SELECT ok.tenant_id, ok.session_id, 'Empty Result Loop' AS pattern_name, ok.seq, ok.agent, ok.tool_name, {TOK} AS tokens
  FROM ok JOIN w ON ok.tenant_id = w.tenant_id AND ok.session_id = w.session_id AND ok.tool_name = w.tool)
UNION ALL
{_last("SELECT * FROM traces", "Silent Exit", 10)}
UNION ALL
SELECT * FROM (WITH c AS (SELECT *, coalesce(nullif(tool_name, ''), 'unknown') AS tool FROM traces
                          WHERE {TOOL_SQL} AND outcome IS DISTINCT FROM 'error'),
  c2 AS (SELECT *, count(*) OVER (PARTITION BY tenant_id, session_id, tool) AS n,
                row_number() OVER (PARTITION BY tenant_id, session_id, tool ORDER BY created_at, seq) AS rn FROM c),
  f AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at, seq) AS wr
        FROM c2 WHERE rn = 1 AND n >= 6)
  SELECT c.tenant_id, c.session_id, 'Hyperactive Polling Loop' AS pattern_name, c.seq, c.agent, c.tool_name, {TOK} AS tokens
  FROM c JOIN (SELECT tenant_id, session_id, tool FROM f WHERE wr = 1) w USING (tenant_id, session_id, tool))
UNION ALL
SELECT tenant_id, session_id, 'Tool Call Fabrication' AS pattern_name, seq, agent, tool_name, {TOK} AS tokens
FROM traces WHERE {TOOL_SQL} AND outcome IS DISTINCT FROM 'error'
  AND coalesce(latency_ms, 0) > 0 AND coalesce(latency_ms, 0) < 10.0
  AND coalesce(tool_name, '') NOT IN ('read_session_context', 'write_learning', 'get_candidates',
                                      'get_position_history', 'filter_and_rank', 'get_scan_results')
  AND (tenant_id, session_id) IN {_fired("Tool Call Fabrication")}
UNION ALL
{_last("SELECT * FROM traces WHERE starts_with(lower(coalesce(agent, '')), 'research')", "Handoff Schema Break", 5)}
UNION ALL
SELECT * FROM (SELECT tenant_id, session_id, 'Handoff Schema Break' AS pattern_name, seq, agent, tool_name, {TOK} AS tokens
  FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at, seq) AS r
        FROM traces WHERE lower(coalesce(agent, '')) = 'risk')
  WHERE r = 1 AND (tenant_id, session_id) IN {_fired("Handoff Schema Break")})
UNION ALL
SELECT c.tenant_id, c.session_id, 'Error Misinterpretation' AS pattern_name, c.seq, c.agent, c.tool_name,
       CAST(coalesce(c.tokens_input, 0) + coalesce(c.tokens_output, 0) AS BIGINT) AS tokens
FROM traces c WHERE coalesce(c.step_type, '') = 'tool_call'
  AND (contains(coalesce(c.error, ''), '400') OR contains(coalesce(c.error, ''), '401')
       OR contains(coalesce(c.error, ''), '403') OR contains(coalesce(c.error, ''), '429')
       OR contains(coalesce(c.error, ''), '500') OR contains(coalesce(c.error, ''), '502')
       OR contains(coalesce(c.error, ''), '503'))
  AND EXISTS (SELECT 1 FROM traces l WHERE l.tenant_id = c.tenant_id AND l.session_id = c.session_id
              AND l.agent IS NOT DISTINCT FROM c.agent AND coalesce(l.step_type, '') = 'llm_call'
              AND (l.created_at > c.created_at OR (l.created_at = c.created_at AND l.seq > c.seq)))
  AND (c.tenant_id, c.session_id) IN {_fired("Error Misinterpretation")}
UNION ALL
{_last("SELECT * FROM traces", "Cost Anomaly", 15)}
)"""


def _all(spark: SparkSession, sf_dir: str):
    from runlens.operators.detectors import run_detectors
    traces, sessions = _inputs(spark, sf_dir)
    d = run_detectors(traces, sessions)
    return traces, sessions, d


@query("detector_frames", _sql(FRAMES_BODY + "\nSELECT * FROM fr"))
def detector_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All incidents' evidence frames, one row per frame."""
    _, _, d = _all(spark, sf_dir)
    return d.frames.select(*K, "pattern_name", "seq", "agent", "tool_name", "tokens")


@query("run_detectors", _sql("inc AS (" + incidents_sql(
    "tenant_id, session_id, pattern_name, severity, round(cost_wasted, 8) AS cost_wasted, tokens_wasted, frame_count")
    + ")\nSELECT * FROM inc"))
def run_detectors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detector for every session."""
    _, _, d = _all(spark, sf_dir)
    return d.incidents.select(*K, "pattern_name", "severity", F.round("cost_wasted", 8).alias("cost_wasted"),
                              "tokens_wasted", "frame_count")


ANNOTATE_SQL = _sql(f"""
inc AS (SELECT tenant_id, session_id, 'Tool Timeout Loop' AS pattern_name, root_tool
        FROM (WITH {DET_BODIES["Tool Timeout Loop"].strip()})
        UNION ALL
        SELECT tenant_id, session_id, pattern_name, NULL AS root_tool FROM ({incidents_sql()})
        WHERE pattern_name <> 'Tool Timeout Loop'),
j AS (SELECT t.tenant_id, t.session_id, i.pattern_name, t.seq, t.created_at,
             CAST(coalesce(t.tokens_input, 0) + coalesce(t.tokens_output, 0) AS BIGINT) AS tokens,
             CASE WHEN i.pattern_name = 'Tool Timeout Loop' THEN coalesce(t.tool_name = i.root_tool, false)
                  WHEN i.pattern_name = 'Context Spiral' THEN lower(coalesce(t.agent, '')) = 'research'
                  WHEN i.pattern_name = 'Pipeline Break' THEN lower(coalesce(t.agent, '')) IN ('research', 'orchestrator')
                  WHEN i.pattern_name IN ('Cost Anomaly', 'Silent Exit', 'Empty Result Loop')
                    THEN (t.outcome IS NOT DISTINCT FROM 'error' OR nullif(trim(t.error), '') IS NOT NULL)
                  ELSE false END AS is_relevant,
             (t.outcome IS NOT DISTINCT FROM 'error' OR nullif(trim(t.error), '') IS NOT NULL) AS err
      FROM traces t JOIN inc i USING (tenant_id, session_id)),
r AS (SELECT tenant_id, session_id, pattern_name, seq AS root_seq FROM (
        SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id, pattern_name ORDER BY created_at, seq) AS rn
        FROM j WHERE pattern_name = 'Tool Timeout Loop' AND is_relevant AND err) WHERE rn = 1)
SELECT j.tenant_id, j.session_id, j.pattern_name, j.seq, coalesce(j.seq = r.root_seq, false) AS is_root,
       j.is_relevant, j.tokens
FROM j LEFT JOIN r USING (tenant_id, session_id, pattern_name)""")


@query("rca_annotate_call_stack", ANNOTATE_SQL)
def rca_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each incident's full session stack with relevance and root flags."""
    from runlens.operators.rca import annotate_call_stack
    traces, _, d = _all(spark, sf_dir)
    a = annotate_call_stack(d.incidents, traces)
    return a.select(*K, "pattern_name", "seq", "is_root", "is_relevant", "tokens")


FIX_SQL = _sql(FRAMES_BODY + f""",
ft AS (SELECT tenant_id, session_id, pattern_name,
              arg_min(nullif(tool_name, ''), seq) FILTER (WHERE nullif(tool_name, '') IS NOT NULL) AS tool,
              arg_min(nullif(agent, ''), seq) FILTER (WHERE nullif(agent, '') IS NOT NULL) AS agent
       FROM fr GROUP BY ALL),
cs AS (SELECT tenant_id, session_id, tokens_wasted FROM (WITH {DET_BODIES["Context Spiral"].strip()})),
hp AS (SELECT * FROM (WITH c AS (SELECT *, coalesce(nullif(tool_name, ''), 'unknown') AS tool FROM traces
                                 WHERE {TOOL_SQL} AND outcome IS DISTINCT FROM 'error'),
         c2 AS (SELECT *, count(*) OVER (PARTITION BY tenant_id, session_id, tool) AS n,
                       row_number() OVER (PARTITION BY tenant_id, session_id, tool ORDER BY created_at, seq) AS rn FROM c),
         f AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at, seq) AS wr
               FROM c2 WHERE rn = 1 AND n >= 6)
       SELECT tenant_id, session_id, coalesce(agent, 'None') AS agent, tool FROM f WHERE wr = 1)),
inc AS ({incidents_sql()})
SELECT i.tenant_id, i.session_id, i.pattern_name,
  CASE i.pattern_name
    WHEN 'Tool Timeout Loop' THEN '1. Add timeout=10 to ' || coalesce(ft.tool, 'the tool') || ' calls in the '
      || coalesce(ft.agent, 'the agent') || ' agent.' || chr(10) || '2. Add max_retries=2 with exponential backoff (2s, 4s).'
      || chr(10) || '3. If all retries fail, return a structured error — do not loop.' || chr(10)
      || '4. Consider a fallback data source if ' || coalesce(ft.tool, 'the tool') || ' is unavailable.'
    WHEN 'Context Spiral' THEN '1. Set a hard token budget on the research agent (recommended: '
      || format('{{:,}}', cs.tokens_wasted // 2) || ' tokens max).' || chr(10)
      || '2. Add a ''decide or abort'' checkpoint after each information-gathering step.' || chr(10)
      || '3. Log the reason if the agent exits without a recommendation.'
    WHEN 'Pipeline Break' THEN '1. Wrap the research -> orchestrator handoff in try/except.' || chr(10)
      || '2. Log a terminal_reason on any uncaught exception.' || chr(10)
      || '3. Add a health check after research completes before calling orchestrator.'
    WHEN 'Cost Anomaly' THEN '1. Review Session Deep Dive for this session to find the high-cost agent.' || chr(10)
      || '2. Add per-session cost budgets with early abort if exceeded.' || chr(10)
      || '3. Set alerts at mean + 1.5 sigma for proactive notification.'
    WHEN 'Silent Exit' THEN '1. Add terminal_reason logging to every orchestrator exit path.' || chr(10)
      || '2. Ensure the orchestrator always records ''no_opportunity'', ''risk_rejected'', or another explicit reason.'
      || chr(10) || '3. Treat a session with 0 trades and no reason as a bug, not normal operation.'
    WHEN 'Empty Result Loop' THEN '1. Add result quality validation after ' || coalesce(ft.tool, 'the tool') || ' returns.'
      || chr(10) || '2. If result is empty, below quality threshold, or missing required fields: fail fast, do not retry '
      || 'with same parameters.' || chr(10) || '3. Log what ' || coalesce(ft.tool, 'the tool') || ' returned when quality check fails.'
    WHEN 'Hyperactive Polling Loop' THEN 'Add a max_iterations cap to ' || hp.agent || ' agent''s ' || hp.tool
      || ' loop (e.g. max_calls=3). Force a decision step once the cap is hit. Consider caching results between calls '
      || 'to avoid redundant fetches.'
    WHEN 'Tool Call Fabrication' THEN 'Verify that tool calls are making real external requests. Add response '
      || 'validation: check that tool output is consistent with what the actual API returns (schema, latency, value '
      || 'ranges). Enable request logging in tool wrappers to confirm HTTP calls are made.'
    WHEN 'Handoff Schema Break' THEN 'Add schema validation at the research -> risk handoff. Define a typed contract '
      || '(Pydantic model or TypedDict) for what research must return before passing to risk. Fail fast with a clear '
      || 'error if the contract is violated, rather than letting risk agent crash on bad input.'
    ELSE 'Add explicit HTTP error code handlers in tool wrappers: 429 = exponential backoff + retry; 401 = surface '
      || 'credential error to operator, do not continue; 400 = log malformed request and abort the tool call chain; '
      || '503 = circuit breaker open, fail fast.'
  END AS fix_detail
FROM inc i LEFT JOIN ft USING (tenant_id, session_id, pattern_name)
LEFT JOIN cs ON i.pattern_name = 'Context Spiral' AND cs.tenant_id = i.tenant_id AND cs.session_id = i.session_id
LEFT JOIN hp ON i.pattern_name = 'Hyperactive Polling Loop' AND hp.tenant_id = i.tenant_id AND hp.session_id = i.session_id""")


@query("rca_fix_suggestions", FIX_SQL.replace("{{:,}}", "{:,}"))
def rca_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detailed fix text per incident."""
    from runlens.operators.rca import fix_suggestions
    _, _, d = _all(spark, sf_dir)
    return fix_suggestions(d.incidents, d.frames).select(*K, "pattern_name", "fix_detail")


SUMMARY_SQL = _sql(FRAMES_BODY + f""",
ag AS (SELECT tenant_id, session_id, pattern_name, count(DISTINCT nullif(agent, '')) AS n_agents,
              string_agg(DISTINCT nullif(agent, ''), ',' ORDER BY nullif(agent, '')) AS agents
       FROM fr GROUP BY ALL),
inc AS ({incidents_sql("tenant_id, session_id, pattern_name, severity")})
SELECT i.tenant_id, i.session_id, i.pattern_name AS pattern, i.severity,
       CASE i.severity WHEN 'critical' THEN '#EF4444' WHEN 'warning' THEN '#F59E0B' WHEN 'info' THEN '#3B82F6'
            ELSE '#94A3B8' END AS severity_color,
       CAST(coalesce(abs(epoch_us(ss.completed_at) - epoch_us(ss.started_at)) // 1000000, 0) AS BIGINT) AS duration_s,
       CAST(coalesce(ss.trades_executed, 0) AS BIGINT) AS trades,
       CAST(coalesce(ag.n_agents, 0) AS BIGINT) AS n_agents, coalesce(ag.agents, '') AS agents,
       CAST(0 AS BIGINT) AS failed_eval_count
FROM inc i JOIN sessions ss USING (tenant_id, session_id)
LEFT JOIN ag USING (tenant_id, session_id, pattern_name)""")


@query("rca_summarize_incidents", SUMMARY_SQL)
def rca_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display summary per incident (no evals attached, so no failed evals)."""
    from runlens.operators.rca import summarize_incidents
    _, sessions, d = _all(spark, sf_dir)
    sm = summarize_incidents(d.incidents, sessions, d.frames)
    return sm.select(*K, "pattern", "severity", "severity_color", "duration_s", "trades",
                     F.size("agents").cast("long").alias("n_agents"), F.array_join("agents", ",").alias("agents"),
                     "failed_eval_count")
