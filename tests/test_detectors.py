"""Detectors (D1-D16) and root-cause annotation (E1-E3), from the reference's cases."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import healthy, llm_trace, make_session, make_traces, timeouts
from runlens.operators.config import load_pipeline_config, pipeline_config_rows
from runlens.operators.detectors import failed_eval_rows, run_detectors, shadow_cb_fires
from runlens.operators.rca import annotate_call_stack, fix_suggestions, summarize_incidents


def detect(spark, traces, session=None, pipeline=None, evals=None, sid="run-1"):
    s = session if session is not None else make_session(spark, session_id=sid)
    t = make_traces(spark, traces, session_id=sid)
    params = load_pipeline_config(pipeline_config_rows(spark, {"press": pipeline})) if pipeline else None
    return run_detectors(t, s, params=params, evals=evals)


def test_healthy_session_has_no_incident(spark):
    assert detect(spark, healthy()).incidents.count() == 0


def test_tool_timeout_loop_and_rca(spark):
    s = make_session(spark, trades_executed=0, terminal_reason="error", total_cost_usd=0.30)
    t = make_traces(spark, timeouts())
    d = run_detectors(t, s)
    inc = {r.pattern_name: r for r in d.incidents.collect()}
    ttl = inc["Tool Timeout Loop"]
    assert ttl.severity == "critical" and ttl.frame_count == 3 and ttl.cost_wasted == 0.30
    assert ttl.root_cause == "filings failed 3 times in research agent. Error: upstream gave up after 20 s"
    assert ttl.tokens_wasted == 5000 and not ttl.is_simulated
    assert d.frames.filter(F.col("pattern_name") == "Tool Timeout Loop").count() == 3
    # Exactly one root, the first failed call; every trace of the session is listed
    a = annotate_call_stack(d.incidents.filter(F.col("pattern_name") == "Tool Timeout Loop"),
                            t.withColumn("extra", F.lit("kept")))
    rows = a.orderBy("seq").collect()
    assert len(rows) == 4 and [r.is_root for r in rows] == [False, True, False, False]
    assert [r.is_relevant for r in rows] == [False, True, True, True] and rows[0].extra == "kept"
    # The fix names the tool; E3: 400 s session
    fix = fix_suggestions(d.incidents, d.frames).filter(F.col("pattern_name") == "Tool Timeout Loop").first().fix_detail
    assert "filings" in fix and "timeout" in fix.lower()
    summ = summarize_incidents(d.incidents, make_session(spark), d.frames)
    r = summ.filter(F.col("pattern") == "Tool Timeout Loop").first()
    assert r.duration_s == 400 and r.severity_color == "#EF4444" and r.agents == ["research"]


def test_context_spiral_uses_analysis_agent(spark):
    t = [dict(agent="analyser", step_type="llm_call", outcome="success", tokens_input=25_000, tokens_output=20_000,
              latency_ms=2000, created_at="2031-03-02T09:00:30")]
    s = make_session(spark, trades_executed=0, total_cost_usd=0.50)
    d = detect(spark, t, session=s, pipeline={"analysis_agent": "analyser", "token_spiral_threshold": 40_000})
    r = d.incidents.filter(F.col("pattern_name") == "Context Spiral").first()
    assert r is not None and r.tokens_wasted == 45_000
    assert r.root_cause.startswith("Analyser agent consumed 45,000 tokens")
    assert "max_tokens=20000" in r.fix_suggestion


def test_pipeline_break_uses_pipeline_order(spark):
    s = make_session(spark, trades_executed=0)
    d = detect(spark, [llm_trace("ingestion")], session=s, pipeline={"pipeline_order": ["ingestion", "processor"]})
    r = d.incidents.filter(F.col("pattern_name") == "Pipeline Break").first()
    assert r.root_cause == ("Ingestion agent completed but processor never started. "
                            "Last ingestion step: llm_call (outcome: success)")


def test_handoff_schema_break_uses_pairs(spark):
    t = [llm_trace("ingest"), dict(agent="transform", step_type="tool_call", tool_name="parse", outcome="error",
                                   error="schema mismatch", latency_ms=50, created_at="2031-03-02T09:01:00")]
    d = detect(spark, t, session=make_session(spark, trades_executed=0),
               pipeline={"handoff_pairs": [["ingest", "transform"]]})
    r = d.incidents.filter(F.col("pattern_name") == "Handoff Schema Break").first()
    assert r is not None and r.root_cause.endswith("Error at handoff: schema mismatch") and r.frame_count == 2


def test_other_detectors(spark):
    poll = [dict(agent="market", step_type="tool_call", tool_name="quote", outcome="success", latency_ms=5,
                 created_at=f"2031-03-02T09:0{i}:00") for i in range(6)]
    http = [dict(agent="research", step_type="tool_call", tool_name="api", outcome="error",
                 error="HTTP 429 Too Many", latency_ms=100, created_at=f"2031-03-02T09:1{i}:00") for i in range(2)]
    later = [dict(llm_trace("research"), created_at="2031-03-02T09:30:00")]
    s = make_session(spark, trades_executed=0, terminal_reason="")
    inc = {r.pattern_name: r for r in detect(spark, poll + http + later, session=s).incidents.collect()}
    assert inc["Hyperactive Polling Loop"].root_cause.endswith("Total time in tool calls: 30ms.")
    assert inc["Empty Result Loop"].frame_count == 6
    assert "Affected agents: ['market']. Tools: ['quote']." in inc["Tool Call Fabrication"].root_cause
    assert inc["Tool Call Fabrication"].tokens_wasted == 0
    assert inc["Error Misinterpretation"].root_cause.startswith("2 HTTP error(s) received but agent(s) ['research']")
    assert "Silent Exit" not in inc  # tool errors present


def test_silent_exit(spark):
    s = make_session(spark, trades_executed=0, terminal_reason="")
    inc = detect(spark, [llm_trace("research"), llm_trace("orchestrator")], session=s).incidents
    assert [r.pattern_name for r in inc.collect()] == ["Silent Exit"]
    both = detect(spark, [llm_trace("research")], session=s).incidents   # orchestrator never ran
    assert sorted(r.pattern_name for r in both.collect()) == ["Pipeline Break", "Silent Exit"]


def test_cost_anomaly_over_history(spark):
    from datetime import datetime, timedelta
    from conftest import SESSION_SCHEMA
    rows = []
    for i in range(8):
        cost = 1.0 + 0.01 * (i % 2) if i < 7 else 5.0
        t0 = datetime(2026, 6, 1 + i)
        rows.append(("t", f"s{i}", "w", cost, 10, 10, 1, 1, "completed", t0, t0 + timedelta(minutes=5)))
    s = spark.createDataFrame(rows, SESSION_SCHEMA)
    t = make_traces(spark, [dict(llm_trace("research"), session_id=f"s{i}", tenant_id="t", workflow_id="w")
                            for i in range(8)])
    for bucket in (86_400, None):   # halo-bucketed window == plain window
        inc = run_detectors(t, s, history_bucket_seconds=bucket).incidents
        got = [(r.session_id, round(r.cost_wasted, 4)) for r in inc.filter(F.col("pattern_name") == "Cost Anomaly").collect()]
        assert got == [("s7", 3.9957)]


def test_failed_evals_and_breakers(spark):
    ev = spark.createDataFrame([Row(tenant_id="desk-a", session_id="run-1", agent="research",
                                    eval_name="tool_success_rate", score=0.5, passed=False, threshold=0.8, config_ord=0),
                                Row(tenant_id="desk-a", session_id="run-1", agent="risk",
                                    eval_name="x", score=0.9, passed=True, threshold=0.5, config_ord=1)])
    fe = failed_eval_rows(ev).first().failed_evals
    assert len(fe) == 1 and fe[0].role == "cause"
    d = detect(spark, timeouts(), session=make_session(spark, trades_executed=0, terminal_reason="error"), evals=ev)
    assert all(len(r.failed_evals) == 1 for r in d.incidents.collect())
    from runlens.operators.config import cb_config_rows
    fires = shadow_cb_fires(ev, cb_config_rows(spark)).collect()
    assert [(r.agent, r.eval_name, r.score, r.threshold) for r in fires] == [("research", "tool_success_rate", 0.5, 0.8)]
