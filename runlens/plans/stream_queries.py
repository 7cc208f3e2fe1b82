"""Streaming, sink and configuration queries (S1, S2, A10-A12, D11), with DuckDB oracles.

The streaming queries stage their input under the shared checkpoint folder, run the streaming
job with an available-now trigger, and return what the job wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.columns import K
from runlens.plans.catalog import DET_BODIES, _inputs, _sql, incidents_sql, query
from runlens.session import stored
from runlens.sources.adapters import TRACES_SQL, duplicated_traces, load_traces, with_sql


STREAM_DEDUPE_SQL = with_sql(TRACES_SQL, """
dup AS (SELECT * FROM traces UNION ALL SELECT * FROM traces WHERE event_id % 10 = 0),
dup2 AS (SELECT * REPLACE (CASE WHEN event_id % 50 = 1 THEN NULL ELSE span_id END AS span_id) FROM dup),
allrows AS (SELECT * FROM dup2 UNION ALL SELECT * FROM dup2 WHERE event_id % 50 = 1)
SELECT DISTINCT tenant_id, session_id, span_id, event_id FROM allrows WHERE span_id IS NOT NULL
UNION ALL
SELECT tenant_id, session_id, span_id, event_id FROM allrows WHERE span_id IS NULL""")


@query("stream_dedupe_spans", STREAM_DEDUPE_SQL)
def stream_dedupe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of retried spans in eight micro-batches, far out of time order (originals and retries are dealt
    to files by a hash), deduplicated without loss. A micro-batch has a file for each core, so that all of them read it."""
    from runlens.streaming.spans import scratch_path, stream_dedupe_spans
    stage = scratch_path(spark, "dedupe-in")
    files = spark.sparkContext.defaultParallelism
    dup = duplicated_traces(load_traces(spark, sf_dir))
    dup.repartition(8 * files, F.xxhash64("event_id", "arrived_at")).write.parquet(stage)
    src = spark.readStream.schema(dup.schema).option("maxFilesPerTrigger", files).parquet(stage)
    out = stream_dedupe_spans(src, scratch_path(spark, "dedupe-out"), scratch_path(spark, "dedupe-ckpt"), buckets=8)
    return out.select(*K, "span_id", "event_id")


RETRIES_SQL = with_sql(TRACES_SQL, """
r AS (SELECT *, CASE WHEN event_id % 50 = 1 THEN '' ELSE span_id END AS sid FROM traces)
SELECT tenant_id, session_id, sid AS span_id, event_id, CAST(created_at AS DATE) AS day FROM r
UNION ALL
SELECT tenant_id, session_id, sid, event_id, CAST(created_at + INTERVAL 1 DAY AS DATE) FROM r WHERE event_id % 10 = 1 AND sid = ''""")


@query("stream_dedupe_retries", RETRIES_SQL)
def stream_retries_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans in three micro-batches, then every tenth of them again, stamped a day later, in two more. A retry lands once, whatever
    its date; the first stored arrival stays; spans with a blank id all stay."""
    from runlens.streaming.spans import scratch_path, stream_dedupe_spans
    stage, store, ckpt = (scratch_path(spark, f"retries-{x}") for x in ("in", "out", "ckpt"))
    t = load_traces(spark, sf_dir).withColumn("arrived_at", F.col("created_at")).withColumn(
        "span_id", F.when(F.col("event_id") % 50 == 1, "").otherwise(F.col("span_id")))
    again = t.where(F.col("event_id") % 10 == 1).withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY"))
    for rows, parts in ((t, 3), (again, 2)):
        for k in range(parts):                          # what has arrived by then is one micro-batch, of as many files as it has tasks
            rows.where(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == k).write.mode("append").parquet(stage)
            out = stream_dedupe_spans(spark.readStream.schema(t.schema).parquet(stage), store, ckpt, buckets=8)
    return out.select(*K, "span_id", "event_id", F.to_date("created_at").alias("day"))


RUN_SQL = _sql("inc AS (" + incidents_sql(
    "tenant_id, session_id, pattern_name, severity, CAST(printf('%.4f', cost_wasted) AS DOUBLE) AS cost_wasted, tokens_wasted, frame_count")
    + ")\nSELECT * FROM inc")


def _closed_results(spark: SparkSession, sf_dir: str, pipeline: dict | None = None) -> str:
    """Close events in four micro-batches; every fifth session closes a second time in the last one."""
    from runlens.plans.eval_queries import STANDARD, config_df, params_df
    from runlens.streaming.spans import scratch_path, stream_evaluate_closed
    traces, sessions = _inputs(spark, sf_dir)
    stage = scratch_path(spark, "closes-in")
    closes = sessions.select(*K, F.col("completed_at").alias("closed_at"))
    part = F.pmod(F.xxhash64("session_id"), F.lit(3)).cast("int")
    again = closes.where(F.pmod(F.xxhash64("session_id"), F.lit(5)) == 0).withColumn("part", F.lit(3))
    both = closes.withColumn("part", part).unionByName(again)
    for k in range(4):                                   # one file for each micro-batch
        both.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(stage)
    src = spark.readStream.schema(closes.schema).option("maxFilesPerTrigger", 1).parquet(stage)
    out = scratch_path(spark, "closed-out")
    stream_evaluate_closed(src, traces, sessions, out, scratch_path(spark, "closed-ckpt"), params_df(spark, pipeline),
                           eval_configs=config_df(spark, STANDARD))
    return out


@query("stream_evaluate_closed", RUN_SQL)
def stream_closed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2, incidents: each micro-batch judges the sessions it closes; a second close replaces the first's results."""
    from runlens.streaming.spans import latest_results
    inc = latest_results(spark, _closed_results(spark, sf_dir), "incidents")
    return inc.select(*K, "pattern_name", "severity", "cost_wasted", "tokens_wasted", "frame_count")


@query("write_incidents", RUN_SQL)
def write_incidents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents stored and read back; the second write leaves the table as it is."""
    return _written_incidents(spark, sf_dir).select(*K, "pattern_name", "severity", "cost_wasted", "tokens_wasted", "frame_count")


def _written_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from runlens.operators.detectors import run_detectors
    from runlens.sources.sinks import read_stored, write_incidents
    from runlens.streaming.spans import scratch_path
    traces, sessions = _inputs(spark, sf_dir)
    d = run_detectors(traces, sessions)
    frames = stored(d.frames, "frames")
    path = scratch_path(spark, "incidents")
    for _ in range(2):
        write_incidents(d.incidents, path, frames, buckets=8)
    return read_stored(spark, f"{path}/incidents")


def _id_sql(*parts: str) -> str:
    h = "md5(concat_ws(chr(31), " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), chr(0))" for p in parts) + "))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-3' || substr({h}, 14, 3) || '-a' || substr({h}, 18, 3) "
            f"|| '-' || substr({h}, 21, 12)")


@query("upsert_incidents", "SELECT *, " + _id_sql("tenant_id", "session_id", "pattern_name") + " AS id, 'open' AS status FROM (" + RUN_SQL + ")")
def upsert_incidents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First an outdated run (other thresholds, half of the sessions), then the right one over all sessions, twice. Its incidents
    replace the outdated ones, those that are not found any more go, and ids do not depend on the run."""
    from runlens.operators.config import load_pipeline_config, pipeline_config_rows
    from runlens.operators.detectors import run_detectors
    from runlens.sources.sinks import read_stored, write_incidents
    from runlens.streaming.spans import scratch_path
    traces, sessions = _inputs(spark, sf_dir)
    path = scratch_path(spark, "incidents")
    loose = load_pipeline_config(pipeline_config_rows(spark, {w: {"tool_retry_threshold": 2, "hyperactive_poll_threshold": 2}
                                                              for w in ("w0", "w1", "w2", "w3")}))
    half = sessions.where(F.pmod(F.xxhash64("session_id"), F.lit(2)) == 0)
    old = run_detectors(traces.join(half.select(*K), K, "left_semi"), half, params=loose)
    write_incidents(old.incidents, path, old.frames, half, buckets=8)
    now = run_detectors(traces, sessions)
    frames = stored(now.frames, "frames")
    for _ in range(2):
        write_incidents(now.incidents, path, frames, sessions, buckets=8)
    return read_stored(spark, f"{path}/incidents").select(
        *K, "pattern_name", "severity", "cost_wasted", "tokens_wasted", "frame_count", "id", "status")


AGENTS_SQL = with_sql(TRACES_SQL, """
a AS (SELECT workflow_id, agent, min(created_at) AS first_seen FROM traces GROUP BY ALL)
SELECT workflow_id, agent AS agent_name, upper(left(agent, 1)) || lower(substr(agent, 2)) AS display_name,
       CAST(row_number() OVER (PARTITION BY workflow_id ORDER BY first_seen, agent) AS INTEGER) AS sort_order
FROM a""")


@query("load_pipeline_agents", AGENTS_SQL)
def agents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: every workflow's agents (derived from its traces) in display order."""
    from pyspark.sql import Window
    from runlens.operators.config import load_pipeline_agents
    t = load_traces(spark, sf_dir)
    a = t.groupBy("workflow_id", "agent").agg(F.min("created_at").alias("first_seen"))
    w = Window.partitionBy("workflow_id").orderBy("first_seen", "agent")
    rows = a.select("workflow_id", F.col("agent").alias("agent_name"),
                    F.concat(F.upper(F.substring("agent", 1, 1)), F.lower(F.substring("agent", 2, 1 << 20)))
                    .alias("display_name"), F.lit(None).cast("string").alias("emoji"),
                    F.row_number().over(w).alias("sort_order"))
    return load_pipeline_agents(rows).drop("emoji")


# ── D11: detectors with per-workflow settings ─────────────────────────────────────────────────

CONFIGURED = {
    "w0": {"hyperactive_poll_threshold": 3, "fabrication_latency_ms": 40.0, "fabrication_min_count": 2, "fabrication_exempt_tools": ["tool_1"]},
    "w1": {"tool_retry_threshold": 4},
    "w2": {"pipeline_order": ["market", "risk"]},
    "w3": {"cost_anomaly_sigma": 1.5, "token_spiral_threshold": 20000, "handoff_pairs": [["market", "risk"], ["research", "orchestrator"]]},
}

CFG_SQL = _sql("""
e AS (SELECT *, coalesce(nullif(tool_name, ''), 'unknown_tool') AS tool FROM traces
      WHERE coalesce(step_type, '') = 'tool_call'
        AND (outcome IS NOT DISTINCT FROM 'error' OR nullif(trim(error), '') IS NOT NULL)),
d1 AS (SELECT tenant_id, session_id, 'Tool Timeout Loop' AS pattern_name, count(*) AS n,
              max(CASE WHEN workflow_id = 'w1' THEN 4 ELSE 3 END) AS thr FROM e GROUP BY tenant_id, session_id, tool),
r1 AS (SELECT DISTINCT tenant_id, session_id, pattern_name FROM d1 WHERE n >= thr),
ok AS (SELECT tenant_id, session_id, workflow_id, coalesce(nullif(tool_name, ''), 'unknown') AS tool FROM traces
       WHERE coalesce(step_type, '') = 'tool_call' AND coalesce(outcome, '') = 'success'),
r4 AS (SELECT DISTINCT ok.tenant_id, ok.session_id, 'Empty Result Loop' AS pattern_name FROM ok JOIN s USING (tenant_id, session_id)
       WHERE s.trades = 0 GROUP BY ok.tenant_id, ok.session_id, ok.tool
       HAVING count(*) >= max(CASE WHEN ok.workflow_id = 'w1' THEN 4 ELSE 3 END)),
ag AS (SELECT tenant_id, session_id, workflow_id,
              bool_or(lower(agent) = CASE WHEN workflow_id = 'w2' THEN 'market' ELSE 'research' END
                      OR starts_with(lower(agent), CASE WHEN workflow_id = 'w2' THEN 'market_' ELSE 'research_' END)) AS f,
              bool_or(lower(agent) = CASE WHEN workflow_id = 'w2' THEN 'risk' ELSE 'orchestrator' END
                      OR starts_with(lower(agent), CASE WHEN workflow_id = 'w2' THEN 'risk_' ELSE 'orchestrator_' END)) AS l
       FROM traces GROUP BY ALL),
r3 AS (SELECT tenant_id, session_id, 'Pipeline Break' AS pattern_name FROM ag WHERE f AND NOT l),
sp AS (SELECT tenant_id, session_id, sum(coalesce(tokens_input, 0) + coalesce(tokens_output, 0)) AS at,
              max(CASE WHEN workflow_id = 'w3' THEN 20000 ELSE 40000 END) AS thr
       FROM traces WHERE lower(agent) = 'research' GROUP BY ALL),
r2 AS (SELECT sp.tenant_id, sp.session_id, 'Context Spiral' AS pattern_name FROM sp JOIN s USING (tenant_id, session_id)
       WHERE sp.at > sp.thr AND s.trades = 0),
h AS (SELECT *, count(cost) OVER w AS hn, avg(cost) OVER w AS hm, stddev_samp(cost) OVER w AS hsd
      FROM s WINDOW w AS (PARTITION BY tenant_id, workflow_id ORDER BY started_at, session_id
                          ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
r10 AS (SELECT tenant_id, session_id, 'Cost Anomaly' AS pattern_name FROM h
        WHERE hn >= 5 AND (CASE WHEN hsd > 0 THEN (cost - hm) / hsd ELSE 0.0 END)
                          > CASE WHEN workflow_id = 'w3' THEN 1.5 ELSE 2.0 END),
r6 AS (SELECT DISTINCT tenant_id, session_id, 'Hyperactive Polling Loop' AS pattern_name
       FROM (SELECT tenant_id, session_id, workflow_id, coalesce(nullif(tool_name, ''), 'unknown') AS tool FROM traces
             WHERE coalesce(step_type, '') = 'tool_call' AND outcome IS DISTINCT FROM 'error')
       GROUP BY tenant_id, session_id, tool HAVING count(*) >= max(CASE WHEN workflow_id = 'w0' THEN 3 ELSE 6 END)),
r7 AS (SELECT tenant_id, session_id, 'Tool Call Fabrication' AS pattern_name FROM traces
       WHERE coalesce(step_type, '') = 'tool_call' AND outcome IS DISTINCT FROM 'error' AND coalesce(latency_ms, 0) > 0
         AND latency_ms < CASE WHEN workflow_id = 'w0' THEN 40.0 ELSE 10.0 END AND NOT (workflow_id = 'w0' AND tool_name = 'tool_1')
       GROUP BY tenant_id, session_id HAVING count(*) >= max(CASE WHEN workflow_id = 'w0' THEN 2 ELSE 3 END)),
hp AS (SELECT * FROM (VALUES ('w0', 'research', 'risk'), ('w1', 'research', 'risk'), ('w2', 'research', 'risk'),
                             ('w3', 'market', 'risk'), ('w3', 'research', 'orchestrator')) v(workflow_id, src, tgt)),
hs AS (SELECT t.tenant_id, t.session_id, src, tgt, bool_or(coalesce(step_type, '') IN ('llm_call', 'agent_message', 'decision')
                                                          AND outcome IS DISTINCT FROM 'error') AS ok
       FROM traces t JOIN hp USING (workflow_id) WHERE starts_with(lower(coalesce(agent, '')), src) GROUP BY ALL),
ht AS (SELECT t.tenant_id, t.session_id, src, tgt, t.outcome IS NOT DISTINCT FROM 'error' OR nullif(trim(t.error), '') IS NOT NULL AS err,
              row_number() OVER (PARTITION BY t.tenant_id, t.session_id, src, tgt ORDER BY created_at, seq) AS r
       FROM traces t JOIN hp USING (workflow_id) WHERE lower(coalesce(agent, '')) = tgt),
r8 AS (SELECT DISTINCT hs.tenant_id, hs.session_id, 'Handoff Schema Break' AS pattern_name
       FROM hs JOIN ht USING (tenant_id, session_id, src, tgt) WHERE hs.ok AND ht.r = 1 AND ht.err)
SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4
UNION ALL SELECT * FROM r6 UNION ALL SELECT * FROM r7 UNION ALL SELECT * FROM r8 UNION ALL SELECT * FROM r10
""" + "".join(f"UNION ALL SELECT tenant_id, session_id, pattern_name FROM (WITH {DET_BODIES[p].strip()})\n"
              for p in ("Silent Exit", "Error Misinterpretation")))


@query("run_detectors_configured", CFG_SQL)
def configured_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten detectors, each session judged with its own workflow's settings (pipeline config loaded from
    key/value rows)."""
    from runlens.operators.config import load_pipeline_config, pipeline_config_rows
    from runlens.operators.detectors import run_detectors
    traces, sessions = _inputs(spark, sf_dir)
    params = load_pipeline_config(pipeline_config_rows(spark, CONFIGURED))
    d = run_detectors(traces, sessions, params=params)
    return d.incidents.select(*K, "pattern_name")


def _write_evals_sql() -> str:
    from runlens.plans.eval_queries import PIPELINE, STANDARD, evals_sql
    return ("SELECT tenant_id, session_id, eval_name, agent, CAST(printf('%.3f', score) AS DOUBLE) AS score, passed, threshold, 3 AS layer "
            "FROM (" + evals_sql(STANDARD, PIPELINE) + ")")


@query("write_evals", _write_evals_sql())
def write_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule evals stored (score rounded to 3, layer 3) and read back."""
    return _written_evals(spark, sf_dir).select(*K, "eval_name", "agent", "score", "passed", "threshold", "layer")


def _written_evals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outdated run (no per-workflow settings), then the right one twice."""
    from runlens.operators.evals import run_rule_evals
    from runlens.plans.eval_queries import PIPELINE, STANDARD, config_df, params_df
    from runlens.sources.sinks import read_stored, write_evals
    from runlens.streaming.spans import scratch_path
    traces, sessions = _inputs(spark, sf_dir)
    path = scratch_path(spark, "evals")
    write_evals(run_rule_evals(sessions, traces, config_df(spark, STANDARD)), path, buckets=8)
    ev = stored(run_rule_evals(sessions, traces, config_df(spark, STANDARD), params_df(spark, PIPELINE)), "evals-now")
    for _ in range(2):
        write_evals(ev, path, buckets=8)
    return read_stored(spark, path)


def _upsert_evals_sql() -> str:
    from runlens.plans.eval_queries import STANDARD
    metrics = ", ".join(f"('{c.eval_name}', '{c.metric}')" for c in STANDARD)
    return (f"WITH m AS (SELECT * FROM (VALUES {metrics}) v(eval_name, metric)), w AS (" + _write_evals_sql() + ")\nSELECT w.*, "
            + _id_sql("tenant_id", "session_id", "w.eval_name", "agent", "metric", "1") + " AS id FROM w JOIN m ON w.eval_name = m.eval_name")


@query("upsert_evals", _upsert_evals_sql())
def upsert_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evals stored three times (first outdated ones) with their ids."""
    return _written_evals(spark, sf_dir).select(*K, "eval_name", "agent", "score", "passed", "threshold", "layer", "id")


def _closed_evals_sql() -> str:
    from runlens.plans.eval_queries import PIPELINE, STANDARD, evals_sql
    return "SELECT tenant_id, session_id, eval_name, agent, score, passed, threshold FROM (" + evals_sql(STANDARD, PIPELINE) + ")"


@query("stream_evaluate_closed_evals", _closed_evals_sql())
def stream_closed_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2, rule evals of the sessions closed in each micro-batch, one result per session."""
    from runlens.plans.eval_queries import PIPELINE
    from runlens.streaming.spans import latest_results
    return latest_results(spark, _closed_results(spark, sf_dir, PIPELINE), "evals").select(
        *K, "eval_name", "agent", "score", "passed", "threshold")


EVAL_CONFIGS_SQL = with_sql(TRACES_SQL, """
c AS (SELECT DISTINCT tenant_id, workflow_id, agent FROM traces),
x AS (SELECT CASE WHEN agent = 'market' THEN NULL ELSE tenant_id END AS tenant_id, CASE WHEN agent = 'risk' THEN NULL ELSE workflow_id END AS workflow_id,
             agent || '_presence' AS eval_name, agent, CASE WHEN agent = 'orchestrator' THEN 4 ELSE 3 END AS layer, agent <> 'orchestrator' OR tenant_id = 't0' AS enabled
      FROM c)
SELECT tenant_id, workflow_id, eval_name, agent, layer FROM x
WHERE enabled AND layer = 3 AND (workflow_id IS NULL OR workflow_id = 'w1') AND (tenant_id IS NULL OR tenant_id = 't1')""")


@query("load_eval_configs", EVAL_CONFIGS_SQL)
def eval_configs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a config table with one row for each (tenant, workflow, agent) of the traces, those enabled that apply to one
    tenant's workflow; a config without a tenant or a workflow applies to all."""
    from runlens.operators.config import load_eval_configs
    c = load_traces(spark, sf_dir).select("tenant_id", "workflow_id", "agent").distinct()
    rows = c.select(F.when(F.col("agent") != "market", F.col("tenant_id")).alias("tenant_id"),
                    F.when(F.col("agent") != "risk", F.col("workflow_id")).alias("workflow_id"),
                    F.concat("agent", F.lit("_presence")).alias("eval_name"), "agent",
                    F.when(F.col("agent") == "orchestrator", 4).otherwise(3).alias("layer"),
                    ((F.col("agent") != "orchestrator") | (F.col("tenant_id") == "t0")).alias("enabled"))
    return load_eval_configs(rows, 3, "w1", "t1").drop("enabled")


_JUDGED: dict = {}


def _judged_late(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A result table of `_run_late`, which runs once for each application and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _JUDGED:
        _JUDGED[key] = _run_late(spark, sf_dir)
    return _JUDGED[key].results(name)


def _run_late(spark: SparkSession, sf_dir: str):
    """Spans and close events as they come: every seventh span arrives only after its session was closed and judged, and a
    tenth of the spans once more on the next day."""
    from runlens.plans.eval_queries import STANDARD, config_df
    from runlens.sources.adapters import sessions_from_traces
    from runlens.streaming.judge import SessionJudge, stream_judge
    from runlens.streaming.spans import scratch_path, span_store, stream_arrivals, stream_dedupe_spans
    traces, sessions = _inputs(spark, sf_dir)
    spans = traces.withColumn("arrived_at", F.col("created_at"))
    late = F.col("event_id") % 7 == 3
    again = spans.where(F.col("event_id") % 10 == 3).withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY"))
    closes = sessions.select(*K, F.col("completed_at").alias("closed_at"))
    span_in, close_in, store, out, ckpt = (scratch_path(spark, f"late-{x}") for x in ("spans", "closes", "store", "out", "ckpt"))

    def arrive(rows: DataFrame, parts: int) -> None:
        for k in range(parts):                          # what has arrived by then is one micro-batch, of as many files as it has tasks
            rows.where(F.pmod(F.xxhash64("session_id"), F.lit(parts)) == k).write.mode("append").parquet(span_in)
            stream_dedupe_spans(spark.readStream.schema(spans.schema).parquet(span_in), store, f"{ckpt}/spans", buckets=8)

    judge = SessionJudge(span_store(spark, store, spans.schema, 8), out, sessions_from_traces,
                         eval_configs=config_df(spark, STANDARD), buckets=8)

    def work() -> None:
        src = spark.readStream.schema(closes.schema).parquet(close_in)
        stream_judge(src, stream_arrivals(spark, store), judge, f"{ckpt}/judge")

    arrive(spans.where(~late), 2)
    closes.write.mode("append").parquet(close_in)
    work()
    arrive(spans.where(late).unionByName(again), 1)
    work()
    return judge


@query("stream_judge_late", RUN_SQL)
def judge_late_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions judged at their close and again after late spans; the stored incidents equal the batch run."""
    return _judged_late(spark, sf_dir, "incidents").select(*K, "pattern_name", "severity", "cost_wasted", "tokens_wasted", "frame_count")


def _default_evals_sql() -> str:
    from runlens.plans.eval_queries import STANDARD, evals_sql
    return "SELECT tenant_id, session_id, eval_name, agent, score, passed, threshold FROM (" + evals_sql(STANDARD) + ")"


@query("stream_judge_late_evals", _default_evals_sql())
def judge_late_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2, rule evals after late spans."""
    return _judged_late(spark, sf_dir, "evals").select(*K, "eval_name", "agent", "score", "passed", "threshold")
