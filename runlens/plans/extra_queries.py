"""Queries for the remaining library operators (B7, B12, B13, G2, A1 events) over data derived
from the test tables, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.columns import K
from runlens.plans.catalog import _inputs, query
from runlens.plans.judge_queries import BASE_SQL, VERDICT_BODY
from runlens.sources.adapters import OUTCOMES_SQL, SESSIONS_SQL, TRACES_SQL, load_traces, with_sql

AGENT_SPAN_SQL = with_sql(TRACES_SQL, """
SELECT tenant_id, session_id, seq,
       last_value(CASE WHEN step_type = 'llm_call' THEN 'span-' || span_id END IGNORE NULLS)
         OVER (PARTITION BY tenant_id, session_id, agent ORDER BY created_at, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS parent_span_id
FROM traces""")


@query("assign_agent_span", AGENT_SPAN_SQL)
def agent_span_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every llm_call starts a new span of its agent; a step's parent is the agent's most
    recently started span (a start at the same instant counts)."""
    from runlens.operators.shaping import assign_agent_span
    t = load_traces(spark, sf_dir)
    starts = t.filter(F.col("step_type") == "llm_call").select(
        *K, "agent", F.concat(F.lit("span-"), F.col("span_id")).alias("span_start_id"),
        F.col("created_at").alias("started_at"), F.col("seq").alias("start_seq"))
    return assign_agent_span(t, starts).select(*K, "seq", "parent_span_id")


METRICS_SQL = with_sql(TRACES_SQL, SESSIONS_SQL, """
SELECT tenant_id, session_id, CAST(completed_at AS DATE) AS date, total_steps, trades_proposed,
       trades_executed AS trades_approved, trades_executed, CAST(0 AS BIGINT) AS risk_rejections,
       terminal_reason = 'error' AS retry_triggered, CAST(1 AS BIGINT) AS loop_iterations,
       CAST((epoch_us(completed_at) - epoch_us(started_at)) // 1000 AS BIGINT) AS total_latency_ms
FROM sessions""")


@query("session_metrics", METRICS_SQL)
def session_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close figures per session: steps from the traces, latency end - start, date."""
    from runlens.operators.shaping import session_metrics
    traces, sessions = _inputs(spark, sf_dir)
    closes = sessions.select(*K, F.col("started_at"), F.col("completed_at").alias("ended_at"), "trades_proposed",
                             F.col("trades_executed").alias("trades_approved"), "trades_executed",
                             F.lit(0).cast("long").alias("risk_rejections"),
                             (F.col("terminal_reason") == "error").alias("retry_triggered"),
                             F.lit(1).cast("long").alias("loop_iterations"))
    m = session_metrics(traces, closes)
    return m.select(*K, "date", F.col("total_steps").cast("long").alias("total_steps"),
                    F.col("trades_proposed").cast("long").alias("trades_proposed"),
                    F.col("trades_approved").cast("long").alias("trades_approved"),
                    F.col("trades_executed").cast("long").alias("trades_executed"),
                    F.col("risk_rejections").cast("long").alias("risk_rejections"), "retry_triggered",
                    F.col("loop_iterations").cast("long").alias("loop_iterations"), "total_latency_ms")


NORMALIZE_SQL = with_sql(TRACES_SQL, SESSIONS_SQL, """
SELECT tenant_id, session_id, trades_executed, trades_proposed, total_steps,
       strftime(completed_at, '%Y-%m-%d %H:%M:%S.%f') AS completed_at_text
FROM sessions""")


@query("normalize_sessions", NORMALIZE_SQL)
def normalize_sessions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session rows as the logger stores them (figures inside the metadata JSON, `ended_at`
    instead of `completed_at`) normalised back to the columns the engines read."""
    from runlens.operators.shaping import normalize_sessions
    _, s = _inputs(spark, sf_dir)
    raw = s.select(*K, F.col("completed_at").alias("ended_at"),
                   F.to_json(F.struct("trades_executed", "trades_proposed", "total_steps")).alias("metadata"))
    n = normalize_sessions(raw)
    return n.select(*K, "trades_executed", "trades_proposed", "total_steps",
                    F.date_format("completed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("completed_at_text"))


INGEST_EVALS_SQL = with_sql(BASE_SQL + VERDICT_BODY, """
SELECT tenant_id, session_id, eval_name, agent, 4 AS layer, score, passed, CAST(NULL AS DOUBLE) AS threshold,
       'd' || substr(session_id, 2) AS entity_id
FROM res""")


@query("ingest_evals", INGEST_EVALS_SQL)
def ingest_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client-reported eval rows (here the judge results, sent without a layer or threshold)."""
    from runlens.operators.outcomes import ingest_evals
    from runlens.plans.judge_queries import _pipeline
    _, _, res = _pipeline(spark, sf_dir)
    rows = res.select(*K, "eval_name", "agent", "score", "passed", F.col("session_id").alias("entity_id"))
    return ingest_evals(rows).select(*K, "eval_name", "agent", "layer", "score", "passed", "threshold", "entity_id")


EVENTS_SQL = with_sql(TRACES_SQL, """
SELECT md5(session_id) AS trace_id, span_id, 'exception' AS event_name,
       CAST(epoch_us(created_at) * 1000 AS BIGINT) AS event_ns, error AS message
FROM traces WHERE error IS NOT NULL""")


@query("otlp_span_events", EVENTS_SQL)
def otlp_events_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A3: span events (an `exception` event per failing step, string attributes only) survive
    the document round trip and come back as rows."""
    from pyspark.sql import types as T
    from runlens.sources.otlp import (EVENT, encode_attributes, flatten_otlp, flatten_otlp_events,
                                      to_otlp_payloads, traces_to_spans)
    t = load_traces(spark, sf_dir)
    spans = traces_to_spans(t).join(t.select(*K, "seq", "error", "created_at"), K + ["seq"])
    ev_attrs = encode_attributes(spans, {"exception.message": "error"}, string_only=True)
    event = F.struct(F.lit("exception").alias("name"),
                     (F.unix_micros("created_at") * 1000).cast("string").alias("timeUnixNano"),
                     ev_attrs.alias("attributes"))
    spans = spans.withColumn("events", F.when(F.col("error").isNotNull(), F.array(event))
                             .otherwise(F.array().cast(T.ArrayType(EVENT))))
    docs = to_otlp_payloads(spans.drop("error", "created_at"))
    ev = flatten_otlp_events(flatten_otlp(docs.select("body")))
    return ev.filter(F.col("event_name").isNotNull()).select(
        "trace_id", "span_id", "event_name", "event_ns", F.element_at("event_attrs", F.lit("exception.message"))
        .alias("message"))


# ── failed evals on incidents (D12, E3), custom metrics (C11, U1, U2), H1, other link kinds (G4) ──

def _failed_sql(body: str) -> str:
    from runlens.plans.catalog import S_SQL, incidents_sql
    from runlens.plans.eval_queries import PIPELINE, STANDARD, evals_sql
    order = ", ".join(f"('{c.eval_name}', {i})" for i, c in enumerate(STANDARD))
    return ("WITH ev AS (" + evals_sql(STANDARD, PIPELINE) + f"),\no AS (SELECT * FROM (VALUES {order}) v(eval_name, o)),\n"
            "failed AS (SELECT tenant_id, session_id, count(*) AS n_failed, string_agg(agent || '/' || eval_name || '=' || printf('%.2f', score) "
            "|| '<' || printf('%.2f', threshold), '; ' ORDER BY o) AS failed FROM ev JOIN o USING (eval_name) WHERE NOT passed GROUP BY ALL)\n" + body)


def _rule_evals(spark: SparkSession, sf_dir: str):
    from runlens.operators.evals import run_rule_evals
    from runlens.plans.catalog import _inputs
    from runlens.plans.eval_queries import PIPELINE, STANDARD, config_df, params_df
    traces, sessions = _inputs(spark, sf_dir)
    return traces, sessions, run_rule_evals(sessions, traces, config_df(spark, STANDARD), params_df(spark, PIPELINE))


@query("failed_eval_rows", _failed_sql("SELECT * FROM failed"))
def failed_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failed rule evals of every session, in config order."""
    from runlens.operators.detectors import failed_eval_rows
    _, _, ev = _rule_evals(spark, sf_dir)
    shown = F.transform("failed_evals", lambda e: F.format_string("%s/%s=%.2f<%.2f", e["agent"], e["eval_name"], e["score"], e["threshold"]))
    return failed_eval_rows(ev).select(*K, F.size("failed_evals").cast("long").alias("n_failed"), F.array_join(shown, "; ").alias("failed"))


def _summary_sql() -> str:
    from runlens.plans.rca_queries import SUMMARY_SQL
    from runlens.plans.eval_queries import PIPELINE, STANDARD, evals_sql
    return ("WITH summary AS (" + SUMMARY_SQL + "),\nev AS (" + evals_sql(STANDARD, PIPELINE) + "),\n"
            "f AS (SELECT tenant_id, session_id, count(*) AS n FROM ev WHERE NOT passed GROUP BY ALL)\n"
            "SELECT s.tenant_id, s.session_id, s.pattern, s.severity, s.duration_s, coalesce(f.n, 0) AS failed_eval_count "
            "FROM summary s LEFT JOIN f USING (tenant_id, session_id)")


@query("summarize_incidents_with_evals", _summary_sql())
def summary_with_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 with D12: incidents that carry their session's failed evals."""
    from runlens.operators.detectors import run_detectors
    from runlens.operators.rca import summarize_incidents
    traces, sessions, ev = _rule_evals(spark, sf_dir)
    d = run_detectors(traces, sessions, evals=ev)
    return summarize_incidents(d.incidents, sessions, d.frames).select(
        *K, "pattern", "severity", "duration_s", F.col("failed_eval_count").cast("long").alias("failed_eval_count"))


CUSTOM_SQL = with_sql(TRACES_SQL, """
g AS (SELECT tenant_id, session_id, workflow_id, avg(latency_ms) FILTER (WHERE agent = 'research') AS r,
             count(*) FILTER (WHERE agent = 'research') AS n FROM traces GROUP BY ALL)
SELECT tenant_id, session_id, 'speed' AS eval_name, 'research' AS agent,
       CASE WHEN workflow_id = 'w2' THEN 0.25 WHEN n = 0 THEN 0.0 ELSE greatest(0.0, 1 - r / 100) END AS score,
       CASE WHEN workflow_id = 'w2' THEN false WHEN n = 0 THEN false ELSE greatest(0.0, 1 - r / 100) >= 0.5 END AS passed FROM g""")


@query("custom_metrics", CUSTOM_SQL)
def custom_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric over the traces themselves (mean latency of an agent's steps), and another under the
    same name for one workflow."""
    from runlens.operators.evals import run_rule_evals
    from runlens.operators.registry import Registry
    from runlens.plans.catalog import _inputs
    from runlens.plans.eval_queries import Cfg, config_df
    registry = Registry()

    @registry.register("speed", stats={"mean": F.avg("latency_ms")})
    def speed(ctx):
        return F.when(ctx.stat("mean").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), 1 - ctx.stat("mean") / 100)), F.lit("{}")

    @registry.register("speed", workflow_id="w2")
    def fixed(ctx):
        return F.lit(0.25), F.lit("{}")

    traces, sessions = _inputs(spark, sf_dir)
    out = run_rule_evals(sessions, traces, config_df(spark, [Cfg("speed", "custom", "research", 0.5)]), registry=registry)
    return out.select(*K, "eval_name", "agent", "score", "passed")


def _score_sql() -> str:
    from runlens.plans.eval_queries import PIPELINE, STANDARD, evals_sql
    return ("SELECT tenant_id, session_id, score AS qscore FROM (" + evals_sql(STANDARD, PIPELINE)
            + ") WHERE agent = 'research' AND eval_name = 'research_tools'")


@query("quality_score", _score_sql())
def quality_score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: one named score of every session."""
    from runlens.operators.outcomes import quality_score
    _, _, ev = _rule_evals(spark, sf_dir)
    return quality_score(ev, "research", "research_tools")


LINK_KINDS_SQL = with_sql(TRACES_SQL, OUTCOMES_SQL, """
w AS (SELECT DISTINCT tenant_id, 'u' || user_id AS entity_id FROM traces WHERE outcome = 'error' AND agent = 'risk')
SELECT o.event_id, 'left' AS kind FROM outcomes o
UNION ALL SELECT o.event_id, 'left_semi' FROM outcomes o JOIN w USING (tenant_id, entity_id)
UNION ALL SELECT o.event_id, 'left_anti' FROM outcomes o ANTI JOIN w USING (tenant_id, entity_id)""")


@query("link_outcomes_kinds", LINK_KINDS_SQL)
def link_kinds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All outcomes, those with matching work and those without (work: failed steps of one agent)."""
    from runlens.operators.outcomes import link_outcomes, normalize_outcomes
    from runlens.sources.adapters import outcomes_from_events, read_table
    t = load_traces(spark, sf_dir).where("outcome = 'error' AND agent = 'risk'").withColumn("entity_id", F.concat(F.lit("u"), F.col("user_id")))
    o = normalize_outcomes(outcomes_from_events(read_table(spark, sf_dir, "events")))
    out = [link_outcomes(o, t, kind).select("event_id", F.lit(kind).alias("kind")) for kind in ("left", "left_semi", "left_anti")]
    return out[0].unionByName(out[1]).unionByName(out[2])
