"""Ingest and shaping queries (A5-A7, B1-B11) over `events`, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.columns import K, py_round_sql
from runlens.plans.catalog import _inputs, query
from runlens.sources.adapters import SESSIONS_SQL, TRACES_SQL, duplicated_traces, load_traces, with_sql

BASE = [TRACES_SQL]

# ── B1-B5: logger calls -> trace rows ─────────────────────────────────────────────────────────


def _raw_calls(traces: DataFrame) -> DataFrame:
    """Logger calls derived from the events: view -> agent_message, click -> tool_call,
    purchase -> decision, signup -> skip, error -> error."""
    ev = traces
    kind = (F.when(F.col("step_type") == "llm_call", "agent_message")
            .when((F.col("step_type") == "tool_call") & (F.col("outcome") == "error"), "error")
            .when(F.col("step_type") == "tool_call", "tool_call")
            .when(F.col("step_type") == "decision", "decision")
            .otherwise("skip"))
    models = F.array(F.lit("claude-sonnet-4-6"), F.lit(None).cast("string"), F.lit("gpt-4o"), F.lit("claude-opus-4-7"))
    return ev.select(
        *K, kind.alias("kind"), "agent", "created_at", "span_id", "seq",
        F.concat(F.lit("u"), F.col("user_id")).alias("entity_id"),
        "tool_name",
        F.format_string('{"event": %d}', F.col("event_id")).alias("tool_input"),
        F.when(F.col("event_id") % 2 == 0, F.format_string('{"rows": %d}', F.col("latency_ms")))
         .otherwise(F.format_string('"row %d"', F.col("latency_ms"))).alias("tool_output"),
        F.concat(F.lit("step "), F.col("event_id")).alias("reasoning"),
        F.lit("approved").alias("outcome"),
        F.col("error"),
        F.format_string('{"value": %d}', F.col("latency_ms")).alias("detail"),
        F.lit("no_candidates").alias("reason"),
        F.when(F.col("event_id") % 2 == 0, F.lit("error")).alias("skip_type"),
        "latency_ms", "tokens_input", "tokens_output",
        F.element_at(models, (F.col("event_id") % 4 + 1).cast("int")).alias("model"),
    )


LOG_SQL = with_sql(TRACES_SQL, """
raw AS (
  SELECT *, CASE WHEN step_type = 'llm_call' THEN 'agent_message'
                 WHEN step_type = 'tool_call' AND outcome = 'error' THEN 'error'
                 WHEN step_type = 'tool_call' THEN 'tool_call'
                 WHEN step_type = 'decision' THEN 'decision' ELSE 'skip' END AS kind,
         'u' || user_id AS ent,
         CASE event_id % 4 WHEN 0 THEN 'claude-sonnet-4-6' WHEN 2 THEN 'gpt-4o' WHEN 3 THEN 'claude-opus-4-7'
              ELSE 'claude-haiku-4-5-20251001' END AS mdl
  FROM traces),
b AS (
  SELECT *, CASE WHEN kind = 'agent_message' THEN tokens_input ELSE 0 END AS ti,
            CASE WHEN kind = 'agent_message' THEN tokens_output ELSE 0 END AS tout
  FROM raw),
rates AS (SELECT * FROM (VALUES ('claude-haiku-4-5-20251001', 0.80, 4.00), ('claude-sonnet-4-6', 3.00, 15.00),
                                ('claude-opus-4-7', 15.00, 75.00)) v(model, ri, ro))
SELECT b.tenant_id, b.session_id, b.seq, b.kind AS step_type,
       CASE b.kind WHEN 'skip' THEN 'skipped' WHEN 'error' THEN 'error' WHEN 'agent_message' THEN 'approved'
                   WHEN 'decision' THEN 'approved' END AS outcome,
       CASE WHEN b.kind = 'error' THEN b.error END AS error,
       CAST(CASE WHEN b.kind IN ('tool_call', 'agent_message', 'decision') THEN b.latency_ms ELSE 0 END AS BIGINT) AS latency_ms,
       CAST(b.ti AS BIGINT) AS tokens_input, CAST(b.tout AS BIGINT) AS tokens_output,
       CASE WHEN b.ti <> 0 OR b.tout <> 0 THEN
         CAST(printf('%.8f', (b.ti * CAST(coalesce(r.ri, 3.00) AS DOUBLE) + b.tout * CAST(coalesce(r.ro, 15.00) AS DOUBLE)) / 1000000) AS DOUBLE) END AS cost_usd,
       regexp_replace(CAST(json_object('span_id', b.span_id, 'parent_span_id', CAST(NULL AS VARCHAR),
                                  'entity_id', CASE WHEN b.kind IN ('tool_call', 'agent_message', 'error') THEN b.ent END,
                                  'date', CAST(b.created_at AS DATE), 'sequence', b.seq, 'model', b.mdl) AS VARCHAR), '}$', '')
         || CASE WHEN b.kind = 'tool_call' THEN ',"tool_input":{"event": ' || b.event_id || '}' ELSE '' END
         || CASE WHEN b.kind = 'tool_call' THEN ',"tool_output":' ||
              CASE WHEN b.event_id % 2 = 0 THEN '{"rows": ' || b.latency_ms || '}' ELSE '{"value":"row ' || b.latency_ms || '"}' END
                 WHEN b.kind = 'decision' THEN ',"tool_output":{"value": ' || b.latency_ms || '}' ELSE '' END
         || CASE WHEN b.kind = 'agent_message' THEN ',"agent_reasoning":"step ' || b.event_id || '"' ELSE '' END
         || CASE WHEN b.kind = 'skip' THEN ',"reason":"no_candidates","skip_type":"'
                 || CASE WHEN b.event_id % 2 = 0 THEN 'error' ELSE 'design' END || '"' ELSE '' END
         || '}' AS payload
FROM b LEFT JOIN rates r ON r.model = b.mdl""")


@query("log_rows", LOG_SQL)
def log_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logger calls of five kinds become trace rows with the logger's payload."""
    from runlens.sources.ingest import log_rows
    t = log_rows(_raw_calls(load_traces(spark, sf_dir)))
    return t.select(*K, "seq", "step_type", "outcome", "error", "latency_ms", "tokens_input", "tokens_output",
                    "cost_usd", "payload")


SKIP_SQL = with_sql(TRACES_SQL, """
k AS (SELECT agent, CASE WHEN event_id % 2 = 0 THEN 'error' ELSE 'design' END AS skip_type FROM traces
      WHERE NOT (step_type IN ('llm_call', 'tool_call', 'decision')))
SELECT agent, skip_type, count(*) AS count FROM k GROUP BY ALL""")


@query("skip_summary", SKIP_SQL)
def skip_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skips per agent and skip type."""
    from runlens.sources.ingest import log_rows, skip_summary
    return skip_summary(log_rows(_raw_calls(load_traces(spark, sf_dir))))


# ── A5: ingest bodies get ids ──────────────────────────────────────────────────────────────────

INGEST_SQL = with_sql(TRACES_SQL, """
SELECT tenant_id, session_id, event_id,
       CASE WHEN event_id % 50 = 1 THEN substr(sha256('events|' || event_id), 1, 16) ELSE span_id END AS span_id,
       event_id % 50 = 1 AS id_generated
FROM traces""")


@query("ingest_traces", INGEST_SQL)
def ingest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: spans that arrive without an id get a deterministic 16-hex id."""
    from runlens.sources.ingest import ingest_traces
    t = load_traces(spark, sf_dir)
    raw = t.withColumn("span_id", F.when(F.col("event_id") % 50 != 1, F.col("span_id")))
    out = ingest_traces(raw, id_key=[F.lit("events"), F.col("event_id").cast("string")])
    return out.select(*K, "event_id", "span_id", "id_generated")


# ── A6: dedupe ─────────────────────────────────────────────────────────────────────────────────

DEDUPE_SQL = with_sql(TRACES_SQL, """
dup AS (SELECT *, created_at AS arrived_at FROM traces
        UNION ALL SELECT *, created_at + INTERVAL 1 SECOND FROM traces WHERE event_id % 10 = 0),
dup2 AS (SELECT * REPLACE (CASE WHEN event_id % 50 = 1 THEN NULL ELSE span_id END AS span_id) FROM dup),
allrows AS (SELECT * FROM dup2 UNION ALL SELECT * FROM dup2 WHERE event_id % 50 = 1),
keyed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id, span_id
                                                      ORDER BY arrived_at DESC) AS r
                         FROM allrows WHERE span_id IS NOT NULL) WHERE r = 1)
SELECT tenant_id, session_id, span_id, event_id, CAST(floor(epoch(arrived_at)) AS BIGINT) AS arrived_s FROM keyed
UNION ALL
SELECT tenant_id, session_id, span_id, event_id, CAST(floor(epoch(arrived_at)) AS BIGINT) FROM allrows WHERE span_id IS NULL""")


@query("dedupe_spans", DEDUPE_SQL)
def dedupe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retried spans collapse to their latest arrival; id-less spans all stay."""
    from runlens.sources.ingest import dedupe_spans
    d = dedupe_spans(duplicated_traces(load_traces(spark, sf_dir)))
    return d.select(*K, "span_id", "event_id", F.unix_seconds("arrived_at").alias("arrived_s"))


# ── A7: sessions from open/close events ────────────────────────────────────────────────────────

def _open_close(traces: DataFrame):
    s = traces.groupBy(*K, "workflow_id", "user_id").agg(
        F.min("created_at").alias("started_at"), F.max("created_at").alias("ended_at"),
        F.count(F.lit(1)).alias("steps"))
    opens = s.select(*K, "workflow_id", "started_at", F.lit("batch").alias("session_type"),
                     F.col("started_at").alias("arrived_at"))
    reopen = s.filter(F.col("user_id") % 7 == 0).select(
        *K, F.lit("w_other").alias("workflow_id"), "started_at", F.lit("retry").alias("session_type"),
        (F.col("started_at") + F.expr("INTERVAL 5 SECONDS")).alias("arrived_at"))
    reasons = F.element_at(F.array(*[F.lit(x) for x in ["completed", "error", "partial", "", "abandoned"]]),
                           (F.col("user_id") % 5 + 1).cast("int"))
    closes = s.filter(F.col("user_id") % 5 != 3).select(
        *K, reasons.alias("terminal_reason"), "ended_at",
        F.concat(F.col("steps"), F.lit(" steps")).alias("result_summary"), F.col("ended_at").alias("arrived_at"))
    reclose = s.filter((F.col("user_id") % 5 != 3) & (F.col("user_id") % 11 == 0)).select(
        *K, F.lit("retried").alias("terminal_reason"), "ended_at", F.lit("again").alias("result_summary"),
        (F.col("ended_at") + F.expr("INTERVAL 5 SECONDS")).alias("arrived_at"))
    return opens.unionByName(reopen), closes.unionByName(reclose)


UPSERT_SQL = with_sql(TRACES_SQL, """
s AS (SELECT tenant_id, session_id, workflow_id, user_id, min(created_at) AS started_at, max(created_at) AS ended_at,
             count(*) AS steps FROM traces GROUP BY ALL),
c AS (SELECT tenant_id, session_id,
             CASE WHEN user_id % 11 = 0 THEN 'retried' ELSE
               CASE user_id % 5 WHEN 0 THEN 'completed' WHEN 1 THEN 'error' WHEN 2 THEN 'partial' ELSE 'abandoned' END
             END AS terminal_reason,
             CASE WHEN user_id % 11 = 0 THEN 'again' ELSE steps || ' steps' END AS result_summary
      FROM s WHERE user_id % 5 <> 3)
SELECT s.tenant_id, s.session_id, s.workflow_id, 'batch' AS session_type,
       CASE WHEN c.session_id IS NULL THEN 'in_progress' ELSE 'completed' END AS status,
       coalesce(c.terminal_reason, 'in_progress') AS terminal_reason, c.result_summary
FROM s LEFT JOIN c USING (tenant_id, session_id)""")


@query("upsert_sessions", UPSERT_SQL)
def upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First open wins, last close fills in the session."""
    from runlens.sources.ingest import upsert_sessions
    opens, closes = _open_close(load_traces(spark, sf_dir))
    u = upsert_sessions(opens, closes)
    return u.select(*K, "workflow_id", "session_type", "status", "terminal_reason", "result_summary")


# ── B6, B8: sequence and parents ──────────────────────────────────────────────────────────────

@query("assign_sequence", with_sql(TRACES_SQL, "SELECT tenant_id, session_id, event_id, seq FROM traces"))
def sequence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-based step number per session by (time, arrival)."""
    return load_traces(spark, sf_dir).select(*K, "event_id", "seq")


PARENT_SQL = with_sql(TRACES_SQL, """
SELECT tenant_id, session_id, seq,
       coalesce(CASE WHEN event_id % 13 = 0 THEN 'caller-' || event_id END,
                lag(span_id) OVER (PARTITION BY tenant_id, session_id, agent ORDER BY created_at, seq),
                'root-' || session_id) AS parent_span_id
FROM traces""")


@query("assign_parent_spans", PARENT_SQL)
def parent_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """caller's parent, else the agent's previous span, else the session span."""
    from runlens.operators.shaping import assign_parent_spans
    t = load_traces(spark, sf_dir).withColumn(
        "parent_trace_id", F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("caller-"), F.col("event_id"))))
    roots = t.select(*K).distinct().withColumn("session_span_id", F.concat(F.lit("root-"), F.col("session_id")))
    return assign_parent_spans(t, roots).select(*K, "seq", "parent_span_id")


# ── B9-B11: pricing and rollups ───────────────────────────────────────────────────────────────

MODEL_RULE = ("element_at(array('claude-haiku-4-5-20251001', 'claude-sonnet-4-6', 'claude-opus-4-7', 'gpt-4o', NULL), "
              "CAST(event_id % 5 + 1 AS INT))")

PRICES_SQL = """
rates AS (SELECT * FROM (VALUES ('claude-haiku-4-5-20251001', 0.80, 4.00, 0.08, 1.00),
                                ('claude-sonnet-4-6', 3.00, 15.00, 0.30, 3.75),
                                ('claude-opus-4-7', 15.00, 75.00, 1.50, 18.75)) v(model, ri, ro, rcr, rcw))"""

COST_SQL = with_sql(TRACES_SQL, PRICES_SQL, f"""
m AS (SELECT *, coalesce({MODEL_RULE.replace('element_at', 'list_extract').replace('array(', '[').replace(', NULL)', ', NULL]')},
                         'claude-haiku-4-5-20251001') AS model FROM traces)
SELECT m.tenant_id, m.session_id, m.seq, m.model,
       CASE WHEN coalesce(tokens_input, 0) <> 0 OR coalesce(tokens_output, 0) <> 0 THEN
         CAST(printf('%.8f', (coalesce(tokens_input, 0) * CAST(coalesce(r.ri, 3.0) AS DOUBLE)
                + coalesce(tokens_output, 0) * CAST(coalesce(r.ro, 15.0) AS DOUBLE)) / 1000000) AS DOUBLE) END AS cost_usd
FROM m LEFT JOIN rates r USING (model)""")


@query("estimate_cost", COST_SQL)
def cost_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-trace price by model (unknown model -> default rates), null without tokens."""
    from runlens.operators.shaping import estimate_cost, model_prices
    t = load_traces(spark, sf_dir).withColumn("model", F.expr(MODEL_RULE))
    return estimate_cost(t, model_prices(spark)).select(*K, "seq", "model", "cost_usd")


ROLLUP_SQL = with_sql(TRACES_SQL, f"""
a AS (SELECT tenant_id, session_id, agent, sum(tokens_input) AS i, sum(tokens_output) AS o,
             sum(tokens_input // 10) AS cr, sum(CASE WHEN step_type = 'decision' THEN 100 ELSE 0 END) AS cw,
             min(seq) AS fs
      FROM traces WHERE step_type IN ('llm_call', 'decision') GROUP BY ALL),
c AS (SELECT *, {py_round_sql("(i * 0.80e0 + o * 4.00e0 + cr * 0.08e0 + cw * 1.00e0) / 1000000", 6)} AS cost FROM a)
SELECT tenant_id, session_id, CAST(sum(i) AS BIGINT) AS total_tokens_input, CAST(sum(o) AS BIGINT) AS total_tokens_output,
       {py_round_sql("sum(cost)", 6)} AS total_cost_usd,
       string_agg(agent, ',' ORDER BY fs) AS agents_invoked, count(*) AS n_agents
FROM c GROUP BY ALL""")


@query("session_rollup", ROLLUP_SQL)
def rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token usage per agent priced with the default model, session totals."""
    from runlens.operators.shaping import accumulate_tokens, model_prices, session_rollup
    t = load_traces(spark, sf_dir).filter(F.col("step_type").isin("llm_call", "decision"))
    usage = t.select(*K, "agent", "seq", F.col("tokens_input").alias("input_tokens"),
                     F.col("tokens_output").alias("output_tokens"),
                     F.expr("tokens_input div 10").alias("cache_read_input_tokens"),
                     F.when(F.col("step_type") == "decision", 100).otherwise(0).alias("cache_creation_input_tokens"))
    r = session_rollup(accumulate_tokens(usage), model_prices(spark))
    return r.select(*K, "total_tokens_input", "total_tokens_output", "total_cost_usd",
                    F.array_join("agents_invoked", ",").alias("agents_invoked"),
                    F.size("agents_invoked").cast("long").alias("n_agents"))


SESSIONS_Q_SQL = with_sql(TRACES_SQL, SESSIONS_SQL, "SELECT * EXCLUDE (started_at, completed_at) FROM sessions")


@query("sessions_from_traces", SESSIONS_Q_SQL)
def sessions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session rows (tokens, cost, trades, terminal reason) grouped from the traces."""
    _, s = _inputs(spark, sf_dir)
    return s.drop("started_at", "completed_at")
