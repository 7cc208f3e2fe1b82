"""OTLP queries (A1-A4): traces -> OTLP documents -> spans -> traces, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.plans.catalog import query
from runlens.sources.adapters import TRACES_SQL, load_traces, with_sql


def _docs(spark: SparkSession, sf_dir: str):
    from runlens.sources.otlp import to_otlp_payloads, traces_to_spans
    spans = traces_to_spans(load_traces(spark, sf_dir))
    return to_otlp_payloads(spans, per_batch=250)


PAYLOAD_SQL = with_sql(TRACES_SQL, """
SELECT tenant_id, md5(session_id) AS trace_id, (seq - 1) // 250 AS batch_no, CAST(count(*) AS INTEGER) AS n_spans
FROM traces GROUP BY ALL""")


@query("otlp_payloads", PAYLOAD_SQL)
def payloads_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2-A3: spans batched into OTLP JSON documents, at most 250 per document."""
    return _docs(spark, sf_dir).select("tenant_id", "trace_id", "batch_no", "n_spans")


ROUND_SQL = with_sql(TRACES_SQL, """
SELECT tenant_id, md5(session_id) AS session_id, span_id, agent,
       CASE step_type WHEN 'tool_call' THEN 'tool_call' WHEN 'decision' THEN 'decision' ELSE 'agent_message' END AS step_type,
       CASE WHEN step_type = 'tool_call' THEN tool_name END AS tool_name,
       CASE WHEN outcome IS NOT DISTINCT FROM 'error' OR nullif(trim(error), '') IS NOT NULL THEN 'error' ELSE 'success' END AS outcome,
       error, latency_ms, tokens_input, tokens_output, CAST(epoch_us(created_at) AS BIGINT) AS created_us
FROM traces""")


@query("otlp_round_trip", ROUND_SQL)
def round_trip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A4 over A2: parsing the documents gives back every span as an agent trace."""
    from runlens.sources.otlp import flatten_otlp, otlp_to_traces
    t = otlp_to_traces(flatten_otlp(_docs(spark, sf_dir)))
    return t.select("tenant_id", "session_id", "span_id", "agent", "step_type", "tool_name", "outcome", "error", "latency_ms",
                    "tokens_input", "tokens_output", F.unix_micros("created_at").alias("created_us"))
