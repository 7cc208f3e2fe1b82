"""Ingest (A5-A7) and trace row builders.

Raw logger calls and ingest bodies become rows of the `traces` table; sessions are built from
open/close events. Every step is a projection, an aggregate or an equi-join on the session key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.columns import K, py_round
from runlens.operators.shaping import DEFAULT_MODEL, DEFAULT_RATES, MODEL_PRICES

TRACE_COLUMNS = ["tenant_id", "session_id", "span_id", "parent_span_id", "agent", "step_type", "tool_name",
                 "outcome", "error", "latency_ms", "tokens_input", "tokens_output", "cost_usd", "entity_id",
                 "payload", "created_at"]

RAW_FIELDS = {
    "tenant_id": T.StringType(), "session_id": T.StringType(), "kind": T.StringType(), "agent": T.StringType(),
    "created_at": T.TimestampType(), "span_id": T.StringType(), "parent_span_id": T.StringType(),
    "entity_id": T.StringType(), "tool_name": T.StringType(), "tool_input": T.StringType(),
    "tool_output": T.StringType(), "reasoning": T.StringType(), "outcome": T.StringType(), "error": T.StringType(),
    "detail": T.StringType(), "reason": T.StringType(), "skip_type": T.StringType(), "latency_ms": T.LongType(),
    "tokens_input": T.LongType(), "tokens_output": T.LongType(), "model": T.StringType(), "seq": T.LongType(),
}


def _ensure(df: DataFrame, fields: dict[str, T.DataType]) -> DataFrame:
    missing = [F.lit(None).cast(t).alias(n) for n, t in fields.items() if n not in df.columns]
    return df.select("*", *missing) if missing else df


def _jstr(c: Column) -> Column:
    """JSON text of a scalar (a quoted, escaped string), null for null."""
    return F.when(c.isNotNull(), F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1))


def _wrap_object(c: Column) -> Column:
    """B1: a tool output that is not a JSON object is stored as {"value": <output>}; text that is no JSON at all is
    a string there."""
    known = F.try_parse_json(c).isNotNull()
    is_obj = F.regexp_like(F.coalesce(c, F.lit("")), F.lit(r"^\s*\{"))
    value = F.when(known, c).otherwise(_jstr(c))
    return F.when(c.isNull(), F.lit(None)).when(known & is_obj, c).otherwise(F.concat(F.lit('{"value":'), value, F.lit("}")))


def _price(model: Column, ti: Column, to: Column) -> Column:
    """Per-trace cost, rounded to 8 places (prices are fixed values, see shaping.MODEL_PRICES)."""
    rate_in = F.lit(DEFAULT_RATES[0])
    rate_out = F.lit(DEFAULT_RATES[1])
    for name, i, o, _, _ in reversed(MODEL_PRICES):
        rate_in = F.when(model == name, F.lit(i)).otherwise(rate_in)
        rate_out = F.when(model == name, F.lit(o)).otherwise(rate_out)
    return py_round((ti * rate_in + to * rate_out) / 1_000_000, 8)


def log_rows(raw: DataFrame, default_model: str = DEFAULT_MODEL) -> DataFrame:
    """Logger calls -> trace rows. `kind` is tool_call | agent_message | decision | skip | error.

    Payload keys follow the logger: span_id, parent_span_id, entity_id, date, sequence, model, then
    tool_input / tool_output / agent_reasoning when present, then a skip's reason and skip_type at
    the top level. `date` is the trace's own date (the logger writes the current date)."""
    r = _ensure(raw, RAW_FIELDS)
    kind = F.col("kind")
    step = F.when(kind.isin("tool_call", "agent_message", "decision", "skip", "error"), kind)
    outcome = (F.when(kind == "skip", F.lit("skipped")).when(kind == "error", F.lit("error"))
               .when(kind.isin("agent_message", "decision"), F.col("outcome")))
    ti = F.when(kind == "agent_message", F.coalesce(F.col("tokens_input"), F.lit(0))).otherwise(F.lit(0))
    to = F.when(kind == "agent_message", F.coalesce(F.col("tokens_output"), F.lit(0))).otherwise(F.lit(0))
    latency = F.when(kind.isin("tool_call", "agent_message", "decision"),
                     F.coalesce(F.col("latency_ms"), F.lit(0))).otherwise(F.lit(0))
    model = F.coalesce(F.nullif(F.col("model"), F.lit("")), F.lit(default_model))
    tool_out = F.when(kind == "tool_call", _wrap_object(F.col("tool_output"))).when(kind == "decision", F.col("detail"))
    head = F.to_json(F.struct(F.col("span_id"), F.col("parent_span_id"),
                              F.when(kind.isin("tool_call", "agent_message", "error"), F.col("entity_id"))
                              .alias("entity_id"),
                              F.to_date("created_at").alias("date"), F.col("seq").alias("sequence"),
                              model.alias("model")), {"ignoreNullFields": "false"})
    extras = [
        F.when((kind == "tool_call") & F.col("tool_input").isNotNull(),
               F.concat(F.lit(',"tool_input":'), F.col("tool_input"))),
        F.when(tool_out.isNotNull(), F.concat(F.lit(',"tool_output":'), tool_out)),
        F.when((kind == "agent_message") & F.col("reasoning").isNotNull(),
               F.concat(F.lit(',"agent_reasoning":'), _jstr(F.col("reasoning")))),
        F.when(kind == "skip", F.concat(F.lit(',"reason":'), F.coalesce(_jstr(F.col("reason")), F.lit("null")),
                                        F.lit(',"skip_type":'),
                                        _jstr(F.coalesce(F.col("skip_type"), F.lit("design"))))),
    ]
    body = F.concat_ws("", *[F.coalesce(e, F.lit("")) for e in extras])
    payload = F.concat(F.regexp_replace(head, r"\}$", ""), body, F.lit("}"))
    return r.select(
        "tenant_id", "session_id", "span_id", "parent_span_id",
        F.coalesce(F.col("agent"), F.lit("orchestrator")).alias("agent"),
        step.alias("step_type"),
        F.when(kind == "tool_call", F.col("tool_name")).alias("tool_name"),
        outcome.alias("outcome"),
        F.when(kind == "error", F.col("error")).alias("error"),
        latency.cast("long").alias("latency_ms"), ti.cast("long").alias("tokens_input"),
        to.cast("long").alias("tokens_output"),
        F.when((ti != 0) | (to != 0), _price(model, ti, to)).alias("cost_usd"),
        F.when(kind.isin("tool_call", "agent_message", "error"), F.col("entity_id")).alias("entity_id"),
        payload.alias("payload"), "created_at", "seq",
    )


def skip_summary(traces: DataFrame) -> DataFrame:
    """B4 companion: skips per (agent, skip_type)."""
    st = F.coalesce(F.get_json_object("payload", "$.skip_type"), F.lit("design"))
    return traces.filter(F.col("step_type") == "skip").groupBy("agent", st.alias("skip_type")).count()


# ── A5: ingest bodies ──────────────────────────────────────────────────────────────────────────

def fresh_span_id(*key: Column) -> Column:
    """A deterministic 16-hex id from the row's source position, so a rerun yields the same id."""
    return F.substring(F.sha2(F.concat_ws("|", *key), 256), 1, 16)


def ingest_traces(raw: DataFrame, id_key: list[Column] | None = None) -> DataFrame:
    """A5: normalise ingest bodies to the trace schema; a span without id (null or blank) gets one (16 hex) built
    from `id_key`, a parent id is kept. The default key is the whole body and, for repeated bodies, the position
    among its equals, so it works for any source and a rerun gives the same ids."""
    if id_key is None:
        body = F.to_json(F.struct(*raw.columns))
        raw = raw.withColumn("_body", body).withColumn("_nth", F.when(
            ~has_id() if "span_id" in raw.columns else F.lit(True),
            F.row_number().over(Window.partitionBy(F.xxhash64("_body"), F.col("_body")).orderBy(F.lit(1)))))
        id_key = [F.col("_body"), F.col("_nth").cast("string")]
    fields = {"tenant_id": T.StringType(), "session_id": T.StringType(), "span_id": T.StringType(),
              "parent_span_id": T.StringType(), "agent": T.StringType(), "step_type": T.StringType(),
              "tool_name": T.StringType(), "outcome": T.StringType(), "error": T.StringType(),
              "latency_ms": T.LongType(), "tokens_input": T.LongType(), "tokens_output": T.LongType(),
              "cost_usd": T.DoubleType(), "entity_id": T.StringType(), "output_json": T.StringType(),
              "created_at": T.TimestampType()}
    r = _ensure(raw, fields)
    sid = F.when(has_id(), F.col("span_id")).otherwise(fresh_span_id(*id_key))
    extra = [c for c in raw.columns if c not in fields and not c.startswith("_")]
    return r.select(*[F.col(n).cast(t).alias(n) for n, t in fields.items() if n != "span_id"],
                    sid.alias("span_id"), (~has_id()).alias("id_generated"),
                    *extra)


def has_id(span_id: str = "span_id") -> Column:
    """A span id that is neither null nor blank."""
    return F.coalesce(F.trim(F.col(span_id)) != "", F.lit(False))


# ── A6: idempotent upsert ──────────────────────────────────────────────────────────────────────

def dedupe_spans(traces: DataFrame, arrival: str = "arrived_at") -> DataFrame:
    """One row per (tenant_id, session_id, span_id), the latest arrival winning (an upsert, ties by the row's
    hash); rows without a span id (null or blank) are never collapsed. The winner is a row number with a
    limit of one, so Spark keeps one row per key and task before the shuffle, and rows travel once."""
    keyed, free = traces.filter(has_id()), traces.filter(~has_id())
    newest = Window.partitionBy("tenant_id", "session_id", "span_id").orderBy(
        F.col(arrival).desc_nulls_last(), F.xxhash64(*[f.name for f in traces.schema if not isinstance(f.dataType, T.MapType)]).desc())
    return keyed.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth").unionByName(free)


# ── A7: session open/close upsert ─────────────────────────────────────────────────────────────

def upsert_sessions(opens: DataFrame, closes: DataFrame) -> DataFrame:
    """An open event inserts an `in_progress` stub, duplicates ignored (first arrival wins);
    the last close event of a session fills in its close fields."""
    o = opens.groupBy(*K).agg(F.min_by(F.struct("workflow_id", "started_at", "session_type"),
                                       F.col("arrived_at")).alias("_o"))
    o = o.select(*K, "_o.workflow_id", "_o.started_at", "_o.session_type")
    c = closes.groupBy(*K).agg(F.max_by(F.struct("terminal_reason", "ended_at", "result_summary"),
                                        F.col("arrived_at")).alias("_c"))
    c = c.select(*K, "_c.terminal_reason", "_c.ended_at", "_c.result_summary")
    j = o.join(c, K, "left")
    closed = F.col("ended_at").isNotNull()
    return j.select(*K, "workflow_id", "started_at", "session_type",
                    F.when(closed, F.lit("completed")).otherwise(F.lit("in_progress")).alias("status"),
                    F.when(closed, F.col("terminal_reason")).otherwise(F.lit("in_progress")).alias("terminal_reason"),
                    "ended_at", "result_summary")
