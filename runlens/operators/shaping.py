"""Trace and session shaping (B6-B13): sequence numbers, span parents, pricing, rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.columns import K, py_round

# USD per million tokens by model, and the rates for any other model.
MODEL_PRICES = [
    ("claude-haiku-4-5-20251001", 0.80, 4.00, 0.08, 1.00),
    ("claude-sonnet-4-6", 3.00, 15.00, 0.30, 3.75),
    ("claude-opus-4-7", 15.00, 75.00, 1.50, 18.75),
]
DEFAULT_RATES = (3.00, 15.00, 0.30, 3.75)
DEFAULT_MODEL = "claude-haiku-4-5-20251001"

PRICE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("input_rate", T.DoubleType()),
    T.StructField("output_rate", T.DoubleType()),
    T.StructField("cache_read_rate", T.DoubleType()),
    T.StructField("cache_write_rate", T.DoubleType()),
])


def model_prices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_PRICES, PRICE_SCHEMA)


# ── B6 / B18: step numbers ───────────────────────────────────────────────────────────────────

def assign_sequence(traces: DataFrame, order: list[str] | None = None, name: str = "seq",
                    bucket_seconds: int | None = 3_600) -> DataFrame:
    """1-based step number per session by time, then arrival.

    A single window per session would put one huge session in one task. Instead the steps are
    numbered inside (session, time bucket) and shifted by the number of steps in the session's
    earlier buckets (a running sum over the small per-bucket count table). `order[0]` must be
    the timestamp; null times come first, as in the plain window."""
    order = order or ["created_at"]
    sort = [F.col(c).asc_nulls_first() for c in order]
    if not bucket_seconds:
        return traces.withColumn(name, F.row_number().over(Window.partitionBy(*K).orderBy(*sort)))
    b = F.coalesce(F.floor(F.unix_micros(F.col(order[0]).cast("timestamp")) / (bucket_seconds * 1_000_000)),
                   F.lit(-(1 << 62))).cast("long")
    t = traces.withColumn("_sb", b)
    counts = t.groupBy(*K, "_sb").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*K).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*K, "_sb", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy(*K, "_sb").orderBy(*sort))
    return (t.withColumn("_local", local).join(offsets, K + ["_sb"])
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("int")).drop("_sb", "_local", "_off"))


# ── B7 / B8: span parents ─────────────────────────────────────────────────────────────────────

def _hour_bucket(ts: str, bucket_seconds: int) -> Column:
    return F.coalesce(F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (bucket_seconds * 1_000_000)),
                      F.lit(-(1 << 62))).cast("long")


def assign_agent_span(traces: DataFrame, span_starts: DataFrame, bucket_seconds: int | None = 3_600) -> DataFrame:
    """A step's parent is the most recent span its agent started before it (a start at the
    same instant counts). `span_starts` has (tenant_id, session_id, agent, span_start_id,
    started_at). The carry-forward runs inside (session, agent, hour) buckets; the last start of
    earlier buckets comes from a running window over the small per-bucket table."""
    marks = span_starts.select(*K, "agent", F.col("started_at").alias("_t"), F.lit(0).alias("_k"),
                               F.lit(None).cast("long").alias("seq"), "span_start_id")
    rows = traces.select("*", F.col("created_at").alias("_t"), F.lit(1).alias("_k"),
                         F.lit(None).cast("string").alias("span_start_id"))
    u = rows.unionByName(marks, allowMissingColumns=True)
    u = u.withColumn("_ak", F.coalesce(F.col("agent"), F.lit("\u0000")))   # None is an agent key too
    part = [*K, "_ak"]
    order = [F.col("_t").asc_nulls_first(), F.col("_k"), F.col("seq").asc_nulls_first()]
    if not bucket_seconds:
        w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = u.withColumn("parent_span_id", F.last("span_start_id", ignorenulls=True).over(w))
        return out.filter(F.col("_k") == 1).drop("_t", "_k", "span_start_id", "_ak")
    u = u.withColumn("_sb", _hour_bucket("_t", bucket_seconds))
    last_in = (u.groupBy(*part, "_sb")
               .agg(F.max_by("span_start_id", F.when(F.col("span_start_id").isNotNull(),
                                                     F.struct(F.col("_t"), F.col("_k"), F.col("seq")))).alias("_lm")))
    carry_w = Window.partitionBy(*part).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in.select(*part, "_sb", F.last("_lm", ignorenulls=True).over(carry_w).alias("_carry"))
    w = Window.partitionBy(*part, "_sb").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (u.withColumn("_local", F.last("span_start_id", ignorenulls=True).over(w))
           .join(carry, part + ["_sb"])
           .withColumn("parent_span_id", F.coalesce(F.col("_local"), F.col("_carry"))))
    return out.filter(F.col("_k") == 1).drop("_t", "_k", "span_start_id", "_ak", "_sb", "_local", "_carry")


def assign_parent_spans(traces: DataFrame, session_spans: DataFrame | None = None,
                        bucket_seconds: int | None = 3_600) -> DataFrame:
    """The caller's parent if given; else the agent's previous span; else the session span.
    The previous span comes from a one-row frame in the bucketed rolling window (no hot partition)."""
    from runlens.operators.history import rolling
    t = traces.withColumn("_ak", F.coalesce(F.col("agent"), F.lit("\u0000")))
    bucket = _hour_bucket("created_at", bucket_seconds) if bucket_seconds else None
    t = rolling(t, [*K, "_ak"], ["created_at", "seq"], 1, {"_prev": lambda w: F.first("span_id").over(w)},
                bucket, include_current=False, carry=["span_id"]).drop("_ak")
    if session_spans is not None:
        t = t.join(session_spans.select(*K, "session_span_id"), K, "left")
        parent = F.coalesce(F.col("parent_trace_id"), F.col("_prev"), F.col("session_span_id"))
        return t.withColumn("parent_span_id", parent).drop("session_span_id", "_prev")
    return t.withColumn("parent_span_id", F.coalesce(F.col("parent_trace_id"), F.col("_prev"))).drop("_prev")


# ── B9 / B10 / B11: pricing and token rollups ───────────────────────────────────────────────

def _rates(df: DataFrame, prices: DataFrame, model_col: str) -> DataFrame:
    from runlens.operators.config import config_table
    p = config_table(prices).withColumnRenamed("model", "_pm")
    j = df.join(p, df[model_col] == p["_pm"], "left").drop("_pm")
    for c, d in zip(["input_rate", "output_rate", "cache_read_rate", "cache_write_rate"], DEFAULT_RATES):
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(d)))
    return j


def estimate_cost(traces: DataFrame, prices: DataFrame, default_model: str = DEFAULT_MODEL) -> DataFrame:
    """Per-trace cost, rounded to 8 places; null when both token counts are 0."""
    t = traces.withColumn("model", F.coalesce(F.nullif(F.col("model"), F.lit("")), F.lit(default_model)))
    j = _rates(t, prices, "model")
    ti = F.coalesce(F.col("tokens_input"), F.lit(0))
    to = F.coalesce(F.col("tokens_output"), F.lit(0))
    cost = (ti * F.col("input_rate") + to * F.col("output_rate")) / 1_000_000
    return (j.withColumn("cost_usd", F.when((ti != 0) | (to != 0), py_round(cost, 8)))
             .drop("input_rate", "output_rate", "cache_read_rate", "cache_write_rate"))


def accumulate_tokens(usage: DataFrame) -> DataFrame:
    """Token usage summed per (session, agent); `first_seq` keeps first-seen order."""
    return usage.groupBy(*K, F.coalesce("agent", F.lit("")).alias("agent")).agg(
        F.sum(F.coalesce("input_tokens", F.lit(0))).alias("input"),
        F.sum(F.coalesce("output_tokens", F.lit(0))).alias("output"),
        F.sum(F.coalesce("cache_read_input_tokens", F.lit(0))).alias("cache_read"),
        F.sum(F.coalesce("cache_creation_input_tokens", F.lit(0))).alias("cache_write"),
        F.min("seq").alias("first_seq"),
    )


def session_rollup(agent_tokens: DataFrame, prices: DataFrame, default_model: str = DEFAULT_MODEL) -> DataFrame:
    """Every agent priced with the default model (as the logger does at close), per-agent
    cost rounded to 6, session total = round(sum of the rounded costs, 6), agents in first-seen
    order, and a cost breakdown map (usage without an agent under the empty name). One row per session; sessions
    without usage have no row."""
    # every agent is priced with the one default model: look its rates up in the (small, bounded)
    # price table once instead of joining every row against a constant
    from runlens.operators.config import config_rows
    rows = [r for r in config_rows(prices) if r["model"] == default_model]
    rates = (rows[0]["input_rate"], rows[0]["output_rate"], rows[0]["cache_read_rate"], rows[0]["cache_write_rate"]) \
        if rows else DEFAULT_RATES
    a = agent_tokens.select("*", F.lit(default_model).alias("model"),
                            *[F.lit(float(r)).alias(c) for r, c in zip(
                                rates, ["input_rate", "output_rate", "cache_read_rate", "cache_write_rate"])])
    a = a.withColumn("cost_usd", py_round((F.col("input") * F.col("input_rate") + F.col("output") * F.col("output_rate")
                                          + F.col("cache_read") * F.col("cache_read_rate")
                                          + F.col("cache_write") * F.col("cache_write_rate")) / 1_000_000, 6))
    entry = F.struct("model", "input", "output", "cache_read", "cache_write", "cost_usd")
    g = a.groupBy(*K).agg(
        F.sum("input").alias("total_tokens_input"),
        F.sum("output").alias("total_tokens_output"),
        py_round(F.sum("cost_usd"), 6).alias("total_cost_usd"),
        F.sort_array(F.collect_list(F.struct("first_seq", "agent"))).alias("_ag"),
        F.map_from_entries(F.collect_list(F.struct(F.coalesce("agent", F.lit("")), entry))).alias("cost_breakdown"),
    )
    return g.select(*K, "total_tokens_input", "total_tokens_output", "total_cost_usd",
                    F.transform("_ag", lambda x: x["agent"]).alias("agents_invoked"), "cost_breakdown")


# ── B12 / B13: session metrics and normalisation ─────────────────────────────────────────────

def session_metrics(traces: DataFrame, closes: DataFrame) -> DataFrame:
    """Step count from the traces, plus the caller's close figures; latency = end - start."""
    steps = traces.groupBy(*K).agg(F.count(F.lit(1)).alias("total_steps"))
    c = closes.join(steps, K, "left")
    return c.select(
        *K,
        F.to_date("ended_at").alias("date"),
        F.coalesce("total_steps", F.lit(0)).alias("total_steps"),
        F.coalesce("trades_proposed", F.lit(0)).alias("trades_proposed"),
        F.coalesce("trades_approved", F.lit(0)).alias("trades_approved"),
        F.coalesce("trades_executed", F.lit(0)).alias("trades_executed"),
        F.coalesce("risk_rejections", F.lit(0)).alias("risk_rejections"),
        F.coalesce("retry_triggered", F.lit(False)).alias("retry_triggered"),
        F.coalesce("loop_iterations", F.lit(1)).alias("loop_iterations"),
        ((F.unix_micros(F.col("ended_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp")))
         / 1000).cast("long").alias("total_latency_ms"),
    )


def normalize_sessions(raw: DataFrame) -> DataFrame:
    """Lift the close figures out of the metadata JSON to top level (the engines read them
    there), and take `completed_at` from `ended_at` when absent."""
    cols = set(raw.columns)
    out = raw
    for f, typ in [("trades_executed", "long"), ("trades_proposed", "long"), ("trades_approved", "long"),
                   ("risk_rejections", "long"), ("total_steps", "long")]:
        lifted = F.get_json_object(F.col("metadata"), f"$.{f}").try_cast(typ) if "metadata" in cols else F.lit(None)
        base = F.col(f) if f in cols else F.lit(None).cast(typ)
        out = out.withColumn(f, F.coalesce(base, lifted.cast(typ)))
    done = F.col("completed_at") if "completed_at" in cols else F.lit(None).cast("timestamp")
    ended = F.col("ended_at") if "ended_at" in cols else F.lit(None).cast("timestamp")
    return out.withColumn("completed_at", F.coalesce(done, ended))
