"""Business outcomes and eval tables (G1-G7), and the quality-trend extension (H1-H3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.columns import K, py_round

EVAL_TABLE = ["tenant_id", "session_id", "eval_name", "agent", "layer", "score", "passed", "threshold", "detail",
              "entity_id"]


def business_evals(rows: DataFrame) -> DataFrame:
    """G1: caller-computed scores as layer-5 eval rows: score rounded to 4, reasoning into detail;
    rows without a tenant are dropped (nothing is written without one)."""
    layer = F.col("layer") if "layer" in rows.columns else F.lit(5)
    reasoning = F.col("reasoning") if "reasoning" in rows.columns else F.lit("")
    return rows.filter(F.col("tenant_id").isNotNull() & (F.col("tenant_id") != "")).select(
        *K, "eval_name", "agent", F.coalesce(layer, F.lit(5)).alias("layer"),
        py_round(F.col("score"), 4).alias("score"), "passed",
        F.col("threshold").cast("double").alias("threshold"),
        F.to_json(F.struct(F.coalesce(reasoning, F.lit("")).alias("reasoning"))).alias("detail"),
        F.lit(None).cast("string").alias("entity_id"))


def ingest_evals(rows: DataFrame) -> DataFrame:
    """Client eval rows; layer defaults to 4; entity, detail and threshold optional; score and
    passed are taken as given."""
    def opt(c: str, t: str) -> Column:
        return F.col(c).cast(t) if c in rows.columns else F.lit(None).cast(t)
    return rows.select(*K, "eval_name", "agent", F.coalesce(opt("layer", "int"), F.lit(4)).alias("layer"),
                       F.col("score").cast("double").alias("score"), "passed", opt("threshold", "double").alias("threshold"),
                       opt("detail", "string").alias("detail"), opt("entity_id", "string").alias("entity_id"))


def research_yield(sessions: DataFrame) -> DataFrame:
    """1.0 if the run produced any proposals; passes at 0.9."""
    p = F.coalesce(F.col("trades_proposed"), F.lit(0))
    score = F.when(p > 0, 1.0).otherwise(0.0)
    return sessions.select(*K, F.lit("research_yield").alias("eval_name"), F.lit("research").alias("agent"),
                           score.alias("score"), (score >= 0.9).alias("passed"), F.lit(0.9).alias("threshold"),
                           F.format_string("Pipeline generated %d proposals", p).alias("reasoning"))


def approval_rate(sessions: DataFrame) -> DataFrame:
    """Approved / proposed when anything was proposed (no row otherwise); passes at 0.20."""
    p = F.coalesce(F.col("trades_proposed"), F.lit(0))
    a = F.coalesce(F.col("trades_approved"), F.lit(0))
    s = sessions.filter(p > 0)
    score = a / p
    return s.select(*K, F.lit("approval_rate").alias("eval_name"), F.lit("risk").alias("agent"),
                    score.alias("score"), (score >= 0.20).alias("passed"), F.lit(0.20).alias("threshold"),
                    F.format_string("%d of %d proposals approved", a, p).alias("reasoning"))


def all_evals(*tables: DataFrame) -> DataFrame:
    """Layers 3, 4 and 5 in one table."""
    out = None
    for t in tables:
        cols = [F.col(c) if c in t.columns else F.lit(None).alias(c) for c in EVAL_TABLE]
        t2 = t.select(*cols).select(*[F.col(c).cast(typ).alias(c) for c, typ in zip(
            EVAL_TABLE, ["string", "string", "string", "string", "int", "double", "boolean", "double", "string",
                         "string"])])
        out = t2 if out is None else out.unionByName(t2)
    return out


def normalize_outcomes(rows: DataFrame) -> DataFrame:
    """The realised result is the label, else the sign of the value (0 -> unknown); source
    defaults to 'confirmed'; signals that read as numbers also appear in `signals_num`."""
    label = F.nullif(F.col("label"), F.lit(""))
    realised = F.coalesce(label, F.when(F.col("value") > 0, "success").when(F.col("value") < 0, "fail"))
    sig = F.col("signals") if "signals" in rows.columns else F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    num = F.map_filter(F.transform_values(sig, lambda k, v: v.try_cast("double")), lambda k, v: v.isNotNull())
    return rows.select("*", realised.alias("realized"),
                       F.coalesce(F.col("source"), F.lit("confirmed")).alias("source_n"),
                       num.alias("signals_num")).drop("source").withColumnRenamed("source_n", "source")


def link_outcomes(outcomes: DataFrame, traces: DataFrame, how: str = "inner") -> DataFrame:
    """Outcomes joined to the work done for the same (tenant, entity): one aggregate row per
    entity on the trace side, so an outcome never fans out into trace pairs. `how` = inner, left,
    left_semi (matched) or left_anti (unmatched)."""
    work = traces.filter(F.col("entity_id").isNotNull()).groupBy("tenant_id", "entity_id").agg(
        F.count(F.lit(1)).alias("n_traces"), F.count_distinct("session_id").alias("n_sessions"),
        F.sum(F.coalesce(F.col("tokens_input"), F.lit(0)) + F.coalesce(F.col("tokens_output"), F.lit(0))).alias("tokens"),
        F.count_if(F.col("outcome").eqNullSafe(F.lit("error"))).alias("n_errors"))
    return outcomes.join(work, ["tenant_id", "entity_id"], how)


# ── H1-H3: quality trend (optional extension; unreachable in the reference's standard run) ────

def quality_score(evals: DataFrame, agent: str, eval_name: str) -> DataFrame:
    """H1: the first matching score per session (config order)."""
    order = F.col("config_ord") if "config_ord" in evals.columns else F.lit(0)
    f = evals.filter((F.col("agent") == agent) & (F.col("eval_name") == eval_name))
    return f.groupBy(*K).agg(F.min_by("score", order).alias("qscore"))


def quality_slope(scores: DataFrame, partition: list[str], order: list[str], value: str = "qscore", n: int = 5,
                  bucket: Column | None = None) -> DataFrame:
    """H2: least-squares slope of the last n values (current included) over index 0..n-1; fewer
    than 2 values -> 0. The slope does not depend on where the index starts, so the running
    position `_pos` of history.rolling serves as x; `bucket` splits hot partitions."""
    from runlens.operators.history import rolling
    aggs = {"slope": lambda w: F.regr_slope(F.col(value), F.col("_pos").cast("double")).over(w)}
    out = rolling(scores, partition, order, n - 1, aggs, bucket)
    return out.withColumn("slope", F.coalesce(F.col("slope"), F.lit(0.0)))


def grounding_failure(scores: DataFrame, partition: list[str], order: list[str], value: str = "qscore",
                      window: int = 3, threshold: float = 0.40, bucket: Column | None = None) -> DataFrame:
    """H3: the last `window` sessions (current included) all scored below `threshold`; a missing
    score anywhere in the window means no incident. `bucket` splits hot partitions (history.rolling)."""
    from runlens.operators.history import rolling
    aggs = {"_n": lambda w: F.count(F.lit(1)).over(w), "_nv": lambda w: F.count(value).over(w),
            "_mx": lambda w: F.max(value).over(w)}
    s = rolling(scores, partition, order, window - 1, aggs, bucket)
    fired = s.filter((F.col("_n") == window) & (F.col("_nv") == window) & (F.col("_mx") < threshold))
    return fired.select(*partition, *[c for c in K if c not in partition],
                        F.lit("Proactive: Grounding Failure").alias("pattern_name"), F.lit("warning").alias("severity"),
                        py_round(F.col(value), 3).alias("last_score")).drop("_n", "_nv", "_mx")
