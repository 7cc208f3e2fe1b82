"""Configuration as data.

Pipeline configuration arrives as key/value rows per workflow with JSON values. It is turned
into one typed row per workflow and joined to the data, so every session is judged with its own
workflow's thresholds in the same plan. Config tables are written by people: `config_table` reads one
to the driver once, refuses more than MAX_CONFIG_ROWS rows, and returns a frame that may be broadcast.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Engine defaults for rule evals and detectors.
EVAL_DEFAULTS = {
    "required_agents": [],
    "token_spiral_threshold": 40_000,
    "token_efficiency_threshold": 30_000,
    "tool_success_min_rate": 0.80,
    "cost_anomaly_sigma": 2.0,
    "data_freshness_minutes": 10,
    "tool_diversity_min": 2,
    "cost_per_unit_threshold": 0.50,
    "good_exits": ["completed", "converged", "no_opportunity"],
    "partial_exits": ["partial", "circuit_breaker"],
    "bad_exits": ["error", "in_progress"],
}
DETECTOR_DEFAULTS = {
    "tool_retry_threshold": 3,
    "token_spiral_threshold": 40_000,
    "hyperactive_poll_threshold": 6,
    "fabrication_latency_ms": 10.0,
    "fabrication_min_count": 3,
    "fabrication_exempt_tools": ["read_session_context", "write_learning", "get_candidates",
                                 "get_position_history", "filter_and_rank", "get_scan_results"],
    "cost_anomaly_sigma": 2.0,
    "analysis_agent": "research",
    "pipeline_order": ["research", "orchestrator"],
    "handoff_pairs": [["research", "risk"]],
}
# Shadow circuit-breaker defaults, agent -> (eval_name, threshold).
CB_DEFAULTS = [("research", "tool_success_rate", 0.80), ("research", "completion", 0.70),
               ("risk", "assessment_complete", 1.0)]

# Typed parameters: name -> (Spark type, default). Lists fall back to the default when empty,
# as `x or default` does.
PARAM_TYPES: dict[str, tuple[T.DataType, object]] = {
    "required_agents": (T.ArrayType(T.StringType()), EVAL_DEFAULTS["required_agents"]),
    "token_spiral_threshold": (T.LongType(), 40_000),
    "token_efficiency_threshold": (T.LongType(), 30_000),
    "cost_anomaly_sigma": (T.DoubleType(), 2.0),
    "data_freshness_minutes": (T.LongType(), 10),
    "tool_diversity_min": (T.LongType(), 2),
    "good_exits": (T.ArrayType(T.StringType()), EVAL_DEFAULTS["good_exits"]),
    "partial_exits": (T.ArrayType(T.StringType()), EVAL_DEFAULTS["partial_exits"]),
    "bad_exits": (T.ArrayType(T.StringType()), EVAL_DEFAULTS["bad_exits"]),
    "tool_retry_threshold": (T.LongType(), 3),
    "hyperactive_poll_threshold": (T.LongType(), 6),
    "fabrication_latency_ms": (T.DoubleType(), 10.0),
    "fabrication_min_count": (T.LongType(), 3),
    "fabrication_exempt_tools": (T.ArrayType(T.StringType()), DETECTOR_DEFAULTS["fabrication_exempt_tools"]),
    "analysis_agent": (T.StringType(), "research"),
    "pipeline_order": (T.ArrayType(T.StringType()), DETECTOR_DEFAULTS["pipeline_order"]),
    "handoff_pairs": (T.ArrayType(T.ArrayType(T.StringType())), DETECTOR_DEFAULTS["handoff_pairs"]),
}
# Lists where an empty configured value means "use the default" (`cfg.get(k) or default`).
EMPTY_MEANS_DEFAULT = {"pipeline_order", "handoff_pairs"}

PIPELINE_CONFIG_SCHEMA = T.StructType([
    T.StructField("workflow_id", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),   # JSON text
])

CONFIG_STRUCT = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("agent_pattern", T.StringType()),
    T.StructField("agent_match", T.StringType()),
    T.StructField("threshold_key", T.StringType()),
    T.StructField("numerator_field", T.StringType()),
    T.StructField("denominator_field", T.StringType()),
    T.StructField("prompt", T.StringType()),
])

EVAL_CONFIG_SCHEMA = T.StructType([
    T.StructField("config_id", T.StringType()),
    T.StructField("tenant_id", T.StringType()),
    T.StructField("workflow_id", T.StringType()),
    T.StructField("eval_name", T.StringType()),
    T.StructField("agent", T.StringType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("layer", T.IntegerType()),
    T.StructField("eval_type", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("config", CONFIG_STRUCT),
    T.StructField("config_ord", T.IntegerType()),
])


MAX_CONFIG_ROWS = 200_000


def config_rows(df: DataFrame) -> list:
    """The rows of a config table, read once for each frame; too many rows are an error, never dropped."""
    rows = getattr(df, "_runlens_rows", None)
    if rows is None:
        rows = df.limit(MAX_CONFIG_ROWS + 1).collect()
        if len(rows) > MAX_CONFIG_ROWS:
            raise ValueError(f"a configuration table may have {MAX_CONFIG_ROWS} rows at most")
        df._runlens_rows = rows
    return rows


def config_table(df: DataFrame) -> DataFrame:
    """The same table made from driver-side rows of bounded number, marked for broadcast."""
    return F.broadcast(df.sparkSession.createDataFrame(config_rows(df), df.schema))


def _sql_literal(value) -> str:
    if isinstance(value, (list, tuple)):
        return "array(" + ", ".join(_sql_literal(v) for v in value) + ")"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def _lit(value, dtype: T.DataType) -> Column:
    """A typed constant as one SQL expression (one JVM call instead of one per element)."""
    return F.expr(f"CAST({_sql_literal(value)} AS {dtype.simpleString()})")


def load_pipeline_config(rows: DataFrame) -> DataFrame:
    """key/value rows -> one row per workflow: a raw `cfg_map` (key -> JSON text) plus typed
    columns (null where the key is absent; defaults are applied by `attach_params`). Of a repeated key the last
    value holds, by the column `ord` where there is one, else by the value's text; rows without a key are left out."""
    order = F.col("ord") if "ord" in rows.columns else F.col("value")
    rows = rows.filter(F.col("key").isNotNull()).groupBy("workflow_id", "key").agg(F.max_by("value", order).alias("value"))
    g = rows.groupBy("workflow_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("cfg_map"))
    cols = [F.col("workflow_id"), F.col("cfg_map")]
    for name, (dtype, _) in PARAM_TYPES.items():
        raw = F.element_at(F.col("cfg_map"), F.lit(name))
        if isinstance(dtype, T.ArrayType):
            parsed = F.from_json(raw, dtype)
        elif isinstance(dtype, T.StringType):
            parsed = F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v")
        elif isinstance(dtype, T.LongType):
            parsed = raw.try_cast("double").try_cast("long")   # int(4.7) == 4
        else:
            parsed = raw.try_cast("double")
        cols.append(parsed.alias(name))
    return g.select(*cols)


def pipeline_config_rows(spark: SparkSession, config: dict[str, dict]) -> DataFrame:
    """Build key/value rows from a Python dict {workflow_id: {key: value}} (values JSON-encoded)."""
    data = [(wf, k, json.dumps(v)) for wf, kv in config.items() for k, v in kv.items()]
    return spark.createDataFrame(data, PIPELINE_CONFIG_SCHEMA)


def default_params() -> list[Column]:
    from runlens.functions.columns import cached
    return cached("default_params", lambda: [_lit(default, dtype).alias(name)
                                             for name, (dtype, default) in PARAM_TYPES.items()]
                  + [F.expr("CAST(map() AS map<string,string>)").alias("cfg_map")])


def attach_params(df: DataFrame, params: DataFrame | None, key: str = "workflow_id") -> DataFrame:
    """Give every row its workflow's parameters (C14, D11). `params` comes from
    `load_pipeline_config`; workflows missing from it get the engine defaults."""
    if params is None:
        return df.select("*", *default_params())
    p = config_table(params).withColumnRenamed("workflow_id", "_wf")
    j = df.join(p, df[key] == p["_wf"], "left")
    out = [df[c] for c in df.columns]
    for name, (dtype, default) in PARAM_TYPES.items():
        c = p[name]
        if isinstance(dtype, T.ArrayType) and (name in EMPTY_MEANS_DEFAULT):
            c = F.when(F.size(c) > 0, c)
        out.append(F.coalesce(c, _lit(default, dtype)).alias(name))
    out.append(F.coalesce(p["cfg_map"], F.create_map().cast(T.MapType(T.StringType(), T.StringType())))
               .alias("cfg_map"))
    return j.select(*out)


def setting_value(key: Column) -> Column:
    """C13 lookup: the workflow's own JSON value for `key`, else the eval default (as JSON text)."""
    defaults = F.create_map(*[x for k, v in EVAL_DEFAULTS.items() for x in (F.lit(k), F.lit(json.dumps(v)))])
    return F.coalesce(F.try_element_at(F.col("cfg_map"), key), F.try_element_at(defaults, key))


def load_eval_configs(rows: DataFrame, layer: int | None = None, workflow_id: str | None = None,
                      tenant_id: str | None = None) -> DataFrame:
    """Enabled configs, optionally of one layer, and those that apply to a workflow and a tenant (a config
    without one applies to all)."""
    out = rows.filter(F.col("enabled"))
    for name, value in (("workflow_id", workflow_id), ("tenant_id", tenant_id)):
        if value is not None:
            out = out.filter(F.col(name).isNull() | (F.col(name) == value))
    return out.filter(F.col("layer") == layer) if layer is not None else out


def load_pipeline_agents(rows: DataFrame, workflow_id: str | None = None) -> DataFrame:
    """A10: agent display rows, ordered by sort_order."""
    out = rows if workflow_id is None else rows.filter(F.col("workflow_id") == workflow_id)
    return out.select("workflow_id", "agent_name", "display_name", "emoji", "sort_order").orderBy("sort_order")


def cb_config_rows(spark: SparkSession, entries=None) -> DataFrame:
    return spark.createDataFrame(entries if entries is not None else CB_DEFAULTS,
                                 "agent string, eval_name string, threshold double")
