"""OTLP/JSON traces (A1-A4): documents <-> spans <-> agent traces.

An OTLP JSON request is `resourceSpans[].scopeSpans[].spans[]`; attribute values are a typed
union {stringValue | intValue | doubleValue | boolValue}. Parsing is `from_json` with a fixed
schema plus three explodes; building documents is a bounded `collect_list` per batch of at most
`per_batch` spans, so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.columns import K, is_err

VALUE = T.StructType([
    T.StructField("stringValue", T.StringType()),
    T.StructField("intValue", T.StringType()),      # int64 arrives as a JSON number or a string
    T.StructField("doubleValue", T.DoubleType()),
    T.StructField("boolValue", T.BooleanType()),
])
ATTR = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", VALUE)])
EVENT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("timeUnixNano", T.StringType()),
    T.StructField("attributes", T.ArrayType(ATTR)),
])
SPAN = T.StructType([
    T.StructField("traceId", T.StringType()),
    T.StructField("spanId", T.StringType()),
    T.StructField("parentSpanId", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("startTimeUnixNano", T.StringType()),
    T.StructField("endTimeUnixNano", T.StringType()),
    T.StructField("status", T.StructType([T.StructField("code", T.IntegerType())])),
    T.StructField("attributes", T.ArrayType(ATTR)),
    T.StructField("events", T.ArrayType(EVENT)),
])
OTLP = T.StructType([T.StructField("resourceSpans", T.ArrayType(T.StructType([
    T.StructField("resource", T.StructType([T.StructField("attributes", T.ArrayType(ATTR))])),
    T.StructField("scopeSpans", T.ArrayType(T.StructType([
        T.StructField("scope", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]))),
])))])


# ── A3: attribute union ───────────────────────────────────────────────────────────────────────

def encode_value(c: Column, dtype: T.DataType) -> Column:
    """Typed value -> union struct: booleans first (a Python bool is also an int), then integers,
    then floating point; anything else as a string."""
    null_s, null_d, null_b = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("boolean")
    if isinstance(dtype, T.BooleanType):
        parts = (null_s, null_s, null_d, c)
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        parts = (null_s, c.cast("string"), null_d, null_b)
    elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        parts = (null_s, null_s, c.cast("double"), null_b)
    else:
        parts = (c.cast("string"), null_s, null_d, null_b)
    return F.struct(*[p.alias(f.name) for p, f in zip(parts, VALUE.fields)])


def encode_attributes(df: DataFrame, columns: dict[str, str | Column], string_only: bool = False) -> Column:
    """Build an attribute array from named columns (null values are left out)."""
    items = []
    for key, c in columns.items():
        col = F.col(c) if isinstance(c, str) else c
        dtype = df.select(col.alias("_x")).schema["_x"].dataType
        val = encode_value(col, T.StringType() if string_only else dtype)
        items.append(F.when(col.isNotNull(), F.struct(F.lit(key).alias("key"), val.alias("value"))))
    return F.filter(F.array(*items), lambda a: a.isNotNull())


def decode_value(v: Column) -> Column:
    """Union struct -> text (bool as true/false)."""
    return F.coalesce(v["stringValue"], v["boolValue"].cast("string"), v["intValue"], v["doubleValue"].cast("string"))


def decode_attributes(attrs: Column) -> Column:
    """Attribute array -> map<string, string>; of a repeated key the last value holds, entries without a key are
    left out."""
    known = F.filter(F.coalesce(attrs, F.array().cast(T.ArrayType(ATTR))), lambda a: a["key"].isNotNull())
    last = F.filter(known, lambda a, i: ~F.exists(F.slice(known, i + 2, F.greatest(F.size(known), F.lit(1))), lambda b: b["key"] == a["key"]))
    return F.map_from_entries(F.transform(last, lambda a: F.struct(a["key"], decode_value(a["value"]))))


def attr_value(attrs: Column, key: str) -> Column:
    """The union struct of one attribute, or null."""
    return F.element_at(F.filter(attrs, lambda a: a["key"] == key), 1)["value"]


# ── A1: documents -> spans ────────────────────────────────────────────────────────────────────

def flatten_otlp(payloads: DataFrame, body: str = "body") -> DataFrame:
    """One row per span: ids, name, start/end (ns and timestamp), status code, attributes (raw and
    as a text map), events, resource attributes and scope name. Extra payload columns pass through."""
    produced = {"trace_id", "span_id", "parent_span_id", "name", "start_ns", "end_ns", "start_time", "status_code",
                "attributes", "attrs", "events", "resource_attrs", "scope_name", "resource_attributes"}
    keep = [c for c in payloads.columns if c != body and c not in produced]
    p = payloads.select(*keep, F.from_json(F.col(body), OTLP).alias("_doc"))
    rs = p.select(*keep, F.explode("_doc.resourceSpans").alias("_rs"))
    ss = rs.select(*keep, F.col("_rs.resource.attributes").alias("resource_attributes"),
                   F.explode("_rs.scopeSpans").alias("_ss"))
    sp = ss.select(*keep, "resource_attributes", F.col("_ss.scope.name").alias("scope_name"),
                   F.explode("_ss.spans").alias("_sp"))
    start = F.col("_sp.startTimeUnixNano").try_cast("long")
    end = F.col("_sp.endTimeUnixNano").try_cast("long")
    return sp.select(
        *keep, F.col("_sp.traceId").alias("trace_id"), F.col("_sp.spanId").alias("span_id"),
        F.nullif(F.col("_sp.parentSpanId"), F.lit("")).alias("parent_span_id"), F.col("_sp.name").alias("name"),
        start.alias("start_ns"), end.alias("end_ns"),
        F.timestamp_micros(F.expr("try_cast(_sp.startTimeUnixNano AS BIGINT) div 1000")).alias("start_time"),
        F.coalesce(F.col("_sp.status.code"), F.lit(0)).alias("status_code"),
        F.coalesce(F.col("_sp.attributes"), F.array().cast(T.ArrayType(ATTR))).alias("attributes"),
        decode_attributes(F.col("_sp.attributes")).alias("attrs"),
        F.coalesce(F.col("_sp.events"), F.array().cast(T.ArrayType(EVENT))).alias("events"),
        decode_attributes(F.col("resource_attributes")).alias("resource_attrs"), "scope_name")


def flatten_otlp_events(spans: DataFrame) -> DataFrame:
    """Span events as rows; spans without events keep one row with null event fields."""
    e = spans.select("trace_id", "span_id", F.explode_outer("events").alias("_e"))
    return e.select("trace_id", "span_id", F.col("_e.name").alias("event_name"),
                    F.col("_e.timeUnixNano").try_cast("long").alias("event_ns"),
                    decode_attributes(F.col("_e.attributes")).alias("event_attrs"))


# ── A2: spans -> documents ────────────────────────────────────────────────────────────────────

def to_otlp_payloads(spans: DataFrame, per_batch: int = 250, order: str = "seq",
                     group: list[str] | None = None) -> DataFrame:
    """Many spans per document, at most `per_batch` (the client's batch size) per document, per
    trace. Needs a 1-based per-trace ordinal column `order`. A document never mixes tenants: the tenant (where the
    spans have one) is part of the group and stands beside the body."""
    group = group or [c for c in ("tenant_id", "trace_id") if c in spans.columns]
    span = F.struct(
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"),
        F.col("parent_span_id").alias("parentSpanId"), F.col("name").alias("name"),
        F.col("start_ns").cast("string").alias("startTimeUnixNano"),
        F.col("end_ns").cast("string").alias("endTimeUnixNano"),
        F.struct(F.col("status_code").alias("code")).alias("status"),
        F.col("attributes").alias("attributes"),
        F.coalesce(F.col("events"), F.array().cast(T.ArrayType(EVENT))).alias("events"))
    b = spans.withColumn("batch_no", F.floor((F.col(order) - 1) / per_batch).cast("long"))
    g = b.groupBy(*group, "batch_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("_o"), span.alias("_s")))).alias("_spans"))
    doc = F.struct(F.array(F.struct(F.array(F.struct(
        F.struct(F.lit("runlens").alias("name")).alias("scope"),
        F.transform("_spans", lambda x: x["_s"]).alias("spans"))).alias("scopeSpans"))).alias("resourceSpans"))
    return g.select(*group, "batch_no", F.size("_spans").alias("n_spans"), F.to_json(doc).alias("body"))


# ── A4: spans <-> traces (OpenInference convention) ───────────────────────────────────────────

def traces_to_spans(traces: DataFrame) -> DataFrame:
    """Agent traces as OTel spans: trace id = md5(session id) (32 hex), name = agent,
    OpenInference kind LLM / TOOL / AGENT by step type, token counts and model as attributes."""
    kind = (F.when(F.col("step_type") == "tool_call", "TOOL").when(F.col("step_type") == "decision", "AGENT")
            .otherwise("LLM"))
    start = F.unix_micros(F.col("created_at").cast("timestamp")) * 1000
    t = traces.select("*", kind.alias("_kind"), start.alias("start_ns"))
    attrs = encode_attributes(t, {
        "openinference.span.kind": "_kind",
        "llm.token_count.prompt": F.col("tokens_input"),
        "llm.token_count.completion": F.col("tokens_output"),
        "llm.model_name": F.col("model") if "model" in traces.columns else F.lit(None).cast("string"),
        "tool.name": F.col("tool_name"),
        "error.message": F.col("error"),
    })
    parent = F.col("parent_span_id") if "parent_span_id" in traces.columns else F.lit(None).cast("string")
    return t.select(
        *K, "seq", F.md5("session_id").alias("trace_id"), "span_id", parent.alias("parent_span_id"),
        F.col("agent").alias("name"), "start_ns",
        (F.col("start_ns") + F.coalesce(F.col("latency_ms"), F.lit(0)) * 1_000_000).alias("end_ns"),
        F.when(is_err(), 2).otherwise(1).alias("status_code"), attrs.alias("attributes"),
        F.array().cast(T.ArrayType(EVENT)).alias("events"))


def otlp_to_traces(spans: DataFrame) -> DataFrame:
    """A4: session = trace id, agent = span name; kind LLM -> agent_message with the output as
    reasoning, TOOL -> tool_call with tool input/output, AGENT -> decision; tokens and model from
    `llm.*`; status 2 -> outcome error; latency = (end - start) / 1e6."""
    a = F.col("attrs")
    kind = F.upper(F.element_at(a, F.lit("openinference.span.kind")))
    step = (F.when(kind == "LLM", "agent_message").when(kind == "TOOL", "tool_call")
            .when(kind == "AGENT", "decision").otherwise("agent_step"))
    out_v = F.element_at(a, F.lit("output.value"))
    in_v = F.element_at(a, F.lit("input.value"))
    payload = F.to_json(F.struct(
        F.when(kind == "LLM", out_v).alias("agent_reasoning"),
        F.when(kind == "TOOL", in_v).alias("tool_input"),
        F.when(kind.isin("TOOL", "AGENT"), out_v).alias("tool_output")))
    tenant = [F.col("tenant_id")] if "tenant_id" in spans.columns else [F.lit(None).cast("string").alias("tenant_id")]
    return spans.select(
        *tenant, F.col("trace_id").alias("session_id"), "span_id", "parent_span_id", F.col("name").alias("agent"),
        step.alias("step_type"),
        F.when(kind == "TOOL", F.coalesce(F.element_at(a, F.lit("tool.name")), F.col("name"))).alias("tool_name"),
        F.when(F.col("status_code") == 2, "error").otherwise("success").alias("outcome"),
        F.element_at(a, F.lit("error.message")).alias("error"),
        F.expr("(end_ns - start_ns) div 1000000").alias("latency_ms"),
        F.element_at(a, F.lit("llm.token_count.prompt")).try_cast("long").alias("tokens_input"),
        F.element_at(a, F.lit("llm.token_count.completion")).try_cast("long").alias("tokens_output"),
        F.element_at(a, F.lit("llm.model_name")).alias("model"),
        F.col("start_time").alias("created_at"), payload.alias("payload"))
