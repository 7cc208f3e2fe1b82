"""Edge tables (FIXTURES §2.7): rounding ties, blank errors, null ids, agent matching."""

from pyspark.sql import functions as F

from runlens.functions.columns import agent_matches, py_round, py_string, real_error
from runlens.sources.ingest import dedupe_spans


def test_rounding_is_python_s(spark):
    import random
    rng = random.Random(1)
    for digits in (1, 2, 3, 4, 6, 8):
        ties = [(2 * rng.randint(0, 10 ** 6) + 1) / (2 * 10 ** digits) for _ in range(3000)]
        xs = ties + [-x for x in ties[:100]] + [rng.random() * 10 ** rng.randint(-3, 4) for _ in range(2000)] + [
            0.0, 0.25, 0.75, 3.05, 241.45, 2.315, 21 / 32, 0.8049999999999999, 1.0, 15600 / 80000]
        df = spark.createDataFrame([(x,) for x in xs], "x double")
        got = {r.x: r.r for r in df.select("x", py_round(F.col("x"), digits).alias("r")).collect()}
        assert all(got[x] == round(x, digits) for x in xs)


def test_texts_are_quoted_as_python_does(spark):
    xs = ["plain", "Can't connect: 503", 'say "no"', "both ' and \"", "back\\slash", "a\nb\tc", ""]
    df = spark.createDataFrame([(x,) for x in xs], "x string")
    assert [r.r for r in df.select(py_string(F.col("x")).alias("r")).collect()] == [repr(x) for x in xs]


def test_real_error_and_matching(spark):
    df = spark.createDataFrame([(None,), ("",), ("  \t",), (" boom ",)], "e string")
    assert [r.v for r in df.select(real_error("e").alias("v")).collect()] == [None, None, None, "boom"]
    m = spark.createDataFrame([("Research_AAPL", "research", "prefix"), ("a_b%c", "_b%", "contains"),
                               ("axbyc", "_b%", "contains"), ("x", "y", "nope"), ("x", "", "exact")],
                              "agent string, pattern string, match string")
    got = [r.v for r in m.select(agent_matches(F.col("agent"), F.col("pattern"), F.col("match")).alias("v")).collect()]
    assert got == [True, True, False, False, True]


def test_dedupe_keeps_id_less_rows(spark):
    rows = [("t", "s", "a", 1), ("t", "s", "a", 2), ("t", "s", None, 3), ("t", "s", None, 3)]
    df = spark.createDataFrame(rows, "tenant_id string, session_id string, span_id string, arrived_at int")
    out = dedupe_spans(df).collect()
    assert len(out) == 3 and sorted(r.arrived_at for r in out if r.span_id == "a") == [2]
    # plain dropDuplicates would collapse the id-less rows
    assert df.dropDuplicates(["tenant_id", "session_id", "span_id"]).count() == 2


def test_repeated_keys_do_not_end_the_job(spark):
    """A repeated config key keeps its last value, a repeated attribute key too; usage without an agent has its own entry."""
    from runlens.operators.config import load_pipeline_config
    from runlens.operators.shaping import accumulate_tokens, model_prices, session_rollup
    from runlens.sources.otlp import decode_attributes
    rows = spark.createDataFrame([("w", "tool_retry_threshold", "3", 1), ("w", "tool_retry_threshold", "2", 2), ("w", None, "9", 3)],
                                 "workflow_id string, key string, value string, ord int")
    assert load_pipeline_config(rows).first().tool_retry_threshold == 2
    attr = "array<struct<key:string,value:struct<stringValue:string,intValue:string,doubleValue:double,boolValue:boolean>>>"
    df = spark.createDataFrame([([("a", ("x", None, None, None)), ("b", (None, "1", None, None)), ("a", ("y", None, None, None)),
                                  (None, ("z", None, None, None))],), (None,), ([],)], f"a {attr}")
    assert [r.m for r in df.select(decode_attributes(F.col("a")).alias("m")).collect()] == [{"a": "y", "b": "1"}, {}, {}]
    usage = spark.createDataFrame([("t", "s", None, 10, 5, 0, 0, 1), ("t", "s", None, 1, 1, 0, 0, 2), ("t", "s", "m", 1, 1, 0, 0, 3)],
                                  "tenant_id string, session_id string, agent string, input_tokens long, output_tokens long, "
                                  "cache_read_input_tokens long, cache_creation_input_tokens long, seq long")
    r = session_rollup(accumulate_tokens(usage), model_prices(spark)).first()
    assert set(r.cost_breakdown) == {"", "m"} and r.total_tokens_input == 12


def test_documents_never_mix_tenants(spark):
    from runlens.sources.otlp import flatten_otlp, otlp_to_traces, to_otlp_payloads, traces_to_spans
    from conftest import healthy, make_traces, timeouts
    t = make_traces(spark, healthy()).unionByName(make_traces(spark, timeouts(), tenant="desk-b"))
    back = otlp_to_traces(flatten_otlp(to_otlp_payloads(traces_to_spans(t)))).groupBy("tenant_id").count().collect()
    assert {r.tenant_id: r["count"] for r in back} == {"desk-a": 9, "desk-b": 4}


def test_ids_for_bodies_without_one(spark):
    """Repeated bodies without an id get different ids, the same ones again on a rerun; blank ids count as missing."""
    from runlens.sources.ingest import ingest_traces
    raw = spark.createDataFrame([("t", "s", None, "a"), ("t", "s", None, "a"), ("t", "s", " ", "b"), ("t", "s", "x", "c")],
                                "tenant_id string, session_id string, span_id string, agent string")
    one, two = (sorted(r.span_id for r in ingest_traces(raw).collect()) for _ in range(2))
    assert one == two and len(set(one)) == 4 and "x" in one


def test_tool_outputs_of_any_kind_give_valid_json(spark):
    """B1: an object stays, other JSON is wrapped as it is, and plain text as a string."""
    import json
    from runlens.sources.ingest import log_rows
    outputs = ['{"a": 1}', "[1, 2]", "42", "true", '"quoted"', "plain text", "{broken", 'say "hi"\n', "", None]
    raw = spark.createDataFrame([("t", f"s{i}", "tool_call", o) for i, o in enumerate(outputs)],
                                "tenant_id string, session_id string, kind string, tool_output string")
    got = {int(r.session_id[1:]): json.loads(r.payload).get("tool_output") for r in log_rows(raw).collect()}
    want = [{"a": 1}, {"value": [1, 2]}, {"value": 42}, {"value": True}, {"value": "quoted"}, {"value": "plain text"}, {"value": "{broken"},
            {"value": 'say "hi"\n'}, {"value": ""}, None]
    assert [got[i] for i in range(len(outputs))] == want


def test_all_evidence_without_a_limit(spark):
    from runlens.operators.detectors import run_detectors
    from conftest import make_session, make_traces, tool_trace
    t = make_traces(spark, [tool_trace("research", "x") for _ in range(30)])
    s = make_session(spark, trades_executed=0, terminal_reason="")
    count = lambda **k: {r.pattern_name: r["count"] for r in run_detectors(t, s, **k).frames.groupBy("pattern_name").count().collect()}
    assert count()["Silent Exit"] == 10 and count(last_n={})["Silent Exit"] == 30 and count(last_n={"Silent Exit": 4})["Silent Exit"] == 4
