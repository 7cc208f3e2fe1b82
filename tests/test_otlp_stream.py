"""OTLP documents (A1-A4) and the streaming dedupe."""

import json

from pyspark.sql import functions as F

from runlens.sources.otlp import flatten_otlp, otlp_to_traces


def _attr(k, v):
    if isinstance(v, bool):
        return {"key": k, "value": {"boolValue": v}}
    if isinstance(v, int):
        return {"key": k, "value": {"intValue": v}}
    return {"key": k, "value": {"stringValue": str(v)}}


def test_openinference_document(spark):
    def span(name, attrs, start, end, ok=True):
        return {"traceId": "ab" * 16, "spanId": name[:2] * 8, "name": name, "startTimeUnixNano": str(start),
                "endTimeUnixNano": str(end), "status": {"code": 1 if ok else 2},
                "attributes": [_attr(k, v) for k, v in attrs.items()]}
    t = 1_700_000_000_000_000_000
    doc = {"resourceSpans": [{"resource": {"attributes": [_attr("service.name", "demo")]}, "scopeSpans": [{
        "scope": {"name": "demo"}, "spans": [
            span("planner", {"openinference.span.kind": "LLM", "llm.model_name": "gpt-4o", "output.value": "plan",
                             "llm.token_count.prompt": 120, "llm.token_count.completion": 38}, t, t + 800_000_000),
            span("fetch_data", {"openinference.span.kind": "TOOL", "input.value": "{}", "output.value": "{\"rows\": 42}"},
                 t + 800_000_000, t + 1_100_000_000, ok=False),
            span("summarizer", {"openinference.span.kind": "AGENT", "output.value": "done"}, t + 1_100_000_000,
                 t + 1_500_000_000)]}]}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "body string")
    spans = flatten_otlp(df)
    assert spans.first().resource_attrs["service.name"] == "demo"
    tr = {r.agent: r for r in otlp_to_traces(spans).collect()}
    assert tr["planner"].step_type == "agent_message" and tr["planner"].tokens_input == 120
    assert tr["planner"].model == "gpt-4o" and json.loads(tr["planner"].payload)["agent_reasoning"] == "plan"
    assert tr["fetch_data"].step_type == "tool_call" and tr["fetch_data"].outcome == "error"
    assert tr["fetch_data"].latency_ms == 300 and tr["summarizer"].step_type == "decision"
    assert tr["planner"].session_id == "ab" * 16


def test_stream_dedupe_keeps_late_spans(spark):
    """Six micro-batches, far out of time order; blank ids are no ids; nothing is lost."""
    from runlens.streaming.spans import scratch_path, stream_dedupe_spans
    batches = [[("a", "2026-06-08 10:00:00", 1), ("a", "2026-06-08 10:00:00", 2), (None, "2026-06-08 10:00:01", 3)],
               [("late", "2020-01-01 00:00:00", 4), ("", "2026-06-08 10:00:01", 5)], [("b", "2030-01-01 00:00:00", 6)],
               [("late", "2020-01-01 00:00:00", 7), ("c", "2021-01-01 00:00:00", 8)], [("a", "2026-06-08 10:00:00", 9)],
               [("d", None, 10), ("d", None, 11), (" ", None, 12)]]
    stage, schema = scratch_path(spark, "t-in"), "tenant_id string, session_id string, span_id string, created_at timestamp, n int, arrived_at int"
    for rows in batches:
        df = spark.createDataFrame([("t", "s", i, c, n) for i, c, n in rows], "tenant_id string, session_id string, span_id string, created_at string, n int")
        df.select("tenant_id", "session_id", "span_id", F.to_timestamp("created_at").alias("created_at"), "n", F.col("n").alias("arrived_at")) \
            .coalesce(1).write.mode("append").parquet(stage)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(stage)
    got = stream_dedupe_spans(src, scratch_path(spark, "t-out"), scratch_path(spark, "t-ckpt")).collect()
    assert sorted(r.span_id for r in got if r.span_id and r.span_id.strip()) == ["a", "b", "c", "d", "late"]
    assert sorted(r.n for r in got if not (r.span_id or "").strip()) == [3, 5, 12]


def test_evaluate_on_close_equals_batch(spark):
    """Close events streamed in three files give the same incidents as the batch run."""
    from conftest import SF_SMOKE
    from runlens.operators.detectors import run_detectors
    from runlens.sources.adapters import load_sessions, load_traces
    from runlens.streaming.spans import latest_results, scratch_path, stream_evaluate_closed
    t, s = load_traces(spark, SF_SMOKE), load_sessions(spark, SF_SMOKE)
    stage = scratch_path(spark, "t-closes")
    closes = s.select("tenant_id", "session_id", F.col("completed_at").alias("closed_at"))
    closes.repartition(3, "session_id").write.parquet(stage)
    closes.coalesce(1).write.mode("append").parquet(stage)              # every session closes once more
    src = spark.readStream.schema(closes.schema).option("maxFilesPerTrigger", 1).parquet(stage)
    out = scratch_path(spark, "t-closed")
    stream_evaluate_closed(src, t, s, out, scratch_path(spark, "t-closed-ckpt"))
    got = latest_results(spark, out, "incidents").select("session_id", "pattern_name", "frame_count").collect()
    want = run_detectors(t, s).incidents.select("session_id", "pattern_name", "frame_count").collect()
    assert sorted(got) == sorted(want) and len(got) > 0
    assert spark.read.parquet(f"{out}/incidents").select("batch_id").distinct().count() >= 2


def test_closed_sessions_read_stored_inputs(spark, monkeypatch):
    """The cost history is worked out once for all micro-batches, and the passes of one read the stored rows of its sessions."""
    from conftest import SF_SMOKE
    from runlens.operators import detectors
    from runlens.sources.adapters import load_sessions, load_traces
    from runlens.streaming.spans import scratch_path, stream_evaluate_closed
    t, s = load_traces(spark, SF_SMOKE), load_sessions(spark, SF_SMOKE)
    stage = scratch_path(spark, "t-closes-once")
    closes = s.select("tenant_id", "session_id").orderBy("session_id").limit(6)
    closes.repartitionByRange(2, "session_id").write.parquet(stage)
    src = spark.readStream.schema(closes.schema).option("maxFilesPerTrigger", 1).parquet(stage)
    seen, real = [], detectors.run_detectors

    def spy(traces, sessions, **more):
        seen.append([{f.split("/")[-2].rsplit("-", 1)[0] for f in df.inputFiles()} for df in (traces, sessions, more["history"])])
        return real(traces, sessions, **more)

    monkeypatch.setattr(detectors, "run_detectors", spy)
    stream_evaluate_closed(src, t, s, scratch_path(spark, "t-once-out"), scratch_path(spark, "t-once-ckpt"))
    assert len(seen) == 2 and all(x == [{"closed-spans"}, {"closed-sessions"}, {"closed-costs"}] for x in seen)


def test_retries_arrive_batch_by_batch(spark, monkeypatch):
    from conftest import SF_SMOKE
    from runlens.plans import stream_queries
    from runlens.streaming import spans
    paths, files, dedupe, scratch = {}, [], spans.stream_dedupe_spans, spans.scratch_path

    def path(spark, name):
        paths[name] = scratch(spark, name)
        return paths[name]

    def spy(stream, *args, **more):
        files.append(len(spark.read.parquet(paths["retries-in"]).inputFiles()))
        return dedupe(stream, *args, **more)

    monkeypatch.setattr(spans, "scratch_path", path)
    monkeypatch.setattr(spans, "stream_dedupe_spans", spy)
    assert stream_queries.stream_retries_query(spark, SF_SMOKE).count() > 0
    assert len(files) == 5 and files == sorted(set(files))                                    # each batch of files is streamed before the next is there
