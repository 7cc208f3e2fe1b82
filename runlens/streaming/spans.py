"""Structured Streaming jobs over stored spans.

S1: retried spans land once, however late they come and whatever time they carry: each micro-batch is deduplicated in
itself, then anti-joined with the stored spans of the same key buckets (`KeyedTable.add_new`). No watermark drops
anything, no state grows in the executors, and a batch reads only the live folders of its buckets. Spans without an id
all pass. The store is bucketed by session, so a job that judges sessions reads their buckets only. For each batch the
sessions that got spans are listed under `arrivals`, one row each: a stream of its own that follows the commit.

S2: a session is judged once its close event arrives (the client flushes its spans before it
closes). Each micro-batch of close events is joined to the stored traces and sessions; rule evals and
detectors run for exactly those sessions. Results carry the batch id, and `latest_results` keeps those of a
session's last close, so a session that closes twice has one set of results. `streaming.judge` also judges again when
spans arrive after the close.

A retried micro-batch is not applied twice (S1) or replaces its own output (S2), and a restarted query resumes from its
checkpoint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.columns import K
from runlens.session import ensure_checkpoint_dir, stored
from runlens.sources.ingest import dedupe_spans, has_id
from runlens.sources.keyed_table import KeyedTable

SPAN_KEY = ["tenant_id", "session_id", "span_id"]
ARRIVALS = "tenant_id string, session_id string, spans long"


def span_store(spark: SparkSession, path: str, schema: T.StructType, buckets: int = 64) -> KeyedTable:
    """Stored spans: key (tenant, session, span id), buckets by session."""
    return KeyedTable(spark, f"{path}/spans", schema, SPAN_KEY, buckets=buckets, bucket_by=K, bloom=["span_id"], adds=True)


def stream_dedupe_spans(stream: DataFrame, out_path: str, checkpoint: str, arrival: str = "arrived_at", buckets: int = 64) -> DataFrame:
    """Process everything available and return the stored spans; the first stored arrival of an
    identified span stays (of several in one batch the last)."""
    spark = stream.sparkSession
    store = span_store(spark, out_path, stream.schema, buckets)

    def keep_new(batch: DataFrame, batch_id: int) -> None:
        version = store.add_new(dedupe_spans(batch, arrival), has_id(), batch_id)
        added = store.read_version(version).groupBy(*K).agg(F.count(F.lit(1)).alias("spans"))
        added.write.mode("overwrite").parquet(f"{out_path}/arrivals/{batch_id:012d}")

    q = stream.writeStream.foreachBatch(keep_new).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return store.read()


def stream_arrivals(spark: SparkSession, out_path: str, batches: int = 100) -> DataFrame:
    """The sessions that got spans, as a stream: a row for each session and batch of `stream_dedupe_spans`."""
    return spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", batches).parquet(f"{out_path}/arrivals/*")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never a machine-local temp dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/runlens/{name}-{uuid.uuid4().hex[:12]}"


def stream_evaluate_closed(closes: DataFrame, traces: DataFrame | KeyedTable, sessions: DataFrame, out_path: str,
                           checkpoint: str, params: DataFrame | None = None, history: DataFrame | None = None,
                           eval_configs: DataFrame | None = None, registry=None):
    """Run the rule evals (when configs are given) and the detectors for the sessions closed in each micro-batch.
    Of a span store only the buckets of those sessions are read. The cost history is computed once for all micro-batches, and
    what a micro-batch reads is stored once for all its passes."""
    from runlens.operators.detectors import cost_history, incident_rows, run_detectors
    from runlens.operators.evals import run_rule_evals

    hist = history if history is not None else stored(cost_history(sessions).select(*K, "hist_n", "hist_mean", "hist_sd"), "closed-history")

    def judge_batch(batch: DataFrame, batch_id: int) -> None:
        closed = batch.select(*K).distinct().persist()
        spans = traces.read(traces.buckets_of(closed)) if isinstance(traces, KeyedTable) else traces
        t, s, h = (stored(df.join(closed, K, "left_semi"), f"closed-{name}")
                   for df, name in ((spans, "spans"), (sessions, "sessions"), (hist, "costs")))

        def write(df: DataFrame, name: str) -> None:
            df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out_path}/{name}/batch={batch_id}")

        write(closed, "closed")
        if eval_configs is not None:
            write(run_rule_evals(s, t, eval_configs, params, registry, h), "evals")
        d = run_detectors(t, s, params=params, history=h)
        write(incident_rows(d.incidents), "incidents")
        write(d.frames, "frames")
        closed.unpersist()

    q = (closes.writeStream.foreachBatch(judge_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def latest_results(spark: SparkSession, out_path: str, name: str) -> DataFrame:
    """The stored rows of `name` (evals, incidents, frames) that belong to each session's last close."""
    last = spark.read.parquet(f"{out_path}/closed").groupBy(*K).agg(F.max("batch_id").alias("batch_id"))
    return spark.read.parquet(f"{out_path}/{name}").drop("batch").join(last, [*K, "batch_id"])
