"""S2 with late spans: sessions are judged when they close and again when spans arrive afterwards.

Two streams meet, keyed by session: close events, and the arrivals that the span store (S1) lists after each commit, one
row per session and batch, so a busy session does not send its spans here. The state of a session is whether it has
closed, how many spans came since it was last judged, and how often it was judged. It asks for a judgement when the
session closes (each time it closes) and when spans arrive after the close. The states are rows of a keyed table, which
a micro-batch joins for all its sessions at once. With a quiet time, late spans are gathered until none has come for that
long: this takes a processing-time timer for each session, so a stateful operator that goes through them in Python.

Each micro-batch of requests reads the buckets of its sessions from the span store (partition filters) once, takes their
costs into the incremental cost history, and runs rule evals and detectors for the requested sessions and for those whose
cost history changes with them. Results go to keyed tables in which a session's rows replace its earlier ones; a retried
micro-batch is not applied twice. What is stored at the end equals a batch run over all spans, whatever came late.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from runlens.functions.columns import K
from runlens.operators.cost_ring import CostHistory
from runlens.session import cut_lineage, stored
from runlens.sources.keyed_table import KeyedTable

REQUEST = "tenant_id string, session_id string, revision int, reason string"
STATE = "closed boolean, late long, revision int"


def track(key: tuple, events: Iterator[pd.DataFrame], state: GroupState, quiet_ms: int = 0) -> Iterator[pd.DataFrame]:
    """State of one session: yields a request when it has to be judged."""
    closed, late, revision = state.get if state.exists else (False, 0, 0)
    closes = spans = 0
    if not state.hasTimedOut:
        for part in events:
            closes += int(part["closes"].sum())
            spans += int(part["spans"].sum())
    reason = None
    if closes:
        closed, late, reason = True, 0, "closed"
    elif closed:
        late += spans
        if late and (state.hasTimedOut or not quiet_ms):
            late, reason = 0, "late spans"
    if reason:
        revision += 1
    state.update((closed, late, revision))
    if closed and late:
        state.setTimeoutDuration(quiet_ms)
    if reason:
        yield pd.DataFrame([(*key, revision, reason)], columns=["tenant_id", "session_id", "revision", "reason"])


def session_events(closes: DataFrame, arrivals: DataFrame) -> DataFrame:
    """The streams of close events and of arrivals as one: K, closes, spans."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return closes.select(*K, one.alias("closes"), none.alias("spans")).unionByName(
        arrivals.select(*K, none.alias("closes"), F.col("spans").cast("long").alias("spans")))


def judge_requests(closes: DataFrame, arrivals: DataFrame, quiet_ms: int = 0) -> DataFrame:
    """The streams of close events and of arrivals -> a stream of sessions to judge, by a stateful operator."""
    timer = GroupStateTimeout.ProcessingTimeTimeout if quiet_ms else GroupStateTimeout.NoTimeout
    return session_events(closes, arrivals).groupBy(*K).applyInPandasWithState(
        lambda key, parts, state: track(key, parts, state, quiet_ms), REQUEST, STATE, "update", timer)


class SessionStates:
    """The rule of `track` without a quiet time, for all sessions of a micro-batch in one join. No span waits then, so
    only sessions that have closed have a state, and it is how often they were judged."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.path = path
        self.table = KeyedTable(spark, f"{path}/states", "tenant_id string, session_id string, revision int", K, buckets=buckets)

    def requests(self, events: DataFrame, batch: int) -> DataFrame:
        """The sessions to judge after a micro-batch of `session_events`. They are stored before the states are, so that
        the same micro-batch, run again, asks for the same sessions."""
        spark, path = self.table.spark, request_path(self.path, batch)
        last = self.table.state().batch
        if last is None or batch > last:
            came = stored(events.groupBy(*K).agg(F.coalesce(F.sum("closes"), F.lit(0)).alias("_closes"),
                                                 F.coalesce(F.sum("spans"), F.lit(0)).alias("_spans")), "judge-events")
            states = self.table.read(self.table.buckets_of(came)).select(*[F.col(c).alias(f"_s_{c}") for c in K], "revision")
            both = came.join(states, [came[c].eqNullSafe(states[f"_s_{c}"]) for c in K], "left")
            reason = F.when(F.col("_closes") > 0, "closed").when(F.col("revision").isNotNull() & (F.col("_spans") > 0), "late spans")
            asked = both.select(*K, (F.coalesce("revision", F.lit(0)) + 1).cast("int").alias("revision"), reason.alias("reason"))
            asked.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(path)
            self.table.put(spark.read.schema(REQUEST).parquet(path), batch)
        return spark.read.schema(REQUEST).parquet(path)


def request_path(out_path: str, batch: int) -> str:
    return f"{out_path}/requests/{batch:012d}"


class SessionJudge:
    """Judges the sessions of a micro-batch from the span store and keeps their results."""

    def __init__(self, spans: KeyedTable, out_path: str, session_rows: Callable[[DataFrame], DataFrame], params: DataFrame | None = None,
                 eval_configs: DataFrame | None = None, registry=None, buckets: int = 64):
        """`session_rows` makes the session records of a set of traces."""
        self.spans, self.session_rows, self.out = spans, session_rows, out_path.rstrip("/")
        self.params, self.configs, self.registry, self.buckets = params, eval_configs, registry, buckets
        self.costs = CostHistory(spans.spark, f"{self.out}/costs", buckets=min(buckets, 16))

    def _put(self, name: str, rows: DataFrame, judged: DataFrame, batch: int | None) -> None:
        result_table(self.spans.spark, self.out, name, rows, self.buckets).put(rows, batch, judged)

    def traces(self, sessions: DataFrame) -> DataFrame:
        """The stored spans of some sessions: only their buckets are read."""
        return self.spans.read(self.spans.buckets_of(sessions)).join(sessions.select(*K).distinct(), K, "left_semi")

    def _inputs(self, sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Spans and session records of some sessions, stored, since every pass over them reads them."""
        t = stored(self.traces(sessions), "judged-spans")
        return t, stored(self.session_rows(t), "judged-sessions")

    def judge(self, requested: DataFrame, batch: int | None = None) -> None:
        """Judge the requested sessions (K and revision)."""
        from runlens.operators.detectors import incident_rows, run_detectors
        from runlens.operators.evals import run_rule_evals

        asked = cut_lineage(requested.groupBy(*K).agg((F.max("revision") > 1).alias("again")))
        t, s = self._inputs(asked)
        history = self.costs.update(s.join(asked, K), batch)
        more = cut_lineage(history.join(asked, K, "left_anti").select(*K).distinct())      # their history changes
        judged = asked.select(*K).union(more)
        if not more.isEmpty():
            t, s = (a.unionByName(b) for a, b in zip((t, s), self._inputs(more)))
        if self.configs is not None:
            self._put("evals", run_rule_evals(s, t, self.configs, self.params, self.registry, history), judged, batch)
        found = run_detectors(t, s, params=self.params, history=history)
        self._put("incidents", incident_rows(found.incidents), judged, batch)
        self._put("frames", found.frames, judged, batch)

    def results(self, name: str) -> DataFrame:
        """What holds now of `name`: evals, incidents or frames."""
        return KeyedTable.open(self.spans.spark, f"{self.out}/{name}").read()


def result_table(spark: SparkSession, out_path: str, name: str, rows: DataFrame, buckets: int = 64) -> KeyedTable:
    """The keyed table of one kind of result; a session's rows replace those of its earlier judgement."""
    return KeyedTable(spark, f"{out_path}/{name}", rows.schema, K, buckets=buckets)


def stream_judge(closes: DataFrame, arrivals: DataFrame, judge: SessionJudge, checkpoint: str, quiet_ms: int = 0):
    """Process all close events and arrivals that are there and end; call again as more come. With a quiet time the
    query runs on, looking every half of it, since timers need it; the caller stops it."""
    spark, states = judge.spans.spark, SessionStates(judge.spans.spark, judge.out, judge.buckets)

    def ask(batch: DataFrame, batch_id: int) -> DataFrame:
        if not quiet_ms:
            return states.requests(batch, batch_id)
        path = request_path(judge.out, batch_id)                        # stored, so that the state is gone through once
        batch.write.mode("overwrite").parquet(path)
        return spark.read.schema(REQUEST).parquet(path)

    def run(batch: DataFrame, batch_id: int) -> None:
        requested = ask(batch, batch_id)
        if not requested.isEmpty():
            judge.judge(requested, batch_id)

    stream = judge_requests(closes, arrivals, quiet_ms) if quiet_ms else session_events(closes, arrivals)
    writer = stream.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    if quiet_ms:
        return writer.trigger(processingTime=f"{max(1, quiet_ms // 2)} milliseconds").start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
