"""Cost history kept up to date by micro-batch.

`cost_history` looks at the previous 20 sessions of a tenant's workflow by (started_at, session_id). `CostHistory` gives
the same figures as sessions become known, without going over all of them again:

- the *rings* hold one row per (tenant, workflow): its last 20 sessions, oldest first. Where all new sessions of a
  workflow come after its ring, the ring is all that has to be read (one row per workflow), and the new ring is the
  last 20 of both;
- the *ledger* holds one narrow row per session. Where a session comes out of order, changes or moves (late spans), the history
  of its workflow is computed from the ledger again, and every session that had it or now has it among its previous 20
  is reported with its new figures, so that it can be judged again.

Both ways use the same bucketed window, so after any order of micro-batches the figures last reported equal those of
`cost_history` over all sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.functions.columns import K
from runlens.operators.history import preceding_stats, rolling
from runlens.session import cut_lineage
from runlens.sources.keyed_table import KeyedTable

WORKFLOW = ["tenant_id", "workflow_id"]
ORDER = ["started_at", "session_id"]
ENTRY = "struct<started_at:timestamp,session_id:string,cost:double>"
DAY = 86_400


def _match(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be null; columns of `right` other than the keys are added."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    return left.join(r, [left[c].eqNullSafe(r[f"_r_{c}"]) for c in keys], how).drop(*[f"_r_{c}" for c in keys])


class CostHistory:
    def __init__(self, spark: SparkSession, path: str, n: int = 20, buckets: int = 16, bucket_seconds: int | None = DAY):
        self.n, self.bucket_seconds = n, bucket_seconds
        self.rings = KeyedTable(spark, f"{path}/rings", f"tenant_id string, workflow_id string, ring array<{ENTRY}>", WORKFLOW,
                                buckets=buckets, versions=4)
        self.ledger = KeyedTable(spark, f"{path}/ledger", "tenant_id string, session_id string, workflow_id string, started_at timestamp, "
                                 "cost double", K, buckets=buckets, bucket_by=WORKFLOW)

    def _bucket(self):
        if not self.bucket_seconds:
            return None
        return F.floor(F.unix_micros(F.col("started_at")) / (self.bucket_seconds * 1_000_000))

    def _followers(self, rows: DataFrame) -> DataFrame:
        """Sessions with a row marked `_new` among their previous n."""
        marked = rolling(rows, WORKFLOW, ORDER, self.n, {"_after": lambda w: F.max("_new").over(w)}, self._bucket(),
                         include_current=False, carry=["_new"])
        return marked.where(F.coalesce("_after", F.lit(False))).select(*K)

    def update(self, sessions: DataFrame, batch: int | None = None) -> DataFrame:
        """Take in sessions (new ones, or known ones with changed figures; a session's workflow never changes); returns
        K, hist_n, hist_mean, hist_sd of these and of all known sessions whose history changes by them. A boolean
        column `again` may say which sessions can be known already; without it the ledger is asked."""
        cost = F.coalesce(F.col("total_cost_usd").cast("double"), F.lit(0.0)).alias("cost")
        columns = [*K, "workflow_id", F.col("started_at").cast("timestamp").alias("started_at"), cost]
        new = cut_lineage(sessions.select(*columns, *(["again"] if "again" in sessions.columns else [])).where(F.col("session_id").isNotNull()))
        if "again" in new.columns:
            again, new = new.where("again"), new.drop("again")
        else:
            again = _match(new, self.ledger.read(self.ledger.buckets_of(new)).select(*K), K, "left_semi")
        place = F.struct(*ORDER)
        first = new.groupBy(*WORKFLOW).agg(F.min(place).alias("_first"))
        rings = self.rings.read(self.rings.buckets_of(first))
        known = _match(first, rings, WORKFLOW, "left")
        last = F.element_at("ring", -1)
        late = F.col("ring").isNotNull() & (F.col("_first") <= F.struct(last["started_at"].alias("started_at"), last["session_id"].alias("session_id")))
        again = again.select(*WORKFLOW, F.lit(True).alias("_again")).distinct()
        known = cut_lineage(_match(known.withColumn("_late", late), again, WORKFLOW, "left").withColumn(
            "_late", F.col("_late") | F.coalesce("_again", F.lit(False))).drop("_again"))
        flagged = new.withColumn("_new", F.lit(True))

        in_order = known.where(~F.col("_late")).select(*WORKFLOW, F.inline("ring")).withColumn("_new", F.lit(False))
        rows, gone = in_order.select(*K, "workflow_id", "started_at", "cost", "_new"), None
        if not known.where("_late").isEmpty():
            old = self.ledger.read(self.ledger.buckets_of(known.where("_late")))
            old = _match(old, known.where("_late").select(*WORKFLOW), WORKFLOW, "left_semi")
            replaced = new.select(*K, F.lit(True).alias("_again"))
            old = _match(old, replaced, K, "left").select("*", F.coalesce("_again", F.lit(False)).alias("_new")).drop("_again")
            rows = rows.unionByName(old.where(~F.col("_new")).select(*rows.columns))
            gone = self._followers(old.select(*rows.columns))            # had a session among their last n that moves or changes
        rows = rows.unionByName(flagged.select(*rows.columns))

        # the figures, and whether a new session is among the previous n, by one window
        stats = cut_lineage(preceding_stats(
            rows, WORKFLOW, ORDER, "cost", n=self.n, bucket_seconds=self.bucket_seconds,
            more={"_after": lambda w: F.max("_new").over(w)}, carry=["_new"]).select(*K, "hist_n", "hist_mean", "hist_sd", "_new", "_after"))
        touched = stats.where(F.col("_new") | F.coalesce("_after", F.lit(False))).select(*K)
        if gone is not None:
            touched = touched.unionByName(gone)
        touched = touched.distinct()
        result = cut_lineage(_match(stats, touched, K, "left_semi").select(*K, "hist_n", "hist_mean", "hist_sd"))

        newest = Window.partitionBy(*WORKFLOW).orderBy(*[F.col(c).desc() for c in ORDER])
        tail = rows.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= self.n)
        ring = tail.groupBy(*WORKFLOW).agg(F.sort_array(F.collect_list(F.struct(*ORDER, "cost"))).alias("ring"))   # n at most
        self.rings.put(cut_lineage(ring), batch)
        self.ledger.put(new, batch)
        return result
