"""Minimax contiguous partition of documents into byte-balanced shards (DataFrame and SQL functions only).

Equal texts form one atomic group (null and empty text together). Groups stand in the order of their
smallest id. The smallest capacity for which a greedy cut needs at most `shards` shards is found by
binary search; cuts then keep to that capacity and, where it leaves a choice, lie nearest to equal
shares. Groups are never split, so one huge group sets the capacity.

The search is exact at any size with bounded driver memory: the running byte totals stay in a table,
the driver sees at most POINTS of them at a time. A first look takes the last total of each of POINTS
equal byte ranges. The capacity found on these is at most one range above the true one, so every
possible greedy cut lies in a narrow window; the next look takes the totals inside the windows only,
in finer ranges, until all of them fit.

A document's slot is its place in its shard: rows are numbered inside (shard, hash bucket of the id) and
the counts of earlier buckets are added, so no shard is numbered by one task. Null ids are allowed (first
in the order), repeated rows count one by one, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import stored, text_of

POINTS = 16_384          # running totals that the driver may hold at once
ROWS_PER_BUCKET = 8_192  # rows numbered together


def needed(points: list[int], cap: int, start: int = 0) -> list[int] | None:
    """Greedy cuts under a capacity: the largest total within reach each time; None if one is out of reach."""
    cuts, at = [], start
    while at < points[-1]:
        i = bisect_right(points, at + cap)
        if i == 0 or points[i - 1] <= at:
            return None
        at = points[i - 1]
        cuts.append(at)
    return cuts


def smallest_capacity(points: list[int], shards: int, low: int, high: int) -> int:
    """Smallest capacity in [low, high] that needs at most `shards` shards; high is known to do."""
    while low < high:
        mid = (low + high) // 2
        cuts = needed(points, mid)
        if cuts is not None and len(cuts) <= shards:
            high = mid
        else:
            low = mid + 1
    return high


def windows(points: list[int], shards: int, width: int, low: int, high: int) -> list[tuple[int, int]]:
    """For each cut the totals between which it lies for every capacity in [low, high]; `points`
    holds the last total of every byte range of `width`."""
    out, a, b, total = [], 0, 0, points[-1]
    for _ in range(shards - 1):
        i = bisect_right(points, a + low)
        a = max(a, points[i - 1] if i else 0)
        reach = min(b + high, total)
        j = bisect_left(points, reach)      # the first range end at or beyond the reach
        inside = j < len(points) and points[j] != reach and (points[j] - 1) // width == (reach - 1) // width
        b = reach if inside else points[bisect_right(points, reach) - 1]
        out.append((a, max(a, b)))
    return out


def balanced_cuts(points: list[int], cap: int, shards: int) -> list[int]:
    """Cuts under the capacity, each nearest to an equal share of what is left."""
    total = points[-1]
    earliest, at = [total], total            # from the end: the earliest place of each cut
    for _ in range(shards - 1):
        at = points[bisect_left(points, at - cap)] if at > cap else 0
        earliest.append(at)
    earliest.reverse()                       # earliest[k]: of the cut after shard k
    cuts, at = [], 0
    for k in range(shards - 1):
        first, last = max(earliest[k], at + 1), at + cap
        i, j = bisect_left(points, first), bisect_right(points, last) - 1        # points that may be the cut
        if i <= j:
            aim = at + (total - at) / (shards - k)
            near = min(max(bisect_left(points, aim), i), j)
            at = min(points[max(i, near - 1): near + 1], key=lambda p: abs(p - aim))
        cuts.append(at)
    return cuts


def _ordered_totals(rows: DataFrame) -> DataFrame:
    """Groups with the running total of bytes up to and including each, in the order of (first id, key)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"))
    placed = stored(groups.repartitionByRange(parts, "first_id", "key").withColumn("part", F.spark_partition_id()),
                    "shard-groups")
    before = placed.groupBy("part").agg(F.sum("bytes").alias("b")).select(
        "part", (F.sum("b").over(Window.orderBy("part")) - F.col("b")).alias("before"))    # one row per task
    inside = Window.partitionBy("part").orderBy(F.col("first_id").asc_nulls_first(), "key")
    return stored(placed.join(before, "part").select(
        "key", "bytes", (F.col("before") + F.sum("bytes").over(inside)).alias("total")), "shard-totals")


def _range_ends(totals: DataFrame, width: int) -> list[int]:
    ends = totals.groupBy(F.floor((F.col("total") - 1) / F.lit(width)).alias("r")).agg(F.max("total").alias("t"))
    return sorted(r["t"] for r in ends.collect())           # at most one per range


def find_cuts(totals: DataFrame, shards: int, limit: int = POINTS) -> list[int]:
    """Totals after which a new shard begins (shards - 1 of them, some may be equal: empty shards)."""
    s = totals.agg(F.max("total").alias("total"), F.max("bytes").alias("largest")).first()
    if s["total"] is None:
        return [0] * (shards - 1)
    total, largest = int(s["total"]), int(s["largest"])
    width = max(1, -(-total // limit))
    points = _range_ends(totals, width)
    low = max(-(-total // shards), largest)
    high = smallest_capacity(points, shards, low, total)
    every = set(points)
    while width > 1 and low < high:
        low = max(low, high - width + 1)
        spans = windows(points, shards, width, low, high)
        near = F.col("total") == total
        for a, b in spans:
            near = near | F.col("total").between(a, b)
        reach = sum(b - a + 1 for a, b in spans)
        width = min(width // 2, max(1, -(-reach // limit)))
        if totals.where(near).count() <= limit:
            width = 1
        points = _range_ends(totals.where(near), width)
        every.update(points)
        high = smallest_capacity(points, shards, low, high)
    return balanced_cuts(sorted(every), high, shards)


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                    limit: int = POINTS) -> DataFrame:
    """Every row with its shard, its slot there, its size (UTF-8 bytes plus 1) and the crc32 of its text."""
    text = text_of(text_col)
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("key")), "shard-rows")
    totals = _ordered_totals(rows)
    shard = sum((F.when(F.col("total") > cut, 1).otherwise(0) for cut in find_cuts(totals, shards, limit)), F.lit(0))
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    placed = stored(rows.join(totals.select("key", shard.cast("int").alias("shard")), "key").select(
        "doc_id", "size", "text_crc32", "shard",
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).alias("bucket")), "shard-placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "bucket", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id")
    return (placed.withColumn("place", F.row_number().over(inside)).join(before, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
