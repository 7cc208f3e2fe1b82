"""Bounded rolling windows without hot partitions.

A plain `rowsBetween(-N, 0)` window partitioned by (tenant, workflow) or (tenant, agent) puts the
whole partition in one task; with few workflows and many sessions that is a hot key. `rolling`
splits each partition into ordered buckets (for example one day of sessions) and gives every
bucket a "halo": the last N rows before it, found by shipping each bucket's own last N rows to
the next N non-empty buckets (a bounded fan-out of at most N x N rows per bucket). The window
then runs per (partition, bucket), and the result equals the single window's exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Agg = Callable[[Window], Column]


def _join_ns(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join on `keys` where null matches null (a null agent or workflow is a key too)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in keys]
    return left.join(r, cond).drop(*[f"_r_{c}" for c in keys])


def rolling(df: DataFrame, partition: list[str], order: list[str], n_back: int, aggs: dict[str, Agg],
            bucket: Column | None, include_current: bool = True, carry: list[str] | None = None) -> DataFrame:
    """Add one column per `aggs` entry, computed over the previous `n_back` rows (plus the current
    row when `include_current`) of each partition in `order`. Aggregates may read `_pos`, a row
    number that increases by one from row to row inside every frame. `bucket` must be a coarse,
    non-decreasing function of the order (null = no bucketing: one window per partition).
    `carry` names the columns the aggregates read (default: all)."""
    end = 0 if include_current else -1
    if bucket is None:
        pos = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-n_back, end)
        out = df.withColumn("_pos", pos)
        return out.select("*", *[fn(w).alias(name) for name, fn in aggs.items()]).drop("_pos")

    rows = df.select("*", F.coalesce(bucket.cast("long"), F.lit(-(1 << 62))).alias("_b"))
    key = partition + ["_b"]
    # dense rank of each non-empty bucket within its partition (one row per bucket: small)
    buckets = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_cnt"))
    buckets = buckets.select(*key, F.row_number().over(Window.partitionBy(*partition).orderBy("_b")).alias("_bn"))
    # the last n rows of every bucket (a constant limit: Spark's map-side group limit applies)
    carry_cols = carry if carry is not None else [c for c in df.columns if c not in partition + order]
    desc = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    tails = _join_ns(rows.select(*key, *order, *carry_cols).withColumn("_r", F.row_number().over(desc))
                     .filter(F.col("_r") <= n_back).drop("_r"), buckets, key)
    # ship each tail to the next n non-empty buckets; keep the n latest per receiving bucket
    shipped = (tails.select(*partition, *order, *carry_cols, "_bn", F.explode(F.sequence(F.lit(1), F.lit(n_back)))
                            .alias("_off"))
               .withColumn("_bn", F.col("_bn") + F.col("_off")).drop("_off"))
    shipped = _join_ns(shipped, buckets.select(*partition, "_bn", "_b"), partition + ["_bn"]).drop("_bn")
    halo = (shipped.withColumn("_r", F.row_number().over(desc)).filter(F.col("_r") <= n_back).drop("_r")
            .withColumn("_halo", F.lit(True)))
    u = rows.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    # `_pos`: a row number that is consecutive across the halo and the bucket's own rows
    u = u.withColumn("_pos", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(-n_back, end)
    out = u.select("*", *[fn(w).alias(name) for name, fn in aggs.items()])
    return out.filter(~F.col("_halo")).drop("_halo", "_b", "_pos")


def preceding_stats(df: DataFrame, partition: list[str], order: list[str], value: str, n: int = 20,
                    bucket_seconds: int | None = 86_400, prefix: str = "hist", more: dict[str, Agg] | None = None,
                    carry: list[str] | None = None) -> DataFrame:
    """`{prefix}_n`, `{prefix}_mean`, `{prefix}_sd` (sample) of `value` over the previous `n` rows of
    each partition in `order`; `order[0]` is a timestamp, bucketed by `bucket_seconds`. `more` are further aggregates
    over the same rows, and `carry` the columns that they read."""
    bucket = None
    if bucket_seconds:
        bucket = F.floor(F.unix_micros(F.col(order[0]).cast("timestamp")) / (bucket_seconds * 1_000_000))
    aggs = {f"{prefix}_n": lambda w: F.count(value).over(w),
            f"{prefix}_mean": lambda w: F.avg(value).over(w),
            f"{prefix}_sd": lambda w: F.stddev_samp(value).over(w), **(more or {})}
    return rolling(df, partition, order, n, aggs, bucket, include_current=False, carry=[value, *(carry or [])])
