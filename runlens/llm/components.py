"""Connected components of a link table, without collecting links or nodes anywhere.

Links are first reduced to spanning forests by a union-find in each task, which gets LINKS_PER_FOREST links or
fewer. Where that takes several tasks, alternating large-star and small-star steps turn every component into a star around its smallest
node. Each step is an aggregate and an equi-join of stored tables, so a node with millions of
links is pre-aggregated and its join is split by Spark. Steps go on until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import stored

LINKS_PER_FOREST = 200_000


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        r = x
        while parent.get(r, r) != r:
            r = parent[r]
        while parent.get(x, x) != r:
            parent[x], x = r, parent[x]
        return r

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True

    def stars(self) -> tuple[list[int], list[int]]:
        nodes = [x for x in self.parent if self.root(x) != x]
        return nodes, [self.root(x) for x in nodes]


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            forest.join(a, b)
    a, b = forest.stars()
    yield pd.DataFrame({"a": a, "b": b}, dtype="int64")


def _with_roots(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def components(links: DataFrame, links_per_forest: int = LINKS_PER_FOREST) -> DataFrame:
    """(a, b) long, any order -> (node, component): every node of a link, with the smallest node it reaches."""
    links = stored(links.select("a", "b").where("a <> b"), "links")
    parts = max(1, -(-links.count() // links_per_forest))
    now = stored(links.repartition(parts).mapInPandas(_forests, "a long, b long"), "forests")
    if parts == 1:                # one forest over all links: its stars are the components
        return _with_roots(now)
    mark = None
    while True:
        # large star: hang all larger neighbours of a node on its smallest neighbour (or itself)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = stored(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        # small star: hang a node and its smaller neighbours on the smallest of them
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        hung = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        got = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == (got["n"], got["s"]) or not got["n"]:
            break
        mark = (got["n"], got["s"])
    return _with_roots(now)
