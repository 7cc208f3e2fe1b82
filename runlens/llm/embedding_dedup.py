"""Near-duplicate vectors by product quantisation: coarse lists, residual codes, table lookups, exact rerank.

Vectors are compared by cosine within one label (and one length). Equal vectors of a label form a class, compared once.
A coarse k-means and, for each subspace, a codebook of residuals are fitted on a bounded sample; every vector
is then indexed: its list, its codes and its quantisation error.

Probes are sufficient: with r the distance of unit vectors at the threshold, a vector within r of x can lie in list j only if
x is within r of the plane between the centres of its own list and j; all such lists are probed. Inside, the lookup distance to the
quantised vector may exceed the true one by its stored error at most, so pairs beyond r plus that error are
dropped and all others are compared by exact cosine in double precision. Nothing is lost: recall is 1 by construction.

Lists are cut into blocks of about BLOCK rows by the number of rows found; the unit of work is a pair of blocks of
one label, so a label or list with a third of all rows is many units of bounded size. A unit returns link counts for each
vector and a spanning forest of its links, never the links one by one.

Vectors that are null, zero, or hold null or non-finite components, and rows without a label, link with nothing. Null ids
are not allowed to be linked either (their row comes back with no links). Repeated rows are copies of each other.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.common import stored
from runlens.llm.components import Forest, components

THRESHOLD = 0.93
SAMPLE_ROWS = 16_384        # rows the quantisers are fitted on
SAMPLE_VALUES = 8_000_000   # and numbers in them
SUBSPACES = 8
CODES = 256
ROWS_PER_LIST = 4096
MAX_LISTS = 1024
BLOCK = 1024                # rows of a list compared as one
SLACK = 1e-6                # for rounding in bounds


def unit_rows(vectors: list) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)[0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = _distances(x, centres)
    return d.argmin(axis=1), d


class Quantiser:
    """Coarse centres and residual codebooks for unit vectors padded to a multiple of SUBSPACES."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.centres = _means(sample, lists, 8, rng)
        near, _ = _nearest(sample, self.centres)
        residuals = sample - self.centres[near]
        self.width = self.dim // SUBSPACES
        self.books = [_means(residuals[:, s * self.width: (s + 1) * self.width], CODES, 5, rng) for s in range(SUBSPACES)]
        apart = np.sqrt(_distances(self.centres, self.centres))
        self.apart = np.where(apart > 0, apart, 1.0)

    def pad(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.dim - x.shape[1])))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes, error, and the squared distances to all centres."""
        near, d = _nearest(x, self.centres)
        rest, back = x - self.centres[near], self.centres[near].copy()
        codes = np.empty((len(x), SUBSPACES), dtype=np.uint8)
        for s, book in enumerate(self.books):
            at = slice(s * self.width, (s + 1) * self.width)
            codes[:, s] = _nearest(rest[:, at], book)[0]
            back[:, at] += book[codes[:, s]]
        return near, codes, np.sqrt(((x - back) ** 2).sum(axis=1)), d

    def probes(self, near: np.ndarray, d: np.ndarray, radius: float) -> np.ndarray:
        """Lists that may hold a vector within `radius`, the own list included."""
        own = d[np.arange(len(d)), near][:, None]
        return (d - own) / (2 * self.apart[near]) <= radius + SLACK

    def lookup(self, x: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from each x to quantised vectors of one list, summed from tables."""
        rest, out = x - self.centres[which], np.zeros((len(x), len(codes)))
        for s, book in enumerate(self.books):
            table = _distances(rest[:, s * self.width: (s + 1) * self.width], book)
            out += table[:, codes[:, s]]
        return out


def similar_pairs(q: Quantiser, x: np.ndarray, y: np.ndarray, which: int, codes: np.ndarray, errors: np.ndarray,
                  threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in x, in y) with cosine >= threshold; y are indexed vectors of list `which`."""
    radius = math.sqrt(2 - 2 * threshold)
    limit = (radius + errors + SLACK) ** 2 + SLACK
    for at in range(0, len(x), 128):
        near = q.lookup(x[at: at + 128], which, codes) <= limit
        cols = np.flatnonzero(near.any(axis=0))
        if len(cols):
            fine = (x[at: at + 128] @ y[cols].T >= threshold) & near[:, cols]
            i, j = np.nonzero(fine)
            yield i + at, cols[j]


def near_duplicate_vectors(table: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                           vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = table.sparkSession
    element = table.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    v = F.col("v")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                        F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite
                        & F.exists(v, lambda x: x != 0))
    # equal vectors of a label: one class, represented by the smallest id (-0.0 is 0.0)
    same = usable.withColumn("v", F.transform(v, lambda x: F.when(x == 0, F.lit(0).cast(element if kind == "<f4" else "double")).otherwise(x)))
    keyed = stored(same.withColumn("key", F.sha2(F.concat_ws("|", "label", F.col("v").cast("string")).cast("binary"), 256)), "vectors")
    classes = stored(keyed.groupBy("key").agg(F.min(F.struct("vec_id", "label", "v")).alias("f"), F.count(F.lit(1)).alias("copies")).select(
        "key", F.col("f.vec_id").alias("rep"), F.concat_ws("|", "f.label", F.size("f.v").cast("string")).alias("domain"),
        F.col("f.v").alias("v"), "copies"), "vector-classes")
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    members = keyed.select("vec_id", "key")
    if not stats["n"]:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dim = -(-stats["dim"] // SUBSPACES) * SUBSPACES
    take = min(SAMPLE_ROWS, max(256, SAMPLE_VALUES // dim))
    share = int(1_000_000 * min(1.0, take / stats["n"])) or 1
    picked = classes.where(F.pmod(F.xxhash64("rep", F.lit("pq")), F.lit(1_000_000)) < share).select("rep", "v").toPandas()   # bounded sample
    if not len(picked):
        picked = classes.select("rep", "v").orderBy("rep").limit(256).toPandas()
    picked = picked.sort_values("rep")
    sample = np.zeros((len(picked), dim))
    for i, x in enumerate(picked["v"]):
        sample[i, : len(x)] = unit_rows([x])[0]
    quantiser = Quantiser(sample, min(MAX_LISTS, max(4, -(-stats["n"] // ROWS_PER_LIST))))
    shared = spark.sparkContext.broadcast(quantiser)          # centres and codebooks
    radius = math.sqrt(2 - 2 * threshold)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = shared.value
        for batch in batches:
            for _, b in batch.groupby(batch["v"].str.len(), sort=False):
                x = q.pad(unit_rows(list(b["v"])))
                near, codes, errors, d = q.encode(x)
                wide = q.probes(near, d, radius)
                yield pd.DataFrame({
                    "rep": b["rep"].to_numpy(), "domain": b["domain"].to_numpy(), "copies": b["copies"].to_numpy(),
                    "v": [np.asarray(r, dtype=kind).tobytes() for r in b["v"]], "own": near, "codes": [c.tobytes() for c in codes],
                    "error": errors, "probes": [np.flatnonzero(w).tolist() for w in wide]})

    indexed = stored(classes.drop("key").mapInPandas(
        index, "rep long, domain string, copies long, v binary, own int, codes binary, error double, probes array<int>"), "vector-index")
    sizes = stored(indexed.groupBy("domain", "own").agg(F.count(F.lit(1)).alias("n")).select(
        "domain", F.col("own").alias("list"), F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks")), "list-blocks")
    own = sizes.select("domain", F.col("list").alias("own"), F.col("blocks").alias("own_blocks"))
    dealt = indexed.join(own, ["domain", "own"]).withColumn("own_block", F.pmod(F.xxhash64("rep"), F.col("own_blocks")).cast("int"))
    dealt = dealt.withColumn("list", F.explode("probes")).drop("probes").join(sizes, ["domain", "list"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    here, there = F.struct(F.col("own").alias("l"), F.col("own_block").alias("b")), F.struct(F.col("list").alias("l"), F.col("block").alias("b"))
    units = dealt.select(
        "domain", F.least(here, there).alias("one"), F.greatest(here, there).alias("two"), F.when(here <= there, 0).otherwise(1).alias("side"),
        "rep", "copies", "v", "own", "codes", "error")

    def compare(unit: pd.DataFrame) -> pd.DataFrame:
        q, a = shared.value, unit[unit["side"] == 0]
        first, second = unit["one"].iloc[0], unit["two"].iloc[0]
        b = a if first == second else unit[unit["side"] == 1]
        empty = pd.DataFrame({"a": [], "b": [], "links": []}).astype({"a": "int64", "b": "int64", "links": "int64"})
        if not len(a) or not len(b):
            return empty
        xs = [q.pad(unit_rows([np.frombuffer(r, kind) for r in p["v"]])) for p in (a, b)]
        codes = np.frombuffer(b"".join(b["codes"]), np.uint8).reshape(len(b), SUBSPACES)
        ids, other = a["rep"].to_numpy(), b["rep"].to_numpy()
        weight, other_weight = a["copies"].to_numpy(), b["copies"].to_numpy()
        links, other_links = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        forest = Forest()
        for i, j in similar_pairs(q, xs[0], xs[1], int(b["own"].iloc[0]), codes, b["error"].to_numpy(), threshold):
            if first == second:
                i, j = i[ids[i] < other[j]], j[ids[i] < other[j]]
            np.add.at(links, i, other_weight[j])
            np.add.at(other_links, j, weight[i])
            for x, y in zip(ids[i].tolist(), other[j].tolist()):
                forest.join(x, y)
        x, y = forest.stars()
        at, to = np.flatnonzero(links), np.flatnonzero(other_links)
        return pd.concat([
            pd.DataFrame({"a": np.concatenate([ids[at], other[to]]), "b": -1, "links": np.concatenate([links[at], other_links[to]])}),
            pd.DataFrame({"a": x, "b": y, "links": 0})], ignore_index=True).astype({"a": "int64", "b": "int64", "links": "int64"})

    found = stored(units.groupBy("domain", "one", "two").applyInPandas(compare, "a long, b long, links long"), "vector-links")
    counts = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    reached = components(found.where("links = 0").select("a", "b")).withColumnRenamed("node", "rep")
    summed = stored(classes.select("key", "rep", "copies").join(counts, "rep", "left").join(reached, "rep", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component")), "vector-classes-done")
    linked = members.join(summed, "key").select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(~F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite
                                   & F.exists(v, lambda x: x != 0), F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
