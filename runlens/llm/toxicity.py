"""Toxicity: a factorization machine over hashed terms.

Terms are the words of a text and their first 4, 5 and 6 letters (inflected insults share a stem), hashed
to 2^20 places. Places are chosen by chi-square over the training sample; the machine learns a weight and a small vector
for each, so a score is the sum of weights plus the inner products of all pairs of present terms: an insult together
with a group mention can weigh more than both alone.

score = sigmoid(b + sum_i w_i + 1/2 * sum_f ((sum_i v_if)^2 - sum_i v_if^2)) over the distinct chosen places
present in the whole text.

Training sees at most about TRAIN_ROWS labelled rows, taken by a hash of the id from the rows that are not held out
(crc32 of the id as text, mod 5, is not 0). Their term counts are made by Spark; the driver holds only the chosen places
of each row. Scoring reads whole texts in Arrow batches. Labels, lang, source and id are no inputs of a score.

Null and empty texts get the score of no terms. A null id is not held out and not used for training. Repeated rows score
alike. Without usable labels every score is the base rate 0. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.common import stored

TRAIN_ROWS = 24_000      # bound of the training sample
PLACES = 1 << 20
CHOSEN = 2048            # places kept at most
SIGNIFICANT = 6.63       # chi-square at a chance of 1 in 100
FACTORS = 8
EPOCHS, STEPS = 12, 1_000   # passes over the sample, and steps at least (a small sample gets more passes)
CACHE_WORDS = 150_000
TRIM = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "«»“”‘’…–—¡¿"


def terms(word: str) -> list[int]:
    """Hashed places of a lower-case word."""
    w = word.strip(TRIM)
    if not w:
        return []
    raw = [w] + [f"{w[:k]}*" for k in (4, 5, 6) if len(w) >= k]
    return [zlib.crc32(x.encode()) & (PLACES - 1) for x in raw]


class _Lookup(dict):
    """Word -> chosen places (their numbers), empty tuple for most; bounded."""

    def __init__(self, number: dict[int, int]):
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > CACHE_WORDS:
            self.clear()
        found = tuple(self.number[p] for p in terms(word) if p in self.number)
        self[word] = found
        return found


def present(text: str | None, lookup: _Lookup) -> list[int]:
    """Distinct chosen places in a text, ascending."""
    found: set[int] = set()
    for got in filter(None, map(lookup.__getitem__, set((text or "").lower().split()))):
        found.update(got)
    return sorted(found)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Stored texts and labels of at most about `rows` rows that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = stored(known, "toxic-labels")
    total = known.count()
    share = int(1_000_000 * min(1.0, rows / max(1, total)))
    taken = known.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_000)) < share)
    return stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(taken), "doc_id"), "toxic-sample")          # at most about `rows` small rows are broadcast


def choose_places(sample: DataFrame, keep: int = CHOSEN) -> np.ndarray:
    """The places with the largest chi-square against the label."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, by_word = np.zeros((2, PLACES), dtype=np.int64), {}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found: set[int] = set()
                for w in set((text or "").lower().split()):
                    if w not in by_word:
                        if len(by_word) > CACHE_WORDS:
                            by_word.clear()
                        by_word[w] = terms(w)
                    found.update(by_word[w])
                n[int(toxic > 0)][list(found)] += 1
        at = np.flatnonzero(n.sum(axis=0) > 0)
        yield pd.DataFrame({"place": at, "neg": n[0][at], "pos": n[1][at]})

    docs = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    neg, pos = float(docs.get(False, 0)), float(docs.get(True, 0))
    if not neg or not pos:
        return np.zeros(0, np.int64)
    counted = sample.mapInPandas(count, "place int, neg long, pos long").groupBy("place").agg(
        F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).where("neg + pos >= 3")
    a, b = F.col("pos").cast("double"), F.col("neg").cast("double")
    chi = F.pow(a * (neg - b) - b * (pos - a), F.lit(2.0)) / ((a + b) * (neg + pos - a - b) + 1.0)
    best = counted.where(chi >= SIGNIFICANT).orderBy(chi.desc(), "place").limit(keep)
    return np.sort(np.array([r["place"] for r in best.collect()], dtype=np.int64))


class Machine:
    """A trained factorization machine over numbered places."""

    def __init__(self, places: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.places, self.bias, self.w, self.v = places, bias, w, v

    def margins(self, rows: list[list[int]]) -> np.ndarray:
        at = np.fromiter((i for r in rows for i in r), dtype=np.int64)
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        linear = np.bincount(of, self.w[at], len(rows))
        pairs = np.zeros(len(rows))
        for f in range(self.v.shape[1]):
            x = self.v[at, f]
            pairs += np.bincount(of, x, len(rows)) ** 2 - np.bincount(of, x * x, len(rows))
        return self.bias + linear + 0.5 * pairs

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(rows), -35, 35)))


def fit(rows: list[list[int]], y: np.ndarray, places: np.ndarray, epochs: int = EPOCHS, factors: int = FACTORS,
        rate: float = 0.1, decay: float = 2e-4, batch: int = 128, seed: int = 7) -> Machine:
    """Adagrad on the log loss."""
    rng = np.random.default_rng(seed)
    n, m = len(rows), len(places)
    if not n or not m or y.min() == y.max():
        return Machine(places[:0], -35.0, np.zeros(0), np.zeros((0, factors)))
    w, v, bias = np.zeros(m), rng.normal(0, 0.01, (m, factors)), float(np.log(y.mean() / (1 - y.mean())))
    gw, gv, gb = np.full(m, 1e-6), np.full((m, factors), 1e-6), 1e-6
    for _ in range(max(epochs, -(-STEPS * batch // n))):
        order = rng.permutation(n)
        for k in range(0, n, batch):
            part = order[k: k + batch]
            at = np.fromiter((i for r in part for i in rows[r]), dtype=np.int64)
            of = np.repeat(np.arange(len(part)), [len(rows[r]) for r in part])
            sums = np.zeros((len(part), factors))
            np.add.at(sums, of, v[at])
            squares = np.zeros((len(part), factors))
            np.add.at(squares, of, v[at] ** 2)
            margin = bias + np.bincount(of, w[at], len(part)) + 0.5 * (sums ** 2 - squares).sum(axis=1)
            err = (1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))) - y[part]) / len(part)
            step = np.bincount(at, err[of], m)
            seen = np.unique(at)
            step[seen] += decay * w[seen]
            gw[seen] += step[seen] ** 2
            w[seen] -= rate * step[seen] / np.sqrt(gw[seen])
            dv = np.zeros((m, factors))
            np.add.at(dv, at, err[of][:, None] * (sums[of] - v[at]))
            dv[seen] += decay * v[seen]
            gv[seen] += dv[seen] ** 2
            v[seen] -= 0.2 * rate * dv[seen] / np.sqrt(gv[seen])
            gb += err.sum() ** 2
            bias -= rate * err.sum() / np.sqrt(gb)
    return Machine(places, bias, w, v)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    sample = training_sample(docs, labels, rows, id_col, text_col)
    places = choose_places(sample)
    number = {int(p): i for i, p in enumerate(places)}

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = _Lookup(number)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "at": [present(t, lookup) for t in b["text"]]})

    got = sample.mapInPandas(pick, "doc_id long, toxic int, at array<int>").toPandas().sort_values("doc_id")  # bounded sample
    return fit([list(x) for x in got["at"]], (got["toxic"].to_numpy() > 0).astype(float), places)


def score_documents(docs: DataFrame, machine: Machine, text_col: str = "text", to: str = "score") -> DataFrame:
    """`docs` with the score in a new column."""
    model = docs.sparkSession.sparkContext.broadcast(machine)             # CHOSEN * (FACTORS + 2) numbers

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = model.value
        lookup = _Lookup({int(p): i for i, p in enumerate(m.places)})
        for texts in batches:
            yield pd.Series(m.scores([present(t, lookup) for t in texts]))

    scored = F.pandas_udf(run, T.DoubleType())
    return docs.withColumn(to, scored(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    machine = train(docs, labels, rows, id_col, text_col)
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return score_documents(named, machine).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` below the threshold, with their columns."""
    return score_documents(docs, train(docs, labels), to="_toxicity").where(F.col("_toxicity") < threshold).drop("_toxicity")
