"""Quality classifier: Bradley-Terry pairwise ranking of documents.

Every labelled good document is preferred to every labelled poor one. The chance that document a beats document b is
sigmoid(s(a) - s(b)) with s(x) = w . f(x); w minimises the mean logistic loss over all these pairs, by Newton steps with a
ridge. The features f describe the form of the whole text (words, repeated words and lines, case, marks, how well it
compresses); each enters as a few hinges between its quantiles, so that both too little and too much of something can count
against a text. Afterwards a threshold t is set at a quantile of the scores, the share of poor rows, and the reported score is
sigmoid(s - t + logit(0.3)): 0.3 exactly at the threshold.

Training uses every labelled row that is not held out (crc32 of the id as text, mod 5, is not 0) and every pair of a good and
a poor one; nothing is sampled. Quantiles and threshold are exact order statistics of all these rows, found digit by digit from
counts. A sum over all pairs needs no pairs: a smooth function of s(a) - s(b) is a sum of products of Chebyshev polynomials in
s(a) and in s(b), to about 1e-9, so one sum of each polynomial over the good rows and one over the poor rows give the
loss, and the same sums weighted by features its derivatives. Spark computes the features of all documents once, stores
them, and adds up those sums in tasks; the driver holds sums only, whose size does not depend on the number of rows.
Labels, lang, source and id are no inputs of a score. Scoring covers every row.

Cases: null text counts as empty; empty texts have the features 0. A null id is not held out and not trained on; an id with
several labels takes the largest. Repeated rows score alike. Without labels of both kinds every score is 1 (no label, or
good ones only) or 0 (poor ones only). An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.common import stored

KNOTS = 6                  # quantiles of a feature between which it is linear
PASS = 0.3                 # the score at the threshold
PLAIN = set(".,;:!?'\"()-–—…«»“”‘’¿¡")
FEATURES = ["words", "word_length", "long_words", "distinct", "top_word", "echo", "phrases", "lines", "line_words", "repeated_lines",
            "upper", "digits", "marks", "symbols", "exclaims", "sentence_ends", "marked_words", "bare_marks", "shouted", "entropy", "packed"]


def features(text: str | None) -> list[float]:
    """Form of a text, in the order of FEATURES; all 0 for a text without words."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    letters = upper = digits = marks = symbols = 0
    chars = Counter(text)
    entropy = 0.0
    for c, k in chars.items():
        entropy -= k / len(text) * math.log2(k / len(text))
        if c.isalpha():
            letters += k
            upper += k * c.isupper()
        elif c.isdigit():
            digits += k
        elif c in PLAIN:
            marks += k
        elif not c.isspace():
            symbols += k
    seen = Counter(words)
    ends = Counter(w[-1] for w in words)
    lines = [x for x in text.split("\n") if x.strip()]
    ink = len(text) - sum(k for c, k in chars.items() if c.isspace())
    bare = sum(k for w, k in seen.items() if not any(map(str.isalnum, w)))
    shouted = sum(k for w, k in seen.items() if len(w) > 1 and w.isupper())
    marked = sum(k for c, k in ends.items() if not c.isalnum())
    phrases = len(set(pairwise(words))) / max(1, n - 1)
    return [math.log1p(n), ink / n, sum(k for w, k in seen.items() if len(w) > 12) / n, len(seen) / n, max(seen.values()) / n,
            sum(map(eq, words, words[1:])) / n, phrases, math.log1p(len(lines)), math.log1p(n / len(lines)),
            1 - len(set(lines)) / len(lines), upper / max(1, letters), digits / ink, marks / ink, symbols / ink, chars["!"] / n,
            sum(ends[c] for c in ".!?…") / n, marked / n, bare / n, shouted / n, entropy,
            len(zlib.compress(text.encode("utf-8", "replace"), 1)) / len(text)]


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Ranker:
    """Weights of hinged features; `threshold` is the quantile of the sample's scores that counts as 0.3."""

    def __init__(self, knots: np.ndarray, w: np.ndarray, threshold: float):
        self.knots, self.w, self.threshold = knots, w, threshold

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return hinges(x, self.knots) @ self.w

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = self.strengths(x) - self.threshold + math.log(PASS / (1 - PASS))
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))


class Constant:
    """Stands in where there is nothing to compare."""

    def __init__(self, score: float):
        self.score = score

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.score)


def hinges(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Each feature as its progress (0 to 1) through every interval between its knots: any piecewise linear shape."""
    low, high = knots[:, :-1], knots[:, 1:]
    width = np.where(high > low, high - low, 1.0)
    return np.clip((x[:, :, None] - low) / width, 0, 1).reshape(len(x), low.size)


def preference_pairs(good: np.ndarray, bad: np.ndarray, pairs: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Rows (winner, loser), to look at pairs of small tables: all pairs where they are few, else each row equally often with
    partners drawn at random. Training does not use them, it covers all pairs."""
    if len(good) * len(bad) <= pairs:
        return np.repeat(good, len(bad)), np.tile(bad, len(good))
    deal = lambda rows: rng.permutation(np.resize(rng.permutation(rows), pairs))
    return deal(good), deal(bad)


Rows = Callable[[np.ndarray, np.ndarray], np.ndarray]      # features and labels of some rows -> figures that can be added up
Total = Callable[[Rows], np.ndarray]                       # the sum of such figures over all rows


def order_statistics(total: Total, values: Callable[[np.ndarray], np.ndarray], targets: list[tuple[int, int]]) -> list[float]:
    """For each (column, rank) the value with that rank (from 0) in that column of `values`, over all rows: its bits are found
    digit by digit, each from the counts of the next digit among values that begin like it."""
    digit = 8 if len(targets) > 4 else 16
    begun, ranks = [0] * len(targets), [r for _, r in targets]
    for shift in range(64 - digit, -1, -digit):
        def counts(x: np.ndarray, y: np.ndarray, shift=shift, begun=tuple(begun)) -> np.ndarray:
            bits = np.ascontiguousarray(values(x) + 0.0).view(np.uint64)                  # -0.0 counts as 0.0
            keys = np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63)) >> np.uint64(shift)   # ordered as the values
            found = np.zeros((len(targets), 1 << digit))
            for k, (column, _) in enumerate(targets):
                own = keys[:, column]
                own = own[own >> np.uint64(digit) == np.uint64(begun[k])] if begun[k] or shift < 64 - digit else own
                found[k] = np.bincount((own & np.uint64((1 << digit) - 1)).astype(np.int64), minlength=1 << digit)
            return found

        for k, row in enumerate(np.asarray(total(counts)).reshape(len(targets), -1)):
            below = np.cumsum(row)
            at = min(int(np.searchsorted(below, ranks[k], side="right")), len(row) - 1)
            ranks[k] -= int(below[at - 1]) if at else 0
            begun[k] = (begun[k] << digit) | at
    return [float(np.array([b & ~(1 << 63) if b >> 63 else ~b & ((1 << 64) - 1)], dtype=np.uint64).view(float)[0]) for b in begun]


def feature_knots(total: Total, n: int, width: int) -> np.ndarray:
    """Quantiles of every feature over all rows, and evenly spaced ones: rare forms lie far from all quantiles."""
    at = np.linspace(0, 1, KNOTS) * (n - 1)
    ranks = sorted({r for p in at for r in (math.floor(p), math.ceil(p))})
    targets = [(c, r) for c in range(width) for r in ranks]
    found = np.array(order_statistics(total, lambda x: x, targets)).reshape(width, len(ranks))
    inner = np.array([np.interp(at, ranks, row) for row in found])
    low, high = inner[:, :1], inner[:, -1:]
    evenly = low + (high - low) * np.linspace(0, 1, KNOTS)
    return np.sort(np.hstack([inner, evenly[:, 1:-1]]), axis=1)


class Pairs:
    """Sums over all pairs of a function of their strengths' difference, for the strengths that weights `w` give."""

    def __init__(self, knots: np.ndarray, w: np.ndarray):
        self.knots, self.w = knots, w
        ways = np.cumsum(w.reshape(len(knots), -1), axis=1)                      # a feature adds a value between two of these
        low, high = np.minimum(ways.min(axis=1), 0).sum(), np.maximum(ways.max(axis=1), 0).sum()
        self.middle, self.half = (low + high) / 2, max(1.0, (high - low) / 2)
        self.degrees = 16 + math.ceil(7.5 * self.half)                           # the logistic's poles lie at a distance of pi

    def polynomials(self, h: np.ndarray) -> np.ndarray:
        return np.polynomial.chebyshev.chebvander(np.clip((h @ self.w - self.middle) / self.half, -1, 1), self.degrees - 1)

    def products(self, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """C with f(a - b) = T(a) C T(b) for the polynomials T."""
        at = np.cos(np.pi * (np.arange(self.degrees) + 0.5) / self.degrees)
        solve = np.polynomial.chebyshev.chebvander(at, self.degrees - 1).T * 2 / self.degrees
        solve[0] /= 2
        return solve @ f((at[:, None] - at) * self.half) @ solve.T

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The polynomials summed over good rows, then over poor ones."""
        t = self.polynomials(hinges(x, self.knots))
        return np.array([t[y > 0].sum(axis=0), t[y <= 0].sum(axis=0)])

    def derivatives(self, good: np.ndarray, bad: np.ndarray) -> Rows:
        """The parts of the loss's derivatives that rows add: gradient, curvature by row, polynomials times features of either kind."""
        lost, curved = (self.products(f) for f in (_upset, lambda d: _upset(d) * _upset(-d)))
        tables = [(lost @ bad, curved @ bad, -1.0), (good @ lost, good @ curved, 1.0)]

        def parts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            h = hinges(x, self.knots)
            t = self.polynomials(h)
            size = h.shape[1]
            gradient, curvature, mixed = np.zeros((1, size)), np.zeros((size, size)), []
            for own, (p, q, sign) in zip((y > 0, y <= 0), tables):
                gradient += sign * (t[own] @ p) @ h[own]
                curvature += (h[own] * (t[own] @ q)[:, None]).T @ h[own]
                mixed.append(t[own].T @ h[own])
            return np.vstack([gradient, curvature, *mixed])

        self.curved = curved
        return parts


def _upset(d: np.ndarray) -> np.ndarray:
    """The chance that the loser wins by a difference of strengths of `d`."""
    return 1.0 / (1.0 + np.exp(np.clip(d, -500, 500)))


def fit_rows(total: Total, width: int, ridge: float = 1e-3, steps: int = 40) -> Ranker | Constant:
    """Bradley-Terry weights by Newton's method over all rows and all their pairs, from sums over rows."""
    n_good, n_poor = (int(v) for v in total(lambda x, y: np.array([(y > 0).sum(), (y <= 0).sum()], dtype=float)))
    if not n_good or not n_poor:
        return Constant(0.0 if n_poor else 1.0)
    knots, pairs = feature_knots(total, n_good + n_poor, width), float(n_good) * n_poor
    size = width * (knots.shape[1] - 1)

    def measured(w: np.ndarray) -> tuple[float, Pairs, np.ndarray, np.ndarray]:
        of = Pairs(knots, w)
        good, bad = np.asarray(total(of.sums)).reshape(2, -1)
        return float(good @ of.products(lambda d: np.logaddexp(0, -d)) @ bad / pairs + ridge / 2 * (w @ w)), of, good, bad

    w = np.zeros(size)
    now, of, good, bad = measured(w)
    for _ in range(steps):
        got = np.asarray(total(of.derivatives(good, bad))).reshape(-1, size)
        mixed_good, mixed_bad = got[1 + size: 1 + size + of.degrees], got[1 + size + of.degrees:]
        both = mixed_good.T @ of.curved @ mixed_bad
        gradient = got[0] / pairs + ridge * w
        curvature = (got[1: 1 + size] - both - both.T) / pairs + ridge * np.eye(size)
        step, before, share = np.linalg.solve(curvature, gradient), now, 1.0
        while True:
            now, of, good, bad = measured(w - share * step)
            if now <= before or share < 1e-4:
                break
            share /= 2
        w = w - share * step
        if before - now < 1e-9:
            break
    low, high = order_statistics(total, lambda x: np.einsum("ij,j->i", hinges(x, knots), w)[:, None], [(0, n_poor - 1), (0, n_poor)])
    return Ranker(knots, w, (low + high) / 2)                                    # the quantile: the share of poor rows


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 40) -> Ranker | Constant:
    """`fit_rows` for rows at hand."""
    return fit_rows(lambda rows: rows(x, y), x.shape[1], ridge, steps)


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and features of every row, stored: `doc_id`, `x`."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "x": list(_matrix(b["text"]))})

    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", named.schema["doc_id"].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])
    return stored(named.mapInPandas(run, schema), "quality-features")


def training_rows(described: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and label of every labelled row that is not held out."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max("quality").cast("double").alias("quality"))
    return stored(described.join(known, "doc_id").select("x", "quality"), "quality-training")


def totals(rows: DataFrame) -> Total:
    """Sums over the rows of a table with columns `x` and `quality`: added up in the tasks, then pairwise between them."""
    def total(figures: Rows) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found = 0.0
            for b in batches:
                x = np.array(b["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
                found = found + np.asarray(figures(x, b["quality"].to_numpy(dtype=float)), dtype=float)
            if isinstance(found, np.ndarray):
                yield pd.DataFrame({"sums": [found.tobytes()]})

        parts = rows.mapInPandas(run, "sums binary").rdd.map(lambda r: np.frombuffer(r["sums"]))
        none = np.asarray(figures(np.zeros((0, len(FEATURES))), np.zeros(0)), dtype=float).ravel()
        return parts.treeAggregate(none, np.add, np.add)

    return total


def train(described: DataFrame, labels: DataFrame) -> Ranker | Constant:
    """`described` is what `describe` returns."""
    return fit_rows(totals(training_rows(described, labels)), len(FEATURES))


def score_documents(docs: DataFrame, ranker: Ranker | Constant, text_col: str = "text", to: str = "score") -> DataFrame:
    """`docs` with the score in a new column."""
    return _scored(docs, ranker, text_col, to, _matrix)


def score_described(described: DataFrame, ranker: Ranker | Constant, to: str = "score") -> DataFrame:
    """The same for the table of `describe`."""
    return _scored(described, ranker, "x", to, lambda x: np.array(x.tolist(), dtype=float).reshape(-1, len(FEATURES)))


def _scored(df: DataFrame, ranker: Ranker | Constant, column: str, to: str, matrix: Callable[[pd.Series], np.ndarray]) -> DataFrame:
    model = df.sparkSession.sparkContext.broadcast(ranker)                       # a few hundred numbers

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series(model.value.scores(matrix(values)))

    return df.withColumn(to, F.pandas_udf(run, T.DoubleType())(F.col(column)))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    described = describe(docs, id_col, text_col)
    return score_described(described, train(described, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PASS).cast("int").alias("predicted"))
