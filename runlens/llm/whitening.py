"""Embedding whitening by a bidiagonal qd solver.

Entries become integers x = floor(1024 c) + 100000, so sums and deviations are exact. Then
1. blockwise QR: every task reduces its centred rows, block by block, to one triangle; the triangles are combined in groups
   of FAN_IN until one is left, R, with R'R = sum of (x - mean)(x - mean)';
2. Householder reflections bring R to an upper bidiagonal B (only the right reflections are needed afterwards);
3. dqds finds the singular values of B from its squared entries without subtractions that cancel, so that small ones are
   as accurate as large ones; the shifts are Newton lower bounds, with deflation at negligible entries;
4. for each wanted value a twisted factorisation of B'B - s I gives the vector; directions of values that lie close together
   are found by inverse iteration with the same factorisation, kept orthogonal to each other; the right reflections turn
   them into components;
5. rows are projected and divided by the standard deviation; the covariance of the result is measured over all rows.

Only triangles (dims x dims numbers each) move, and the driver holds one of them. Each step is recomputed by Spark when an
executor is lost; nothing is kept outside the job.

Cases: a vector that is null, empty, or holds null or non-finite entries is dropped, as is one whose length is not the
commonest (the longer one on a tie) and one with an entry of 2^41 or more (its integer would not be exact). Null and
repeated ids are rows like others. Components whose variance vanishes (constant data, fewer rows than dimensions) do not
exist: with none, or with an empty table, the result is empty. `deviation` is a decimal; the query's long is null where
it does not fit. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import stored

SCALE, OFFSET = 1024, 100_000      # fixed values of the contract
TOP = 8
BLOCK = 4096                       # rows of one QR step in a task
FAN_IN = 32                        # triangles combined by one task
EPS = float(np.finfo(float).eps)


# ── singular values and directions of a triangle ──────────────────────────────────────────────

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and the orthogonal V with r = U B V' (U is not formed)."""
    m = np.array(r, dtype=float)
    d = m.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or np.linalg.norm(x[1:]) == 0:
            return None
        u = x / size
        u[0] += np.copysign(1.0, u[0])
        return u / np.linalg.norm(u)

    for k in range(d):
        if (u := reflector(m[k:, k].copy())) is not None:
            m[k:, k:] -= 2.0 * np.outer(u, u @ m[k:, k:])
        if k + 2 < d and (u := reflector(m[k, k + 1:].copy())) is not None:
            m[k:, k + 1:] -= 2.0 * np.outer(m[k:, k + 1:] @ u, u)
            v[:, k + 1:] -= 2.0 * np.outer(v[:, k + 1:] @ u, u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _newton_bound(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest eigenvalue: 1 / trace of the inverse."""
    total = last = 1.0 / q[-1]
    for i in range(len(q) - 2, -1, -1):
        last = (1.0 + e[i] * last) / q[i]
        total += last
    return 1.0 / total


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd step with a shift; None where the shift was too large."""
    d = q[0] - shift
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        if top == 0:
            new_q.append(0.0)
            new_e.append(0.0)
            d = q[i + 1] - shift
            continue
        new_q.append(top)
        ratio = q[i + 1] / top
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared singular values of the bidiagonal (a, b), falling; the smallest eigenvalue of each part is found first."""
    found: list[float] = []
    parts = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    largest = max([1e-300, *parts[0][0], *parts[0][1]])
    while parts:
        q, e, passed = parts.pop()
        while q:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (passed + min(q[i], q[i + 1])) or e[i] < 1e-290), None)
            if cut == len(e) - 1 or not e:
                found.append(passed + q[-1])                          # deflation: the last entry stands alone
                q, e = q[:-1], e[:-1]
                continue
            if cut is not None:
                parts.append((q[:cut + 1], e[:cut], passed))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if min(q) <= EPS * EPS * EPS * largest:                   # a zero on the diagonal: an unshifted step moves it to the end
                step, shift = _dqds(q, e, 0.0), 0.0
                if min(step[0]) == min(q) == q[-1]:
                    e[-1] = 0.0
                    continue
            else:
                shift = _newton_bound(q, e) * (1 - 8 * EPS)
                step = _dqds(q, e, shift)
                while step is None:
                    shift = shift / 2 if shift > EPS * EPS * largest else 0.0
                    step = _dqds(q, e, shift)
            (q, e), passed = step, passed + shift
    return np.sort(np.maximum(found, 0.0))[::-1]


class Twisted:
    """Twisted factorisation of B'B - s I for the bidiagonal (a, b): both sweeps and the best place to meet."""

    def __init__(self, a: np.ndarray, b: np.ndarray, s: float):
        n = len(a)
        tiny = EPS * EPS * (float(np.max(a * a)) + float(np.max(b * b, initial=0.0)) + 1e-280)
        safe = lambda x: x if abs(x) > tiny else np.copysign(tiny, x)
        off, diagonal = a[:-1] * b, a * a
        self.n, self.s = n, s
        plus, low, down = np.zeros(n), np.zeros(n - 1), np.zeros(n)            # from the top: L+ D+ L+'
        down[0] = -s
        for i in range(n - 1):
            plus[i] = safe(down[i] + diagonal[i])
            low[i] = off[i] / plus[i]
            down[i + 1] = low[i] * (b[i] / a[i] if a[i] else 0.0) * down[i] - s if a[i] else b[i] ** 2 - s
        plus[n - 1] = safe(down[n - 1] + diagonal[n - 1])
        minus, high, up = np.zeros(n), np.zeros(n - 1), np.zeros(n)            # from the bottom: U- D- U-'
        up[n - 1] = diagonal[n - 1] - s
        for i in range(n - 2, -1, -1):
            minus[i + 1] = safe(b[i] ** 2 + up[i + 1])
            high[i] = off[i] / minus[i + 1]
            up[i] = up[i + 1] * (diagonal[i] / minus[i + 1]) - s
        minus[0] = safe(up[0] + 0.0)
        gamma = down + up + s
        self.plus, self.minus, self.low, self.high = plus, minus, low, high
        self.meet = int(np.argmin(np.abs(gamma)))
        self.gamma = safe(float(gamma[self.meet]))

    def vector(self) -> np.ndarray:
        z, k = np.zeros(self.n), self.meet
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -self.low[i] * z[i + 1]
        for i in range(k, self.n - 1):
            z[i + 1] = -self.high[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, r: np.ndarray) -> np.ndarray:
        """x with (B'B - s I) x = r, by the sweeps that meet at `meet`."""
        y, k = r.astype(float).copy(), self.meet
        for i in range(k):
            y[i + 1] -= self.low[i] * y[i]
        for i in range(self.n - 1, k, -1):
            y[i - 1] -= self.high[i - 1] * y[i]
        x = np.zeros(self.n)
        x[k] = y[k] / self.gamma
        for i in range(k - 1, -1, -1):
            x[i] = y[i] / self.plus[i] - self.low[i] * x[i + 1]
        for i in range(k + 1, self.n):
            x[i] = y[i] / self.minus[i] - self.high[i - 1] * x[i - 1]
        return x


def directions(a: np.ndarray, b: np.ndarray, values: np.ndarray, near: float = 1e-3) -> np.ndarray:
    """Unit eigenvectors (columns) of B'B for its largest eigenvalues `values`, falling."""
    diagonal = a * a + np.concatenate([[0.0], b * b])
    off = a[:-1] * b
    times = lambda z: diagonal * z + np.concatenate([off * z[1:], [0.0]]) + np.concatenate([[0.0], off * z[:-1]])
    out, rng = [], np.random.default_rng(11)
    for k, s in enumerate(values):
        # all earlier directions whose values form one chain of close neighbours with this one
        first = k
        while first > 0 and values[first - 1] - values[first] <= near * values[first - 1]:
            first -= 1
        kin = out[first:k]
        z = Twisted(a, b, s).vector()
        residual = np.linalg.norm(times(z) - s * z)
        if kin or not residual <= 64 * EPS * values[0]:
            solver = Twisted(a, b, s)
            z = rng.normal(size=len(a))
            for _ in range(6):
                for _ in range(2):
                    for other in kin:
                        z = z - (other @ z) * other
                z = solver.solve(z / np.linalg.norm(z))
                z = z / np.linalg.norm(z)
            for other in kin + kin:
                z = z - (other @ z) * other
            z = z / np.linalg.norm(z)
        out.append(z)
    return np.array(out).T.reshape(len(a), -1)


def components(r: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of a triangle, falling, and their right singular vectors (columns)."""
    if not r.size or not np.any(r):
        return np.zeros(0), np.zeros((r.shape[1], 0))
    size = float(np.max(np.abs(r)))
    a, b, v = bidiagonalise(r / size)
    values = squared_singular_values(a, b)
    values = values[:top][values[:top] > values[0] * (EPS * len(a)) ** 2 * 64]      # the rest is rounding: no variance
    z = directions(a, b, values)
    w = v @ z
    return values * size * size, w / np.linalg.norm(w, axis=0)


# ── on Spark ──────────────────────────────────────────────────────────────────────────────────

@dataclass
class Whitening:
    """What projects a row: sums and number of rows, components (rows) and their variances."""
    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float


def integer_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Stored vec_id and x (array<long>) of the usable rows."""
    c = F.col(vector_col).cast("array<double>")
    named = embeddings.select(F.col(id_col).alias("vec_id"), c.alias("c")).where(
        F.col("c").isNotNull() & (F.size("c") > 0)
        & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 2.0 ** 41)))
    x = stored(named.select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE) + F.lit(OFFSET)).alias("x")), "whitening-x")
    sizes = x.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    return x.where(F.size("x") == (sizes[0]["dims"] if sizes else 0))


def _rows(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n as double: the whole part of the mean is taken off in integers."""
    whole = np.array([int(s) // n for s in sums], dtype=np.int64)
    rest = np.array([(int(s) % n) / n for s in sums])
    return (x - whole).astype(float) - rest


def dimension_sums(x: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, None
        for b in batches:
            if len(b):
                rows = _rows(b["x"])
                n += len(rows)
                high, low = rows >> 31, rows & (2 ** 31 - 1)                     # halves: no overflow in a batch
                part = [int(h) * 2 ** 31 + int(lo) for h, lo in zip(high.sum(axis=0), low.sum(axis=0))]
                total = part if total is None else [p + t for p, t in zip(part, total)]
        if total is not None:
            yield pd.DataFrame({"dim": range(len(total)), "total": [str(t) for t in total], "rows": n})

    got = x.select("x").mapInPandas(add, "dim int, total string, rows long").groupBy("dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("rows")).orderBy("dim").collect()
    return (int(got[0]["rows"]) if got else 0), [int(r["total"]) for r in got]


def triangle(x: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows, by QR in blocks, per task and then in groups of tasks."""
    dims, s = len(sums), np.array(sums, dtype=object)

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = np.zeros((0, dims))
        for b in batches:
            for at in range(0, len(b), BLOCK):
                r = np.linalg.qr(np.vstack([r, _centred(_rows(b["x"].iloc[at: at + BLOCK]), n, s)]), mode="r")
        if len(r):
            yield pd.DataFrame({"r": [r.ravel()]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        stack = np.vstack([np.asarray(v, dtype=float).reshape(-1, dims) for v in group["r"]])
        return pd.DataFrame({"slot": [int(group["slot"].iloc[0])], "r": [np.linalg.qr(stack, mode="r").ravel()]})

    parts = stored(x.select("x").mapInPandas(reduce_rows, "r array<double>").withColumn("slot", F.spark_partition_id()), "whitening-r")
    left = parts.agg(F.max("slot")).first()[0] + 1                               # slots: no more than tasks
    while left > 1:
        left = -(-left // FAN_IN)
        parts = stored(parts.withColumn("slot", F.expr(f"slot div {FAN_IN}")).groupBy("slot").applyInPandas(
            merge, "slot int, r array<double>"), "whitening-r")
    last = [np.asarray(r["r"], dtype=float).reshape(-1, dims) for r in parts.collect()]      # one triangle
    r = np.linalg.qr(np.vstack(last), mode="r")
    return np.vstack([r, np.zeros((dims - len(r), dims))])


def fit(x: DataFrame, top: int = TOP) -> Whitening | None:
    n, sums = dimension_sums(x)
    if not n:
        return None
    r = triangle(x, n, sums)
    values, vectors = components(r, top)
    # `values` are sums of squares over the rows: divisor n
    return Whitening(n, sums, vectors.T, values / n, float((r * r).sum()) / n)


def project(x: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (decimal) and the whitened vector."""
    shared = x.sparkSession.sparkContext.broadcast(model)                        # a few vectors

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        s, weights = np.array(m.sums, dtype=object), (m.directions / np.sqrt(m.variances)[:, None]).T
        whole = np.array([v // m.n for v in m.sums], dtype=np.int64)
        rest = np.array([v % m.n for v in m.sums], dtype=np.int64)
        for b in batches:
            if not len(b):
                continue
            rows = _rows(b["x"])
            # n x - S = n (x - whole) - rest, so the sum of its squares is n^2 sum c^2 - 2 n sum c rest + sum rest^2
            c = rows - whole
            if np.abs(c).max() < 2 ** 25 and m.n < 2 ** 40 and c.shape[1] < 2 ** 12:      # no sum of products overflows
                crossed = [(int(h) << 20) + int(lo) for h, lo in zip((c * (rest >> 20)).sum(axis=1), (c * (rest & 0xFFFFF)).sum(axis=1))]
                square = sum(int(v) ** 2 for v in rest)
                deviation = [m.n * m.n * int(p) - 2 * m.n * q + square for p, q in zip((c * c).sum(axis=1), crossed)]
            else:
                deviation = [sum((m.n * int(v) - t) ** 2 for v, t in zip(row, m.sums)) for row in rows]
            yield pd.DataFrame({"vec_id": b["vec_id"].astype("Int64"), "deviation": [str(v) for v in deviation],
                                "z": list(_centred(rows, m.n, s) @ weights)})

    return x.mapInPandas(run, "vec_id long, deviation string, z array<double>").withColumn(
        "deviation", F.col("deviation").try_cast("decimal(38,0)"))


def identity_error(projected: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of z (divisor n, centred) minus the identity."""
    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, mean, about = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            if len(b):
                z = np.array(b["z"].tolist(), dtype=float)
                m, own = len(z), z.mean(axis=0)
                shift = own - mean
                about += (z - own).T @ (z - own) + np.outer(shift, shift) * n * m / (n + m)
                mean, n = mean + shift * m / (n + m), n + m
        if n:
            i, j = np.divmod(np.arange(k * k), k)
            yield pd.DataFrame({"i": i, "j": j, "n": n, "mi": mean[i], "mj": mean[j], "about": about.ravel()})

    got = projected.select("z").mapInPandas(moments, "i int, j int, n long, mi double, mj double, about double").groupBy("i", "j").agg(
        (F.sum(F.col("about") + F.col("n") * F.col("mi") * F.col("mj")) / F.sum("n")
         - F.sum(F.col("n") * F.col("mi")) / F.sum("n") * F.sum(F.col("n") * F.col("mj")) / F.sum("n")).alias("cov"))
    error = F.abs(F.col("cov") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return float(got.agg(F.max(error)).first()[0])


RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, top: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component (1 is the largest)."""
    x = integer_vectors(embeddings, id_col, vector_col)
    model = fit(x, top)
    if model is None or not len(model.variances):
        return embeddings.sparkSession.createDataFrame([], RESULT)
    rows = stored(project(x, model), "whitened")
    error = identity_error(rows, len(model.variances))
    share = F.element_at(F.array(*[F.lit(float(v / model.trace)) for v in model.variances]), F.col("component"))
    return rows.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).withColumn(
        "component", (F.col("at") + 1).cast("int")).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(error).alias("identity_error"))
