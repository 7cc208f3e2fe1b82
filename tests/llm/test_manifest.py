import hashlib
import random
import zlib

import pytest

from runlens.llm import manifest as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def grow(level):
    """Levels of a tree of threes and, for each leaf, the (left, right) siblings up to the root."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, k in enumerate(at):
            run = range(k // 3 * 3, min(k // 3 * 3 + 3, len(level)))
            paths[i].append(("".join(level[j] for j in run if j < k), "".join(level[j] for j in run if j > k)))
            at[i] = k // 3
        level = [h(*level[k: k + 3]) for k in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        by_source[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [grow([leaf(r) for r in by_source[n]]) for n in names]
    root, tops = grow([t[0] for t in trees])
    out = []
    for name, (sub, paths), top in zip(names, trees, tops):
        for r, path in zip(by_source[name], paths):
            path = path + top
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            d = leaf((*r[:4], text))
            for left, right in path:
                d = h(left, d, right)
            out.append((r[0], leaf(r), sub, root, h(*[a + b for a, b in path]), d, d == root))
    return out


def key(t):
    return tuple(map(str, t))


def check(spark, rows, clash=False):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    if clash:
        for name in ("digest", "leaf", "group", "pos", "n", "path", "root", "subroot", "block", "top", "tampered"):
            df = df.withColumn(name, F.lit("x"))
    got = [tuple(r) for r in M.verify(df.repartition(5)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def some(n, sources, seed=3):
    rng = random.Random(seed)
    return [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 7, 123]), rng.choice(["a\nb", "plain", "", None, "é\n日"]))
            for i in range(n)]


def test_hard_rows_and_hot_source(spark, hard_rows):
    rows = [(i, None if n % 3 else "é", "en", n, t) for n, (i, t) in enumerate(hard_rows)]
    rows += some(300, ["hot"] * 20 + ["b", "", "é", "z", "ä", None])
    check(spark, rows + rows[:3], clash=True)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_small_trees(spark, n):
    check(spark, some(n, ["a"]))


def test_every_source_a_single_row(spark):
    check(spark, [(i, f"s{i}", None, None, "x\ny") for i in range(11)])


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 2)                    # blocks of nine leaves: several tables of tops
    check(spark, some(400, ["hot"] * 9 + [f"s{i}" for i in range(40)] + [None]))


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert M.verify(none).collect() == []
