import math
import random
import zlib

import numpy as np

from runlens.llm.quality import (FEATURES, Constant, Pairs, describe, features, fit, hinges, order_statistics, preference_pairs, quality, totals,
                                 train, training_rows)


def corpus(n=1200, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        good = rng.random() < 0.85
        if not good:
            text = rng.choice([[w.upper() + "!!" for w in text], [w + "%%%" for w in text], [text[0]] * len(text)])
        docs.append((i, " ".join(text) + "."))
        labels.append((i, int(good), 0))
    return docs, labels


def test_newton_finds_the_bradley_terry_maximum():
    """Against plain gradient descent over all pairs, written the long way."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, len(FEATURES)))
    y = (x[:, 0] + 0.5 * rng.normal(size=60) > 0).astype(float)
    model = fit(x, y, ridge=0.05)
    h = hinges(x, model.knots)
    d = np.array([h[i] - h[j] for i in np.flatnonzero(y > 0) for j in np.flatnonzero(y == 0)])
    w = np.zeros(h.shape[1])
    for _ in range(20_000):
        w -= 0.5 * (-(d * (1 / (1 + np.exp(d @ w)))[:, None]).mean(axis=0) + 0.05 * w)
    assert np.abs(model.w - w).max() < 1e-5


def test_the_threshold_is_the_quantile_of_poor_rows():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, len(FEATURES)))
    y = (x[:, 1] > -0.8).astype(float)
    scores = fit(x, y).scores(x)
    assert (scores < 0.3).sum() == (y == 0).sum()


def test_pairs_use_every_row_equally():
    won, lost = preference_pairs(np.arange(10), np.arange(10, 25), 60, np.random.default_rng(1))
    assert len(won) == 60 and set(np.bincount(won)) == {6} and set(np.bincount(lost)[10:]) == {4}
    won, lost = preference_pairs(np.arange(3), np.arange(3, 5), 60, np.random.default_rng(1))
    assert sorted(zip(won, lost)) == [(i, j) for i in range(3) for j in (3, 4)]


def test_features_of_hard_texts(hard_rows):
    for _, text in hard_rows:
        found = features(text)
        assert len(found) == len(FEATURES) and all(map(math.isfinite, found))
    assert features(None) == features("") == features(" \n") == [0.0] * len(FEATURES)


def test_held_out_rows_are_ranked_and_nulls_survive(spark, make_docs):
    docs, labels = corpus()
    extra = [(None, None), (5000, ""), (5001, None), (5002, "baba " * 40_000), (3, "again")]
    table = spark.createDataFrame(labels + [(None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = quality(make_docs(docs + extra, clash=True), table).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: q for i, q, _ in labels}
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert [r["predicted"] for r in got if r["doc_id"] == 5002] == [0]


def test_labels_of_held_out_rows_are_not_used(spark, make_docs):
    docs, labels = corpus(400)
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    turned = [(i, 1 - q if i in held else q, t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (sorted(map(tuple, quality(make_docs(docs), spark.createDataFrame(x, schema)).collect())) for x in (labels, turned))
    assert a == b


def test_one_sided_and_missing_labels(spark, make_docs):
    docs, schema = make_docs([(1, "a b"), (2, None), (3, "c")]), "doc_id long, quality int, toxic int"
    for rows, want in (([], 1), ([(1, 1, 0)], 1), ([(1, 0, 0), (3, 0, 0)], 0)):
        assert {r["predicted"] for r in quality(docs, spark.createDataFrame(rows, schema)).collect()} == {want}
    assert quality(make_docs([]), spark.createDataFrame([], schema)).count() == 0
    assert Constant(1.0).scores(np.zeros((2, 3))).tolist() == [1.0, 1.0]


def test_training_uses_every_labelled_row_and_pair(spark, make_docs):
    """More labelled rows than the 24,000 of the former sample; all of them are counted, and sums over pairs hold every pair."""
    n = 26_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('w', id % 97, ' ', repeat('x! ', CAST(id % 13 AS int))) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 13 < 9 AS int) AS quality", "0 AS toxic")
    want = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(n))
    table = training_rows(described := describe(docs), labels)
    total = totals(table)
    assert table.count() == want and total(lambda x, y: np.array([float(len(y))])).tolist() == [want]
    everything = table.toPandas()
    x, y = np.array(everything["x"].tolist()), everything["quality"].to_numpy()
    ranks = [0, 1, want // 3, want - 1]
    assert order_statistics(total, lambda x: x, [(2, r) for r in ranks] + [(20, r) for r in ranks]) == [
        *np.sort(x[:, 2])[ranks], *np.sort(x[:, 20])[ranks]]
    model, local = train(described, labels), fit(x, y)
    assert np.allclose(model.knots, local.knots) and np.abs(model.w - local.w).max() < 1e-6
    assert ((model.scores(x) >= 0.3) == (y > 0)).mean() > 0.99


def test_sums_over_pairs_equal_those_of_the_pairs():
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(90, len(FEATURES))), np.arange(90) % 3
    knots = np.sort(np.quantile(x, np.linspace(0, 1, 4), axis=0).T, axis=1)
    w = rng.normal(size=len(FEATURES) * 3) * 2
    of, s = Pairs(knots, w), hinges(x, knots) @ w
    good, bad = of.sums(x, y)
    won, lost = preference_pairs(np.flatnonzero(y > 0), np.flatnonzero(y == 0), 10 ** 9, rng)
    for f in (lambda d: np.logaddexp(0, -d), lambda d: 1 / (1 + np.exp(d))):
        assert abs(good @ of.products(f) @ bad / len(won) - f(s[won] - s[lost]).mean()) < 1e-8
