import numpy as np

from runlens.llm.embedding_dedup import near_duplicate_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, component string"


def brute(rows, threshold=0.93):
    parent = {i: i for i, _, _ in rows}
    links = dict.fromkeys(parent, 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ok = [(i, np.array(v, dtype=np.float32).astype(float), y) for i, v, y in rows
          if v is not None and y is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    for k, (i, v, y) in enumerate(ok):
        for j, w, z in ok[:k]:
            if y == z and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], root(i), root(i) == i) for i in parent}


def test_agrees_with_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for label in (0, 0, 1, 2, None):
        for _ in range(12):
            base = rng.normal(size=24)
            for _ in range(int(rng.choice([1, 2, 20]))):
                rows.append((i, (base + rng.normal(size=24) * rng.choice([0, 0.05, 0.2, 0.3])).astype(np.float32).tolist(), label))
                i += 1
    rows += [(i, None, 1), (i + 1, [0.0] * 24, 1), (i + 2, [float("nan")] + [1.0] * 23, 1), (i + 3, [None] + [1.0] * 23, 1),
             (i + 4, [float("inf")] + [1.0] * 23, 1), (i + 5, rows[0][1], 0), (i + 6, rows[0][1], 0), (i + 7, [], 1),
             (i + 8, [1.0, 2.0], 1), (i + 9, [2.0, 4.0], 1), (i + 10, [-0.0, 1.0], 1), (i + 11, [0.0, 1.0], 1), (i + 12, [3e38] * 24, 0),
             (i + 13, [1e-38] * 24, 0)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(df).collect()}
    assert got == brute(rows)


def test_empty_and_unusable(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, None, 1, "", ""), (None, [1.0], 1, "", "")], SCHEMA)
    assert sorted((r["vec_id"] or 0, r["n_links"]) for r in near_duplicate_vectors(only).collect()) == [(0, 0), (1, 0)]
