import random
import re
from collections import defaultdict

import numpy as np

from runlens.llm.components import Forest, components
from runlens.llm.ngram_join import PrefixTree, least_difference, near_duplicates, needed, parity_sketch
from runlens.llm.shingles import shingle_sets


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        common = defaultdict(int)
        for s in sets[k]:
            for j in holders[s]:
                common[j] += 1
            holders[s].append(k)
        for j, n in common.items():
            if 100 * n >= 75 * (len(sets[k]) + len(sets[j]) - n):
                a, b = root(i), root(rows[j][0])
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for (i, _), s in zip(rows, sets)}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    shared = " ".join(word() for _ in range(60))
    rows, i = [], 1000
    for _ in range(40):
        base = [word() for _ in range(rng.choice([3, 8, 40, 300]))]
        for _ in range(rng.choice([1, 2, 30])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                w[rng.randrange(len(w))] = word()
            text = " ".join(w)
            if rng.random() < 0.3:
                text = shared + " " + text
            rows.append((i, text.upper() if rng.random() < 0.2 else text))
            i += rng.randint(1, 3)
    rng.shuffle(rows)
    return rows


def test_sets_have_the_sizes_of_word_sets():
    texts = [t for _, t in corpus()] + [None, "", " \t", "a", "a b c d", "a b c d e", "A B c d e\x0bf", "é É", "x" * 100_000, "w " * 50_000]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]


def test_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        u = rng.integers(0, 2 ** 63, 400, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(u[: rng.integers(1, 400)]), np.unique(u[rng.integers(0, 300):])
        assert least_difference(parity_sketch(a), parity_sketch(b)) <= len(np.setxor1d(a, b))


def test_tree_finds_exactly_the_similar_sets():
    rng = random.Random(6)
    for _ in range(60):
        base = rng.sample(range(1000), 40)
        sets = []
        for _ in range(25):
            s = set(rng.sample(base, rng.randint(28, 40))) | set(rng.sample(range(1000), rng.randint(0, 6)))
            sets.append(np.array(sorted(s), dtype=np.uint64))
        tree = PrefixTree(sets)
        for k in range(24):
            tree.add(k)
        got = sorted(tree.similar(sets[24], lambda m: False))
        assert got == [k for k in range(24) if len(np.intersect1d(sets[k], sets[24])) >= needed(len(sets[k]), len(sets[24]))]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(500, 700)] + [(900, 901), (901, 902), (902, 900), (3, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {r["node"]: r["component"] for r in components(df, links_per_forest=20).collect()}     # many forests, star steps
    forest = Forest()
    for a, b in links:
        forest.join(a, b)
    assert got == {x: forest.root(x) for ab in links for x in ab if x != 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_agree_with_brute_force(spark, make_docs):
    rows = corpus() + [(1, ""), (2, None), (3, "\n"), (4, "short"), (5, "SHORT"), (6, "w " * 30_000), (7, "w " * 29_000)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(make_docs(rows, clash=True)).collect()}
    assert got == brute(rows)


def test_nulls_repeats_and_empty(spark, make_docs):
    got = near_duplicates(make_docs([(None, "a b c d e f"), (9, "a b c d e f"), (9, "a b c d e f"), (None, "x"), (8, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got if r["component_id"]) == [
        (0, 2, 9), (8, 0, 8), (9, 2, 9), (9, 2, 9)]
    assert [r["n_shingles"] for r in got if r["component_id"] is None] == [1]
    assert near_duplicates(make_docs([])).count() == 0


def test_rows_that_share_an_id_keep_their_links(spark, make_docs):
    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (1, " ".join(a[:-1] + ["x"])), (2, " ".join(b[:-1] + ["y"])), (None, " ".join(b[:-1] + ["z"])), (7, "alone")]
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in near_duplicates(make_docs(rows)).collect())
    assert got == [("1", 1), ("2", 2), ("5", 1), ("5", 2), ("7", 7), ("None", 2)]


def test_large_groups_in_blocks(spark, make_docs, monkeypatch):
    """Groups of many blocks: alike, in several components, and linked only through a chain."""
    from runlens.llm import ngram_join as N
    monkeypatch.setattr(N, "CHUNK", 8)
    monkeypatch.setattr(N, "UNIT", 16)
    monkeypatch.setattr(N, "PIVOTS", 2)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(90):                                     # near copies of one text
        w = list(base)
        w[rng.randrange(80)] = f"n{i}"
        rows.append((i, " ".join(w)))
    for i in range(60):                                     # a drifting text: neighbours are similar, the ends are not
        rows.append((200 + i, " ".join(f"c{k}" for k in range(4 * i, 4 * i + 90))))
    rows += [(1000 + i, f"u{i} v{i}") for i in range(1100)]     # several slices of a batch
    rng.shuffle(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(make_docs(rows).coalesce(1)).collect()}
    assert got == brute(rows)


def test_shared_entries_need_one_exchange(spark):
    from runlens.llm.ngram_join import prefix_entries, shared_entries
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " x"), (3, text)], "doc_id long, text string").repartition(3)
    found = shared_entries(prefix_entries(docs, np.zeros(1 << 17, dtype=np.int64)))
    assert found.count() > 0 and found.count() == found.distinct().count()
    assert found._jdf.queryExecution().sparkPlan().toString().count("Window") == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning(shingle") == 1
