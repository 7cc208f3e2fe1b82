import math
import random
from collections import Counter, defaultdict

from runlens.llm.mixing import draw, mix_documents


def corpus():
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a"] * 30 + ["b"] * 8 + ["c"] * 2 + [None])) for i in range(3000)]
    return rows + [(None, "x y", "b"), (None, "x y", "b"), (7, "again", "c")]


def shares(rows):
    tokens = Counter()
    for _, t, s in rows:
        tokens[s or ""] += len(t.split()) + 1
    total = sum(tokens.values())
    return tokens, {s: n / total for s, n in tokens.items()}


def entropy(p):
    return -sum(x * math.log(x) for x in p)


def bisect(p, fine):
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        q = {s: x ** mid for s, x in p.items()}
        low, high = (low, mid) if fine({s: x / sum(q.values()) for s, x in q.items()}) else (mid, high)
    return high


def test_weights_budget_and_permutations(spark, make_docs):
    rows = corpus()
    tokens, p = shares(rows)
    goal = 0.9 * math.log(len(p))
    a = max(bisect(p, lambda w: entropy(w.values()) <= goal), bisect(p, lambda w: max(w[s] / p[s] for s in p) <= 4))
    q = {s: x ** a for s, x in p.items()}
    got = draw(make_docs(rows, clash=True), entropy=0.9).collect()
    used, epochs = Counter(), defaultdict(Counter)
    for r in got:
        s = r["source"] or ""
        used[s] += r["n_tokens"]
        epochs[s][r["epoch"]] += r["n_tokens"]
        assert abs(r["exponent"] - a) < 1e-6 and abs(r["weight"] - q[s] / sum(q.values())) < 1e-6
    total = sum(tokens.values())
    for s in tokens:
        budget = q[s] / sum(q.values()) * total
        assert budget - 42 <= used[s] <= budget + 0.01
        assert all(n == tokens[s] for e, n in epochs[s].items() if e < max(epochs[s]))        # whole epochs are whole


def test_cover_keeps_every_document(spark, make_docs):
    rows = corpus()
    docs = make_docs(rows)
    mixed = mix_documents(docs)
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and set(times) == {i for i, _, _ in rows} and max(v for k, v in times.items() if k not in (None, 7)) == 2
    repeated = Counter(r["source"] for r in draw(docs, None, 1.25, True).collect() if r["epoch"] == 1)
    assert repeated["a"] == 0 and sum(repeated.values()) > 0


def test_one_source_and_empty(spark, make_docs):
    assert draw(make_docs([(1, "a b", "x"), (2, None, "x")])).count() == 2
    assert draw(make_docs([])).count() == 0 and mix_documents(make_docs([])).count() == 0
