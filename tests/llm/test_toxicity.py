import random
import zlib

import numpy as np

from runlens.llm.toxicity import fit, keep_clean, terms, toxicity


def corpus(n=1500):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(3, 7)))
    vocabulary = [word() for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(5, 200))
        toxic = int(rng.random() < 0.2)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["idiotx", "scumzz", "lowexa"]) + rng.choice(["", "en", "isch"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_interactions_are_learned():
    rows = [[0], [1], [0, 1], []] * 200
    y = np.array([0.0, 0.0, 1.0, 0.0] * 200)
    scores = fit(rows, y, np.array([10, 20]), epochs=150, rate=0.3).scores([[0], [1], [0, 1], []])
    assert scores[2] > 0.5 > max(scores[0], scores[1], scores[3])


def test_stems_share_terms():
    assert set(terms("idioten")) & set(terms("idiot.")) and terms("...") == []


def test_held_out_rows_are_scored_well_and_nulls_survive(spark, make_docs):
    docs, labels = corpus()
    extra = [(None, None), (5000, ""), (5001, None), (5001, "idiotx"), (5002, "baba " * 40_000)]
    table = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity(make_docs(docs + extra, clash=True), table).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    hit = sum(r["predicted"] and truth[r["doc_id"]] for r in held)
    assert hit >= 0.9 * sum(truth[r["doc_id"]] for r in held) and sum(r["predicted"] and not truth[r["doc_id"]] for r in held) <= 2
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_without_labels_nothing_is_toxic(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "a"), (2, None)], clash=True)
    assert {r["predicted"] for r in toxicity(docs, none).collect()} == {0}
    assert keep_clean(docs, none).columns == docs.columns and keep_clean(docs, none).count() == 2
    assert toxicity(make_docs([]), none).count() == 0
