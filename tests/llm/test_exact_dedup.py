import hashlib
import re

import numpy as np
import pytest

from runlens.llm.exact_dedup import build_hash, dedup, dedup_documents, keep_first, slots


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    return groups


@pytest.mark.parametrize("n", [0, 1, 2, 100, 5000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.frombuffer(b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(n)), np.uint8).reshape(n, 32)
    sizes, bits = build_hash(keys)
    assert sorted(slots(sizes, bits, keys).tolist()) == list(range(n))


def test_same_key_twice_is_an_error():
    key = np.frombuffer(hashlib.sha256(b"a").digest() * 2, np.uint8).reshape(2, 32)
    with pytest.raises(ValueError):
        build_hash(key)


def test_marks_agree_with_brute_force(spark, make_docs, hard_rows):
    rows = hard_rows + [(100 + i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)]
    got = dedup_documents(make_docs(rows, clash=True)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    for r in got:
        group = by_text[r["text_sha256"]]
        assert r["group_size"] == len(group) and r["keep_id"] == min(group)[3] and r["kept"] == (r["doc_id"] == r["keep_id"])


def test_history_and_batch(spark, make_docs):
    old, new = make_docs([(1, "a b"), (2, "c"), (3, "c ")]), make_docs([(4, "ab"), (5, "c   "), (6, "d"), (7, "d")])
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["in_history"]) for r in dedup(old, new).collect()}
    assert got == {1: (1, 2, True), 4: (1, 2, True), 2: (5, 3, True), 3: (5, 3, True), 5: (5, 3, True), 6: (6, 2, False), 7: (6, 2, False)}


def test_keep_first_keeps_columns_and_one_row(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows, clash=True)
    kept = keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(brute(hard_rows))


def test_empty_table(spark, make_docs):
    assert dedup_documents(make_docs([])).count() == 0
