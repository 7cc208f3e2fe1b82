"""The pipeline against brute-force versions of its stages, each on its own input, and every query on a small table."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from runlens.llm.common import read_table, stored
from runlens.llm.encode import Encoder
from runlens.llm.queries import ORACLES, QUERIES
from llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "test-stage")
        seen[name] = (docs, out)
        assert name == "packing" or out.columns == columns
        docs = out
    toxic = {r["doc_id"] for r in read_table(spark, SF, "labels").where("toxic = 1").collect()}
    before, after = ({i for i, _ in rows(df)} for df in seen["toxicity"])
    assert after <= before and len((before - after) - toxic) <= 0.1 * len(before)

    before, after = (rows(df) for df in seen["exact_dedup"])
    best = {}
    for i, t in before:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (1, 0)), (-len(t or ""), i))
    assert {i for _, i in best.values()} == {i for i, _ in after}

    before, after = (rows(df) for df in seen["ngram_join"])
    assert {i for i, (_, c) in brute(before).items() if i == c} == {i for i, _ in after}

    before, after = (Counter(i for i, _ in rows(df)) for df in seen["mixing"])
    assert set(before) == set(after) and max(after.values()) <= 2

    enc, got = Encoder(), seen["packing"][1].toPandas()
    assert got["length"].sum() == sum(len(enc.whole(t or "")) // 2 + 1 for _, t in rows(seen["packing"][0]))
    assert got.groupby("sequence_id")["length"].sum().max() <= 4096


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[c] for c in sorted(names)) for r in got.collect()) == sorted(
        tuple(dict(zip(names, r))[c] for c in sorted(names)) for r in want.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_on_hard_rows(spark, make_docs, hard_rows):
    """Nulls, empty texts, shared ids, clashing columns and empty tables in every stage."""
    twice = [(20, " ".join(f"w{i}" for i in range(60))), (20, " ".join(f"v{i}" for i in range(60))), (21, " ".join(f"w{i}" for i in range(59)) + " x"),
             (None, " ".join(f"v{i}" for i in range(59)) + " y")]
    docs = make_docs(hard_rows + twice, clash=True)
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.limit(0), SF)
        assert none.count() == 0 and (name == "packing" or none.columns == docs.columns)
        out = stored(stage(spark, docs, SF), "test-hard")
        if name == "ngram_join":
            texts = [r["text"] for r in out.collect()]
            assert twice[0][1] in texts and twice[1][1] in texts and twice[2][1] not in texts and twice[3][1] not in texts
            assert texts.count("dup text here") == 1
        docs = docs if name == "exact_dedup" else out
