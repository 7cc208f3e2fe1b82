"""The keyed table: replacing, adding, merging, reading by bucket, retried and failed writes."""

import pytest
from pyspark.sql import functions as F

from runlens.sources.keyed_table import KeyedTable
from runlens.sources.sinks import read_stored, row_id, write_evals
from runlens.streaming.spans import scratch_path

SCHEMA = "s string, k string, v int"


def rows(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


def got(table, buckets=None):
    return sorted(((r.s, r.k, r.v) for r in table.read(buckets).collect()), key=str)


@pytest.mark.parametrize("versions", [1, 2, 8])
def test_put_replaces_groups(spark, versions):
    t = KeyedTable(spark, scratch_path(spark, "t-put"), SCHEMA, ["s"], buckets=4, versions=versions)
    assert got(t) == []
    t.put(rows(spark, ("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, None, 4)))
    t.put(rows(spark, ("a", "z", 5), ("c", None, 6)))
    assert got(t) == sorted([("a", "z", 5), ("b", "x", 3), ("c", None, 6), (None, None, 4)], key=str)
    t.put(rows(spark, (None, "n", 7)), replaced=rows(spark, ("b", None, 0), ("c", None, 0)))
    assert got(t) == sorted([("a", "z", 5), (None, "n", 7)], key=str)
    for v in range(10):
        t.put(rows(spark, ("a", "z", v)))
    assert got(t) == sorted([("a", "z", 9), (None, "n", 7)], key=str)
    assert all(len(v) <= versions for v in t.state().live.values())
    before = len(t._files().globStatus(t._at("data", "bucket=*", "version=*")))
    assert KeyedTable.open(spark, t.path).vacuum() < before and got(t) == sorted([("a", "z", 9), (None, "n", 7)], key=str)


def test_add_new_keeps_the_first_and_all_without_a_key(spark):
    t = KeyedTable(spark, scratch_path(spark, "t-add"), SCHEMA, ["s", "k"], buckets=4, versions=3, bucket_by=["s"], bloom=["k"], adds=True)
    known = F.col("k").isNotNull()
    for n in range(9):
        v = t.add_new(rows(spark, ("a", "x", n), ("a", None, n), ("b", f"k{n}", n), (None, "q", n)), known, batch=n)
        assert {r.v for r in t.read_version(v).collect()} == {n}
        assert t.add_new(rows(spark, ("z", "z", n)), known, batch=n) == v                 # a retried batch is not applied again
    assert got(t) == sorted([("a", "x", 0), (None, "q", 0), *[("a", None, n) for n in range(9)], *[("b", f"k{n}", n) for n in range(9)]], key=str)
    assert all(len(v) <= 4 for v in t.state().live.values())                              # files do not grow with the batches


def test_reads_only_the_wanted_buckets_and_pushes_keys_down(spark):
    t = KeyedTable(spark, scratch_path(spark, "t-read"), SCHEMA, ["s", "k"], buckets=16, bucket_by=["s"], bloom=["k"], adds=True)
    t.add_new(spark.range(400).select(F.concat(F.lit("s"), F.col("id") % 40).alias("s"), F.col("id").cast("string").alias("k"), F.lit(1).alias("v")))
    few = rows(spark, ("s3", "3", 0), ("s3", "999", 0), ("s4", "3", 0))
    buckets = t.buckets_of(few)
    assert 1 <= len(buckets) <= 2
    own = t.read(buckets)
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in own.inputFiles()} == set(buckets)
    found = t.lookup(few, "k")
    assert [(r.s, r.k) for r in found.collect()] == [("s3", "3")]
    assert "In(k, [" in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        t.lookup(t.read(), "k", limit=10)
    with pytest.raises(ValueError):
        t.put(few)


def test_a_failed_write_is_not_seen(spark, monkeypatch):
    t = KeyedTable(spark, scratch_path(spark, "t-fail"), SCHEMA, ["s"], buckets=2, versions=1)
    t.put(rows(spark, ("a", "x", 1)))
    monkeypatch.setattr(t, "_commit", lambda state: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        t.put(rows(spark, ("a", "x", 2)))
    monkeypatch.undo()
    assert got(t) == [("a", "x", 1)]
    t.put(rows(spark, ("a", "x", 3)))
    assert got(t) == [("a", "x", 3)] and t.vacuum() >= 1 and got(t) == [("a", "x", 3)]
    with pytest.raises(ValueError):
        KeyedTable(spark, t.path, SCHEMA, ["s"], buckets=8).read()


def test_ids_are_stable_and_writing_twice_changes_nothing(spark):
    evals = spark.createDataFrame([("t", f"s{i}", "w", o, "e", "a", "m", 0.12345, True, 0.1, "{}") for i in range(5) for o in (0, 1)],
                                  "tenant_id string, session_id string, workflow_id string, config_ord int, eval_name string, agent string, "
                                  "metric string, score double, passed boolean, threshold double, detail string")
    path = scratch_path(spark, "t-evals")
    write_evals(evals, path)
    first = sorted(map(tuple, read_stored(spark, path).collect()))
    write_evals(evals.repartition(3), path)
    write_evals(evals.where("session_id = 's2'"), path)
    assert sorted(map(tuple, read_stored(spark, path).collect())) == first and len(first) == 10
    assert len({r.id for r in read_stored(spark, path).collect()}) == 10
    ids = spark.range(1).select(row_id(F.lit("a"), F.lit(None)), row_id(F.lit("a"), F.lit("")), row_id(F.lit("a\u001f"), F.lit("b"))).first()
    assert len(set(ids)) == 3 and all(len(x) == 36 for x in ids)


def test_a_put_that_replaces_every_group_of_a_bucket_is_written_once(spark):
    t = KeyedTable(spark, scratch_path(spark, "t-once"), SCHEMA, ["s"], buckets=1, versions=1)
    t.put(rows(spark, ("a", "x", 1), (None, "y", 2)))
    version = t.put(rows(spark, ("a", "x", 3)), replaced=rows(spark, (None, "", 0)))
    assert t.state().live == {0: [version]} and got(t) == [("a", "x", 3)]
    assert len(t._files().globStatus(t._at("data", "bucket=*", "version=*"))) == 2          # no merged version
    merged = t.put(rows(spark, ("b", "x", 4)))                                               # a's rows outlive this one
    assert len(t.state().live[0]) == 1 and t.state().live[0] != [merged] and got(t) == [("a", "x", 3), ("b", "x", 4)]


def test_a_write_is_split_by_size_however_few_buckets(spark):
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        t = KeyedTable(spark, scratch_path(spark, "t-split"), SCHEMA, ["s"], buckets=1)
        t.put(spark.range(0, 100_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("s"), F.lit("k").alias("k"), F.lit(1).alias("v")))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(t.read().inputFiles()) > 2 and t.read().count() == 100_000
