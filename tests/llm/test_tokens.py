import random
import zlib

import numpy as np
import pytest

from runlens.llm.encode import Encoder
from runlens.llm.packing import Placement, best_filling, best_fit, least_sequences, pack_documents, plan_packing
from runlens.llm.token_files import EliasFano, TokenFile, pack_file, read_documents, write_files


@pytest.fixture(scope="module")
def enc():
    return Encoder()


def test_cached_encoding_is_the_library_s(spark, enc):
    texts = ["", "  ", "It's 'RE don't.'ve \"'s x'll'd", "<|endoftext|> a", "a b\x85c\x1cd", "ÀÉß µm ²³ 12½", "日本語 text é", "é", "'",
             "a" * 5000, "é" * 3000 + "1" * 40, "İstanbul ΣΑΣ"] + [r["text"] for r in spark.read.parquet(
                 "/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert all(a == enc.whole(t) + b"\x01\x00" for a, t in zip(enc.many(texts), texts))


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [5, 5, 9, 1000, 1000], list(range(0, 100_000, 7)), [0, 2 ** 62]])
def test_elias_fano_round_trip(values):
    ef = EliasFano.build(np.array(values))
    again, _ = EliasFano.read(memoryview(ef.to_bytes()), 0)
    assert again.all().tolist() == values and [again.get(i) for i in range(len(values))] == values


def test_file_round_trip():
    ids = [np.arange(n, dtype="<u2").tobytes() for n in (3, 0, 500, 1)]
    f = TokenFile(pack_file([None, -5, -5, 70], ids, 2))
    assert f.doc_ids() == [None, -5, -5, 70] and [f.ids(i).tobytes() for i in range(4)] == ids


def expected(enc, rows):
    return sorted(((i is not None, i or 0), len(x) // 4, zlib.crc32(x)) for i, x in
                  ((i, enc.as_u4(enc.whole(t or "") + b"\x01\x00")) for i, t in rows))


def test_written_files_give_back_all_ids(spark, make_docs, hard_rows, enc):
    got = read_documents(write_files(make_docs(hard_rows, clash=True), file_ids=50)).collect()
    assert sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["n_tokens"], r["ids_crc32"]) for r in got) == expected(enc, hard_rows)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert read_documents(write_files(make_docs([]))).count() == 0


def test_filling_is_exact_on_small_cases():
    rng = random.Random(3)
    for _ in range(200):
        counts = np.zeros(31, dtype=np.int64)
        for _ in range(rng.randint(1, 8)):
            counts[rng.randint(1, 30)] += 1
        sums = {0}
        for size in np.repeat(np.arange(31), counts).tolist():
            sums |= {s + size for s in sums}
        got = best_filling(30, counts, 100_000)
        assert sum(got) == max(s for s in sums if s <= 30) and all(got.count(x) <= counts[x] for x in got)


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    lengths = [min(4096, int(rng.lognormvariate(6.5, 1.1)) + 1) for _ in range(5000)] + [1] * 9000
    histogram = {x: lengths.count(x) for x in set(lengths)}
    plan = plan_packing(histogram)
    assert all(sum(x) <= 4096 for x, _ in plan) and sum(n for _, n in plan) == -(-sum(lengths) // 4096)
    where = Placement(plan)
    arr = np.repeat(list(histogram), list(histogram.values()))
    ranks = np.concatenate([np.arange(n) for n in histogram.values()])
    seq, off = where.place(arr, ranks)
    used = np.zeros((where.sequences, 4096), dtype=np.int8)
    for s, o, n in zip(seq, off, arr):
        used[s, o: o + n] += 1
    assert used.max() == 1 and ((np.diff(used, axis=1) <= 0).all())


@pytest.mark.parametrize("histogram, most", [({1024: 10, 1433: 12, 1843: 6}, 10), ({1024: 1000, 1433: 1200, 1843: 600}, 1000),
                                             ({1000: 1000, 1200: 1000, 600: 1000}, 749), ({4096: 3, 2049: 5, 2047: 5}, 8)])
def test_plan_is_no_worse_than_best_fit(histogram, most):
    plan = plan_packing(histogram)
    counts = np.bincount(list(histogram), list(histogram.values()), 4097).astype(np.int64)
    used = sum(n for _, n in plan)
    assert least_sequences(counts, 4096) <= used <= sum(n for _, n in best_fit(counts, 4096))
    assert {x: sum(line.count(x) * n for line, n in plan) for x in histogram} == histogram
    assert all(sum(line) <= 4096 for line, _ in plan) and used <= most


def fewest(lengths, capacity):
    """Exact number of sequences, by sets of pieces."""
    best = {0: (1, 0)}
    for have in range(1, 1 << len(lengths)):
        options = []
        for i, x in enumerate(lengths):
            if have >> i & 1:
                n, filled = best[have & ~(1 << i)]
                options.append((n, filled + x) if filled + x <= capacity else (n + 1, x))
        best[have] = min(options)
    return best[(1 << len(lengths)) - 1][0]


def plain_best_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= x), default=None)
        if fit is not None:
            rooms.remove(fit)
        rooms.append((capacity if fit is None else fit) - x)
    return len(rooms)


def test_plan_is_optimal_on_small_cases():
    rng, harder = random.Random(9), 0
    for _ in range(400):
        lengths = [rng.randint(5, 24) for _ in range(rng.randint(2, 10))]
        counts = np.bincount(lengths, minlength=31)
        plan = plan_packing({x: lengths.count(x) for x in lengths}, 30)
        assert sorted(x for line, n in plan for x in line * n) == sorted(lengths) and all(sum(x) <= 30 for x, _ in plan)
        assert sum(n for _, n in best_fit(counts, 30)) == plain_best_fit(lengths, 30)
        least = fewest(lengths, 30)
        assert least_sequences(counts, 30) <= least == sum(n for _, n in plan), lengths
        harder += plain_best_fit(lengths, 30) > least
    assert harder
    for _ in range(200):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(50, 300))]
        assert sum(n for _, n in best_fit(np.bincount(lengths, minlength=31), 30)) == plain_best_fit(lengths, 30)


def test_packing_is_gapless_and_whole(spark, make_docs, hard_rows, enc):
    got = pack_documents(make_docs(hard_rows, clash=True)).toPandas()
    whole = got.assign(known=got.doc_id.notna()).groupby(["known", got.doc_id.fillna(0), "start"]).size()
    assert got["length"].sum() == sum(n for _, n, _ in expected(enc, hard_rows)) and len(whole)
    d = got.sort_values(["sequence_id", "offset"])
    ends = (d.offset + d.length).groupby(d.sequence_id).shift(fill_value=0)
    assert (d.offset == ends).all() and d.groupby("sequence_id").length.sum().max() <= 4096
    assert (got[got.doc_id == 5].sort_values("piece").start.to_numpy() == np.arange((got.doc_id == 5).sum()) * 4096).all()
    assert pack_documents(make_docs([])).count() == 0
