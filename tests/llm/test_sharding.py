import random
import zlib

from runlens.llm.sharding import balanced_cuts, needed, shard_documents, smallest_capacity


def best_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, left = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > left:
                used, left = used + 1, mid
            left -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def test_search_agrees_with_brute_force():
    rng = random.Random(5)
    for _ in range(50):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(1, 60))]
        totals = [sum(sizes[: i + 1]) for i in range(len(sizes))]
        cap = smallest_capacity(totals, 16, max(max(sizes), -(-totals[-1] // 16)), totals[-1])
        assert cap == best_capacity(sizes, 16) and len(needed(totals, cap)) <= 16
        cuts = [0, *balanced_cuts(totals, cap, 16), totals[-1]]
        assert len(cuts) == 17 and max(b - a for a, b in zip(cuts, cuts[1:])) <= cap and cuts == sorted(cuts)


def test_shards_are_whole_and_minimal(spark, make_docs, hard_rows):
    rng = random.Random(1)
    rows = hard_rows + [(100 + i, rng.choice("abc") * rng.randint(1, 2000)) for i in range(400)]
    for limit in (32, 16_384):                     # the narrow search and the whole one
        got = shard_documents(make_docs(rows, clash=True), limit=limit).collect()
        assert len(got) == len(rows)
        groups, sizes, slots = {}, {}, {}
        for r in got:
            sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(sizes) <= set(range(16))
        order = {}
        for i, t in rows:
            groups.setdefault(t or "", []).append(i)
        for t, ids in groups.items():
            known = [i for i in ids if i is not None]
            order[t] = (min(known) if known else -1)
        ordered = [(len(t.encode()) + 1) * len(ids) for t, ids in sorted(groups.items(), key=lambda g: order[g[0]])]
        assert max(sizes.values()) <= best_capacity(ordered, 16)
        crc = {i: zlib.crc32((t or "").encode()) for i, t in rows if i is not None}
        assert all(r["text_crc32"] == crc[r["doc_id"]] for r in got if r["doc_id"] is not None)


def test_one_huge_group_and_empty(spark, make_docs):
    got = shard_documents(make_docs([(i, "same" if i < 50 else f"t{i}") for i in range(100)])).collect()
    assert len({r["shard"] for r in got if r["text_crc32"] == zlib.crc32(b"same")}) == 1 and len({r["shard"] for r in got}) > 8
    assert shard_documents(make_docs([])).count() == 0
