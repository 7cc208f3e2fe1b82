"""Packing documents into as few sequences as possible by bin completion.

Texts are encoded whole; a document longer than the capacity is cut into full pieces and a rest. All
pieces of one length are alike, so the packing problem is the histogram of lengths: at most `capacity`
counts, however many documents there are. The best-fit-decreasing plan is the first incumbent; where it needs no more
sequences than a lower bound (total length, and large pieces that can't share a sequence) it is returned. Else a
branch and bound takes the largest length left, and branches over the fillings of the space beside it that no
single larger piece improves, the one of least waste first, each for as many sequences as the counts allow and for
one; states that the bound or an equal earlier state rules out are cut. Without a limit it is exhaustive; after
PLAN_STATES further choices, or with more fillings than SEARCH_NODES reach, the best plan so far holds.

Spark does the rest: pieces are numbered within their length (counts by task, added up, plus the place in the
task; no length is numbered by one task), and a piece's number tells its line of the plan, its sequence and
its offset. Sequence ids are below the number of sequences.

Null text is empty: one piece with the end id only. Repeated rows and null ids are packed row by row. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import slices, stored
from runlens.llm.encode import END_ID, TOKENIZER, encoder

CAPACITY = 4096
SEARCH_NODES = 4000      # nodes of one search for a filling; the incumbent holds beyond
PLAN_STATES = 2000       # choices of the search for a plan besides the first of each state

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def best_filling(room: int, counts: np.ndarray, nodes: int = SEARCH_NODES) -> list[int]:
    """Lengths (largest first) from `counts` whose sum is as near to `room` as possible.

    Lengths are tried from the largest that fits, each as often as it fits first, so the first leaf is
    the best-fit filling and every filling comes after those that dominate it."""
    sizes = np.flatnonzero(counts[: room + 1])
    largest = np.zeros(room + 1, dtype=np.int64)
    largest[sizes] = sizes
    largest = np.maximum.accumulate(largest).tolist()                            # the largest length up to a room
    reach = np.cumsum(counts[: room + 1] * np.arange(room + 1)).tolist()         # the sum of all pieces up to a length
    best: list[tuple[int, int]] = []
    best_left, tried = room, 0
    stack: list[tuple[int, int]] = []

    def search(left: int, top: int) -> bool:
        """Fill `left` with lengths of at most `top`; True when the search is over."""
        nonlocal best, best_left, tried
        size = largest[min(left, top)]
        while size and left - reach[size] < best_left:          # waste bound
            for k in range(min(int(counts[size]), left // size), 0, -1):
                tried += 1
                stack.append((size, k))
                if left - k * size < best_left:
                    best, best_left = stack.copy(), left - k * size
                done = best_left == 0 or tried >= nodes or search(left - k * size, size - 1)
                stack.pop()
                if done:
                    return True
            size = largest[size - 1]
        return False

    search(room, room)
    return [size for size, k in best for _ in range(k)]


def fillings(room: int, counts: np.ndarray, waste: int, nodes: int = SEARCH_NODES) -> list[list[int]]:
    """Fillings of `room` that leave at most `waste`, no piece can be added to and no piece be replaced by a larger
    one in; least waste first."""
    counts = counts[: room + 1].copy()
    sizes = np.flatnonzero(counts).tolist()
    reach = np.cumsum(counts * np.arange(room + 1)).tolist()
    found: list[tuple[int, list[int]]] = []
    stack: list[tuple[int, int]] = []
    tried = 0

    def search(left: int, below: int) -> None:
        """Add lengths of sizes[:below] to the stack."""
        nonlocal tried
        if left <= waste and not counts[: left + 1].any() and not any(counts[x + 1: x + left + 1].any() for x, _ in stack):
            found.append((left, [x for x, k in stack for _ in range(k)]))
        for at in range(min(below, bisect_right(sizes, left)) - 1, -1, -1):
            size = sizes[at]
            if left - reach[size] > waste:
                return
            for k in range(min(int(counts[size]), left // size), 0, -1):
                tried += 1
                if tried > nodes:
                    return
                stack.append((size, k))
                counts[size] -= k
                search(left - k * size, at)
                counts[size] += k
                stack.pop()

    search(room, len(sizes))
    return [x for _, x in sorted(found, key=lambda f: f[0])]


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """A lower bound: no two pieces above half share a sequence, and pieces from k on find no room beside those above
    capacity - k."""
    n, total, half = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1)), capacity // 2
    k = np.arange(half + 1)
    alone, large = n[capacity] - n[capacity - k], n[capacity - k] - n[half]
    free = large * capacity - (total[capacity - k] - total[half])
    small = total[half] - np.where(k > 0, total[k - 1], 0)
    return int((alone + large + np.maximum(0, -((free - small) // capacity))).max())


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """The best-fit-decreasing plan; sequences that are filled alike are one line."""
    by_room: dict[int, list[tuple[list[int], int]]] = {}
    rooms: list[int] = []

    def put(lengths: list[int], times: int, room: int) -> None:
        if times:
            if room not in by_room:
                insort(rooms, room)
            by_room.setdefault(room, []).append((lengths, times))

    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            at = bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else capacity
            lengths, times = by_room[room].pop() if at < len(rooms) else ([], left)
            if at < len(rooms) and not by_room[room]:
                del by_room[room], rooms[at]
            k = room // size
            full = min(times, left // k)
            put(lengths + [size] * k, full, room - k * size)
            left -= full * k
            if times > full and lengths:
                rest = min(left, k - 1)
                put(lengths + [size] * rest, 1, room - rest * size)
                put(lengths, times - full - 1, room)
                left -= rest
            elif not lengths and left:
                put([size] * left, 1, room - left * size)
                left = 0
    return [line for lines in by_room.values() for line in lines]


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES,
                 states: int = PLAN_STATES) -> list[tuple[list[int], int]]:
    """Lines of the plan: lengths in a sequence, and how many sequences are filled so."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] += n
    sizes = np.arange(capacity + 1)
    best, bound = best_fit(counts, capacity), least_sequences(counts, capacity)
    most = sum(times for _, times in best)

    def choices(used: int) -> Iterator[tuple[list[int], int]]:
        first = int(np.flatnonzero(counts)[-1])
        counts[first] -= 1
        lead = best_filling(capacity - first, counts, nodes)
        counts[first] += 1
        yield [first, *lead], 0
        yield [first, *lead], 1
        counts[first] -= 1
        others = fillings(capacity - first, counts, (most - 1 - used) * capacity - int((counts * sizes).sum()) - first, nodes)
        counts[first] += 1
        for lengths in others:
            if lengths != lead:
                yield [first, *lengths], 0
                yield [first, *lengths], 1

    lines: list[tuple[list[int], int]] = []
    seen: dict[bytes, int] = {}
    used, tried, stack = 0, 0, [choices(0)] if most > bound else []
    fresh = True
    while stack and most > bound and tried < states:
        choice = next(stack[-1], None)
        tried, fresh = tried + (not fresh), False
        if choice is None:
            stack.pop()
        else:
            lengths, once = choice
            each = Counter(lengths)
            times = min(int(counts[x]) // k for x, k in each.items())
            if once and times == 1:
                continue
            times = 1 if once else times
            for x, k in each.items():
                counts[x] -= k * times
            lines.append((lengths, times))
            used += times
            state = hashlib.blake2b(counts.tobytes(), digest_size=16).digest()
            if not counts.any():
                if used < most:
                    best, most = lines.copy(), used
            elif used + least_sequences(counts, capacity) < most and seen.get(state, most) > used:
                seen[state] = used
                stack.append(choices(used))
                fresh = True
                continue
        if lines:
            lengths, times = lines.pop()
            for x, k in Counter(lengths).items():
                counts[x] += k * times
            used -= times
    return best


class Placement:
    """Where the r-th piece of a length goes."""

    def __init__(self, plan: list[tuple[list[int], int]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        base = 0
        for lengths, times in plan:
            offset = 0
            for x in dict.fromkeys(lengths):
                k = lengths.count(x)
                rows.setdefault(x, []).append((taken.get(x, 0), k, base, offset))
                taken[x] = taken.get(x, 0) + k * times
                offset += k * x
            base += times
        self.sequences = base
        self.rows = {x: np.array(v, dtype=np.int64) for x, v in rows.items()}

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        stops = np.flatnonzero(np.diff(lengths[order])) + 1
        for at in np.split(order, stops):
            if len(at):
                x = int(lengths[at[0]])
                table = self.rows[x]
                first, k, base, off = table[np.searchsorted(table[:, 0], ranks[at], side="right") - 1].T
                nth = ranks[at] - first
                sequence[at], offset[at] = base + nth // k, off + (nth % k) * x
        return sequence, offset


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int | None = END_ID,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with the task that made it and its place among the task's pieces of that length."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        made = np.zeros(capacity + 1, dtype=np.int64)
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                raw = enc.as_u4(enc.many([text or ""], end_id)[0])
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at: at + 4 * capacity]
                    n = len(own) // 4
                    out.append((doc_id, piece, at // 4, n, zlib.crc32(own), part, made[n]))
                    made[n] += 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]).astype(
                {"doc_id": "Int64"})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(cut, PIECES)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int | None = END_ID,
                   id_col: str = "doc_id", text_col: str = "text", nodes: int = SEARCH_NODES, states: int = PLAN_STATES) -> DataFrame:
    """Every piece with its sequence and its offset there. `nodes` and `states` bound the search (see `plan_packing`);
    without bounds it is exhaustive."""
    pieces = stored(cut_pieces(docs, capacity, tokenizer, end_id, id_col, text_col), "pieces")
    by_part = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    where = Placement(plan_packing(histogram, capacity, nodes, states))
    before = by_part.select("part", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    # `before` grows with the tasks: joined by sorting, not broadcast
    ranked = pieces.join(before.hint("merge"), ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sequence, offset = where.place(b["length"].to_numpy(np.int64), b["rank"].to_numpy(np.int64))
            yield b[["doc_id", "piece", "start", "length", "ids_crc32"]].astype({"doc_id": "Int64"}).assign(
                sequence_id=sequence, offset=offset)

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(put, PACKED)
