"""Prefix-tree join on the Jaccard similarity of five-word shingle sets.

Two documents link when 100 * |intersection| >= 75 * |union|. The join is exact and its work follows the
number of texts and of differing near copies, not the pairs inside a group:

1. One pass makes each document's set digest, a parity sketch, and document counts of shingles in
   2^17 hash places. Documents with one and the same set become one class, known by 64 bits of the digest; from here on
   classes are joined, so copies cost nothing however many there are, and rows that share an id stay apart.
2. Shingles get one global order: place count, then hash, so passages shared by many documents come
   last. Two sets that reach the similarity share a shingle among the first n - ceil(3n/4) + 1 of each (prefix
   filter), so only shingles in the prefixes of two classes or more matter (their least and largest class differ); the
   others fall away.
3. Classes that may be similar are found by their parity sketches (the number of differing bits never exceeds the
   symmetric difference): first at a home shingle of each (two choices, chunks of bounded size), which connects
   nearly all members of large groups at little cost, then at every shingle whose classes are not all connected yet. A task
   returns which classes it connects, never the pairs, so the output is linear in its input.
4. The connected groups are a partition of the classes, and every similar pair lies inside one. Sets are made again for
   their members only and joined inside each group with prefix trees. A group of more than one block is joined block by
   block, each together with a few pivots of the group, which connects what is alike at linear cost; then only the
   members outside the group's largest component meet all others. Nothing is dropped, so no link is missed.

The prefix tree holds the sets of a chunk in global order with shared beginnings stored once. A probe walks it,
carries the overlap so far, and leaves a subtree when the overlap plus what can still follow is below the need,
or when all its members are in the probe's component already.

Blocks and bins are bounded by rows and by bytes. Shingles and classes are compared by 64-bit hashes. Null, empty and
white-space texts have an empty set and link with nothing. Repeated rows are copies. Rows with a null id are documents like
others; a component is named by its smallest id, null where it has none. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import slices, stored, text_of
from runlens.llm.components import Forest, components
from runlens.llm.shingles import shingle_sets

PLACE_BITS = 17           # places of the global order
CHUNK = 256               # documents of a block that meet in one prefix tree
UNIT = 2048               # documents of a block whose sketches are compared together
BIN_ROWS = 1024           # sets held by one group of rows
BLOCK_BYTES, BIN_BYTES = 8 << 20, 32 << 20
PIVOTS = 16               # members of a large group that meet every block of it
SEEN_SETS = 200_000       # digests a task remembers, to name equal sets once
SCAN_SCHEMA = "doc_id long, text_key string, n int, cls long, sketch binary, place int, docs long"


def needed(a: int, b: int) -> int:
    """Smallest intersection with 100 * i >= 75 * (a + b - i)."""
    return -(-3 * (a + b) // 7)


def prefix_length(n: int) -> int:
    return n - -(-3 * n // 4) + 1


def parity_sketch(s: np.ndarray) -> bytes:
    """Parities of the set's members by the low bits of their hashes, in a power of two of bits, at least twice the set."""
    bits = max(64, 1 << (2 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference: differing bits, after folding the longer sketch."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


# ── the prefix tree ────────────────────────────────────────────────────────────────────────────

class _Node:
    __slots__ = ("part", "depth", "kids", "ends", "least", "most", "members")

    def __init__(self, part: np.ndarray, depth: int):
        self.part, self.depth = part, depth        # shingles on the edge, shingles on the path with it
        self.kids: dict[int, _Node] = {}
        self.ends: list[int] = []                  # members that end here
        self.least, self.most, self.members = 1 << 62, 0, 0


class PrefixTree:
    """Sets in global order with shared beginnings, probed for similar sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.top = _Node(np.zeros(0, np.uint64), 0)

    def _count(self, node: _Node, n: int) -> None:
        node.least, node.most, node.members = min(node.least, n), max(node.most, n), node.members + 1

    def add(self, member: int) -> None:
        s, at, node = self.sets[member], 0, self.top
        self._count(node, len(s))
        while at < len(s):
            kid = node.kids.get(int(s[at]))
            if kid is None:
                kid = _Node(s[at:], len(s))
                node.kids[int(s[at])] = kid
                self._count(kid, len(s))
                kid.ends.append(member)
                return
            rest = s[at: at + len(kid.part)]
            same = kid.part[: len(rest)] == rest
            k = len(rest) if same.all() else int(np.argmin(same))
            if k < len(kid.part):                  # split the edge
                upper = _Node(kid.part[:k], kid.depth - len(kid.part) + k)
                upper.least, upper.most, upper.members = kid.least, kid.most, kid.members
                upper.kids[int(kid.part[k])] = kid
                kid.part = kid.part[k:]
                node.kids[int(s[at])] = upper
                kid = upper
            self._count(kid, len(s))
            at, node = at + k, kid
        node.ends.append(member)

    def similar(self, x: np.ndarray, skip) -> Iterator[int]:
        """Members whose similarity with x is enough; `skip(members)` prunes where nothing new can come."""
        n = len(x)
        walk = [(self.top, 0, 0)]
        while walk:
            node, overlap, seen = walk.pop()       # seen: members of x up to the last shingle of the path
            for member in node.ends:
                if overlap >= needed(n, node.depth) and not skip(member):
                    yield member
            for kid in node.kids.values():
                need = needed(n, max(kid.least, -(-3 * n // 4)))
                if kid.least * 3 > n * 4 or kid.most * 4 < n * 3:
                    continue                       # length
                got, at, part = overlap, seen, kid.part
                above = kid.depth - len(part)
                for k in range(0, len(part), 64):
                    piece = part[k: k + 64]
                    place = np.searchsorted(x, piece)
                    got += int((x[np.minimum(place, n - 1)] == piece).sum())
                    at = int(place[-1])
                    if got + min(n - at, kid.most - above - k - len(piece) + 1) < need:
                        break                      # remaining length
                else:
                    walk.append((kid, got, at))


def class_of(s: np.ndarray) -> int | None:
    """64 bits of the set's digest; null for the empty set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None


def join_sets(ids: list[int], sets: list[np.ndarray], forest: Forest) -> None:
    """Link all similar pairs that `forest` does not already connect."""
    tree = PrefixTree(sets)
    for i in sorted(range(len(ids)), key=lambda k: len(sets[k])):
        for j in tree.similar(sets[i], lambda m, a=ids[i]: forest.root(ids[m]) == forest.root(a)):
            forest.join(ids[i], ids[j])
        tree.add(i)


# ── Spark ──────────────────────────────────────────────────────────────────────────────────────

def text_key(text_col: str = "text") -> Column:
    return F.md5(text_of(text_col).cast("binary"))


def scan(docs: DataFrame) -> DataFrame:
    """Class, size and sketch of each document, and (with a null n) the task's document counts of shingles by place."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << PLACE_BITS, dtype=np.int64)
        for batch in slices(batches):
            sets = shingle_sets(batch["text"].tolist())
            places = (np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
            counts += np.bincount(places, minlength=len(counts))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "text_key": pd.Series(batch["text_key"].tolist(), index=batch.index, dtype=object), "n": pd.array([len(s) for s in sets], dtype="Int32"),
                "cls": pd.array([class_of(s) for s in sets], dtype="Int64"),
                "sketch": [parity_sketch(s) if len(s) else None for s in sets], "place": pd.array([None] * len(sets), dtype="Int32"),
                "docs": pd.array([None] * len(sets), dtype="Int64")})
        at = np.flatnonzero(counts)
        empty = [None] * len(at)
        yield pd.DataFrame({"doc_id": pd.array(empty, dtype="Int64"), "text_key": pd.Series(empty, dtype=object), "n": pd.array(empty, dtype="Int32"), "cls": pd.array(empty, dtype="Int64"),
                            "sketch": empty, "place": pd.array(at, dtype="Int32"), "docs": pd.array(counts[at], dtype="Int64")})

    return docs.withColumn("text_key", text_key()).mapInPandas(run, SCAN_SCHEMA)


def prefix_entries(docs: DataFrame, order: np.ndarray) -> DataFrame:
    """(shingle, cls, n) for the prefix of each set; equal sets of one task once."""
    shared = docs.sparkSession.sparkContext.broadcast(order)       # 2^PLACE_BITS counts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, seen = shared.value, set()
        for batch in slices(batches):
            shingle, own, size = [], [], []
            for s in shingle_sets(batch["text"].tolist()):
                cls = class_of(s)
                if cls is None or cls in seen:
                    continue
                if len(seen) > SEEN_SETS:
                    seen.clear()
                seen.add(cls)
                k = prefix_length(len(s))
                rank = counts[(s >> np.uint64(64 - PLACE_BITS)).astype(np.int64)]
                first = np.argsort(rank, kind="stable")[:k]        # s is sorted by hash: ties in hash order
                shingle.append(s[first])
                own.append(cls)
                size.append((len(s), k))
            if shingle:
                times = [k for _, k in size]
                yield pd.DataFrame({"shingle": np.concatenate(shingle).view(np.int64), "cls": np.repeat(np.array(own, dtype=np.int64), times),
                                    "n": np.repeat(np.array([n for n, _ in size], dtype=np.int32), times)})

    return docs.select("text").mapInPandas(run, "shingle long, cls long, n int")


def shared_entries(entries: DataFrame) -> DataFrame:
    """The entries of shingles that two classes or more have, each (shingle, class) once. All of it needs one exchange by
    shingle; the rows of a common shingle pass one task, which spills them beyond a few thousand."""
    same = Window.partitionBy("shingle")
    spread = entries.select("*", F.min("cls").over(same).alias("least"), F.max("cls").over(same).alias("most"))
    return spread.where("least <> most").select("shingle", "cls", "n").dropDuplicates(["shingle", "cls"])


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, items) of the documents with the wanted ids (null is one too); a superset of the wanted classes where rows share
    an id. Spark broadcasts the ids where the stored table is small enough."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in slices(batches):
            sets = {class_of(s): s for s in shingle_sets(batch["text"].tolist()) if len(s)}
            new = [c for c in sets if c not in seen]
            if len(seen) > SEEN_SETS:
                seen.clear()
            seen.update(new)
            yield pd.DataFrame({"cls": np.array(new, dtype=np.int64), "items": [sets[c].tobytes() for c in new]})

    ids = wanted.select(F.col("rep").alias("_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi").select("text").mapInPandas(run, "cls long, items binary")


def _bins(rows: DataFrame, bytes_a_shingle: float) -> int:
    """Bins of bounded rows and bytes."""
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("shingles")).first()
    return max(1, -(-total["rows"] // BIN_ROWS), int(total["shingles"] * bytes_a_shingle) // BIN_BYTES + 1)


def join_chunks(chunks: DataFrame, sets: DataFrame) -> DataFrame:
    """(chunk, cls, label, n) -> links (a, b) inside each chunk, as a spanning forest of what was found; members of one label
    are connected already."""
    bins = _bins(chunks, 8)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = Forest()
        for _, own in group.groupby("chunk", sort=False):
            own = own.drop_duplicates("cls")
            if own["label"].nunique() > 1:
                forest = Forest()
                for cls, label in zip(own["cls"].tolist(), own["label"].tolist()):
                    if cls != label:
                        forest.join(cls, label)
                join_sets(own["cls"].tolist(), [np.frombuffer(x, np.uint64) for x in own["items"]], forest)
                for a, b in zip(*forest.stars()):
                    found.join(a, b)
        a, b = found.stars()
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return chunks.drop("n").join(sets, "cls").withColumn("bin", F.pmod(F.xxhash64("chunk"), F.lit(bins))).groupBy("bin").applyInPandas(
        run, "a long, b long")


def _blocks(groups: DataFrame, key: str, size: int, bytes_a_shingle: float) -> DataFrame:
    """(key, _n, _blocks): rows of each key and blocks of bounded rows and bytes."""
    return groups.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum("n").alias("_s")).where("_n > 1").select(key, "_n", F.greatest(
        F.ceil(F.col("_n") / F.lit(size)), F.ceil(F.col("_s") * F.lit(bytes_a_shingle) / F.lit(BLOCK_BYTES))).alias("_blocks"))


def join_groups(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(cls, close, n) -> all links (a, b) inside the groups, as spanning forests."""
    sized = stored(groups.join(_blocks(groups, "close", CHUNK, 8), "close").withColumn(
        "_own", F.pmod(F.xxhash64("cls"), F.col("_blocks"))), "group-blocks")
    # each block, and in a group of several blocks its pivots with it
    nth = F.row_number().over(Window.partitionBy("close").orderBy(F.xxhash64("cls", F.lit(1)), "cls"))
    pivots = sized.where("_blocks > 1").withColumn("_nth", nth).where(F.col("_nth") <= PIVOTS).withColumn(
        "_own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    columns = [F.xxhash64("close", "_own").alias("chunk"), "cls", F.col("cls").alias("label"), "n"]
    first = stored(sized.select(columns).unionByName(pivots.select(columns)).distinct(), "chunks-1")
    links = stored(join_chunks(first, sets), "links-1")
    large = sized.where("_blocks > 1")
    if large.isEmpty():
        return links
    # the members outside a group's largest component meet all others, unless they carry one label
    labelled = stored(large.join(components(links).withColumnRenamed("node", "cls"), "cls", "left").select(
        "close", "cls", "n", "_blocks", "_own", F.coalesce("component", "cls").alias("label")), "group-labels")
    parts = labelled.groupBy("close", "label").agg(F.count(F.lit(1)).alias("size"))
    main = parts.groupBy("close").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    open_rows = stored(labelled.join(main.drop("parts"), "close"), "group-open")
    rest = open_rows.where("label <> main")
    rest_blocks = rest.groupBy("close").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)), F.ceil(F.sum("n") * 8 / F.lit(BLOCK_BYTES))).alias("_rest"))
    both = open_rows.join(rest_blocks, "close")
    every = F.sequence(F.lit(0).cast("long"), F.col("_rest") - 1)
    mine = both.where("label <> main").withColumn("_r", F.pmod(F.xxhash64("cls", F.lit(2)), F.col("_rest"))).withColumn(
        "_own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    columns = [F.xxhash64("close", "_own", "_r").alias("chunk"), "cls", "label", "n"]
    second = stored(both.withColumn("_r", F.explode(every)).select(columns).unionByName(mine.select(columns)).distinct(), "chunks-2")
    return links.unionByName(stored(join_chunks(second, sets), "links-2"))


def _home_chunks(shared: DataFrame) -> DataFrame:
    """Two home shingles for each class (smallest by two hash orders), cut into chunks of bounded size."""
    homes = shared.groupBy("cls").agg(F.first("n").alias("n"), *[F.min_by("shingle", F.xxhash64("shingle", F.lit(k))).alias(f"h{k}") for k in (1, 2)])
    homes = stored(homes.select("cls", "n", F.explode(F.array_distinct(F.array("h1", "h2"))).alias("home")), "homes")
    sizes = stored(_blocks(homes, "home", CHUNK, 0.5), "home-sizes")
    return homes.join(sizes, "home").select("cls", "n", F.xxhash64("home", F.pmod(F.xxhash64("cls", "home"), F.col("_blocks"))).alias("unit"))


def close_members(sizes: np.ndarray, sketches: list[bytes], labels: np.ndarray) -> np.ndarray:
    """Labels after joining all members whose lengths and sketches allow the similarity; members that carry
    one label already are not compared."""
    labels, by_length = labels.copy(), {}
    for k, x in enumerate(sketches):
        by_length.setdefault(len(x), []).append(k)
    for length, own in by_length.items():
        rows, at = [np.frombuffer(sketches[k], np.uint64) for k in own], list(own)
        for k in by_length.get(2 * length, []):          # similar sets have sketches of one or two lengths
            rows.append(np.bitwise_xor(*np.frombuffer(sketches[k], np.uint64).reshape(2, -1)))
            at.append(k)
        table, place = np.stack(rows), np.array(at)
        for i, k in enumerate(own):
            other = np.flatnonzero(labels[place[i + 1:]] != labels[k]) + i + 1
            m, n = int(sizes[k]), sizes[place[other]]
            other = other[(4 * n >= 3 * m) & (3 * n <= 4 * m)]
            if not len(other):
                continue
            n = sizes[place[other]]
            differ = np.bitwise_count(table[other] ^ table[i]).sum(axis=1, dtype=np.int64)
            fine = place[other[differ <= m + n - 2 * -(-3 * (m + n) // 7)]]
            if len(fine):
                labels[np.isin(labels, labels[fine])] = labels[k]
    return labels


def close_edges(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """(unit, cls, group, n) -> edges (a, b) between the groups that a unit's sketches connect."""
    bins = _bins(units, 0.5)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        forest = Forest()
        for _, own in group.groupby("unit", sort=False):
            before = own["group"].to_numpy()
            if len(own) > 1 and before.min() != before.max():
                after = close_members(own["n"].to_numpy(), own["sketch"].tolist(), before)
                for a, b in set(zip(before.tolist(), after.tolist())):
                    forest.join(a, b)
        a, b = forest.stars()
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return units.join(nodes.select("cls", "sketch"), "cls").withColumn(
        "bin", F.pmod(F.xxhash64("unit"), F.lit(bins))).groupBy("bin").applyInPandas(run, "a long, b long")


def _block_units(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows of a key in units: one for a key of up to `size` rows, else one for each pair of its blocks, so that
    every two rows of a key meet and a unit stays bounded."""
    counts = stored(_blocks(rows, key, size, 0.5), "unit-blocks")
    placed = rows.join(counts, key).withColumn("_own", F.pmod(F.xxhash64("cls"), F.col("_blocks"))).withColumn(
        "_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    return placed.select(F.xxhash64(key, F.least("_own", "_other"), F.greatest("_own", "_other")).alias("unit"), "cls", "group", "n")


def _open_rows(shared: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of shared prefix shingles that may still connect two groups.

    Two similar sets have at least needed(m, n) - max(ceil(3m/4), ceil(3n/4)) + 1 common shingles in both prefixes, because what is
    not common there must lie behind the prefix that ends first. So a row stays only if its shingle has a class
    of another group, of a length that fits, and if both have that many shared prefix shingles."""
    held = shared.groupBy("cls").agg(F.count(F.lit(1)).alias("held"))
    info = stored(held.join(known.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "held", F.coalesce("component", "cls").alias("group")), "shared-classes")
    placed = stored(shared.join(info, "cls"), "placed")
    mixed = stored(placed.groupBy("shingle").agg(F.min("group").alias("x"), F.max("group").alias("y")).where(
        "x <> y").select("shingle"), "mixed")
    rows = stored(placed.join(mixed, "shingle"), "open")
    one, two = rows.alias("one"), rows.select("shingle", "group", "n", "held").alias("two")
    m, n = F.col("one.n"), F.col("two.n")
    common = F.ceil(3 * (m + n) / 7) - F.ceil(F.greatest(m, n) * 0.75) + 1
    return stored(one.join(two, (F.col("one.shingle") == F.col("two.shingle")) & (F.col("one.group") != F.col("two.group"))
                           & (m * 4 >= n * 3) & (n * 4 >= m * 3) & (common <= F.least("one.held", "two.held")), "left_semi"), "open-rows")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return labelled_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).select(
        "doc_id", "n_shingles", "component_id")


def labelled_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, label (null for empty sets), n_shingles, component_id of every row of (doc_id, text)."""
    scanned = stored(scan(docs), "scan")
    order = np.zeros(1 << PLACE_BITS, dtype=np.int64)
    for r in scanned.where("n IS NULL").groupBy("place").agg(F.sum("docs").alias("docs")).collect():    # 2^PLACE_BITS at most
        order[r["place"]] = r["docs"]

    members = scanned.where("n IS NOT NULL").select("doc_id", "text_key", "n", "cls")
    classes = stored(members.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep")), "classes")

    shared = stored(shared_entries(prefix_entries(docs, order)), "shared")
    nodes = scanned.where("n > 0").join(shared.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(
        F.max(F.struct("n", "sketch")).alias("s"))
    nodes = stored(nodes.select("cls", "s.n", "s.sketch"), "nodes")

    homes = stored(_home_chunks(shared).withColumn("group", F.col("cls")), "home-units")
    near = stored(close_edges(homes, nodes), "close-1")
    open_rows = _open_rows(shared, stored(components(near), "close-components"))
    units = stored(_block_units(open_rows, "shingle", UNIT), "open-units")
    near = near.unionByName(stored(close_edges(units, nodes), "close-2"))

    groups = stored(components(near).join(nodes.select(F.col("cls").alias("node"), "n"), "node").select(
        F.col("node").alias("cls"), F.col("component").alias("close"), "n"), "close-groups")
    wanted = stored(groups.join(classes, "cls").select("rep").distinct(), "wanted")
    sets = stored(class_sets(docs, wanted), "sets")
    found = stored(components(join_groups(groups, sets)), "components")

    labelled = stored(classes.join(found, F.col("cls") == F.col("node"), "left").select(
        "cls", "rep", F.coalesce("component", "cls").alias("label")), "labelled")
    names = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = stored(labelled.join(names, "label").select("cls", "label", "component_id"), "named")
    return members.join(named, "cls", "left").select(
        "doc_id", "text_key", "label", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with the columns of `docs`: that of the smallest id (null last), then the smallest MD5 of
    its text. Rows without words all stay."""
    rows = stored(labelled_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))), "labelled-rows")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    kept = rows.where("label IS NOT NULL").groupBy("label").agg(F.min(first).alias("k")).select("k.doc_id", "k.text_key")
    empty = rows.where("label IS NULL").select("doc_id", "text_key", F.lit(False).alias("_repeated")).distinct()
    counts = rows.where("label IS NOT NULL").groupBy("doc_id", "text_key").agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    named = lambda df: df.withColumnsRenamed({"doc_id": "_keep_id", "text_key": "_keep_key"})
    keys = named(kept).join(counts, F.col("_keep_id").eqNullSafe(F.col("doc_id")) & (F.col("_keep_key") == F.col("text_key"))).select(
        "_keep_id", "_keep_key", "_repeated").unionByName(named(empty))
    keys = stored(keys, "near-kept")
    own = docs.withColumn("_own_key", text_key(text_col))
    found = own.join(keys, F.col(id_col).cast("long").eqNullSafe(F.col("_keep_id")) & (F.col("_own_key") == F.col("_keep_key")))
    once = found.where(~F.col("_repeated")).unionByName(found.where("_repeated").dropDuplicates(["_keep_id", "_keep_key"]))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
