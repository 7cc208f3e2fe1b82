"""Merkle dataset manifest: every row a leaf, one tree of threes per source, one tree of threes over the sources.

Levels are computed with lag and lead windows. Rows carry the digest of their node of the current level; on the first row
of a node, lag and lead at a fixed offset (3^level rows, twice that) are the neighbouring nodes, masked by the node's slot
in its run of three and by the number of nodes of the level. First-child rows hash the parent, and a running last value
hands it to the rows below. All windows of `LEVELS` levels share one partition (group, block of 3^LEVELS places) and one
order, so these levels cost one shuffle of digests however large a source is; the tops of the blocks are the next table,
3^LEVELS times smaller, and its paths are joined back by (group, block).

Places inside a source come from a range partition with row numbers per part and offsets per (source, part), so that no
source is sorted in one task. The text of a row is read once; all later steps carry digests.

Definitions: H is the lower-case hex sha256 of the concatenated inputs (digests as hex text). A leaf is H of doc_id,
source, lang, n_chars and text, each "-" if null, else UTF-8 byte count, ":" and the value. While a level has more than
one node, every three consecutive nodes (the last run may be shorter) become their H.

Cases: null ids come first in their source, null sources are a source of their own and come first; rows that agree in
source and id are ordered by leaf, and equal rows are leaves of their own. Null text is hashed as null, an empty one as
"0:"; a null id is never tampered with. Only the five named columns are read, so other columns cannot clash. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import stored

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
ARITY = 3
LEVELS = 7                   # levels of a block: windows hold 3^7 = 2,187 digests at most
STEP = "struct<left:string,right:string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(columns: dict[str, Column]) -> Column:
    return digest(*[field(columns[name]) for name in FIELDS])


def source_key(c: Column) -> Column:
    """A never-null text that sorts as the source does: null first, then by UTF-8 bytes."""
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, group, leaf, and the leaf of the tampered row where that differs (its newlines deleted, see `tampers`)."""
    own = {name: F.col(name) for name in FIELDS}
    changed = own | {"text": F.translate("text", "\n", "")}
    return docs.select(*FIELDS).select(
        "doc_id", source_key(F.col("source")).alias("group"), leaf_of(own).alias("digest"),
        F.when(tampers(F.col("doc_id")) & F.contains("text", F.lit("\n")), leaf_of(changed)).alias("tampered"))


def tampers(doc_id: Column) -> Column:
    """Rows whose copy is tampered with: crc32 of the decimal id is even."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0


def places(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with pos (0, 1, ... within `group`, by `order`) and n (rows of the group), stored."""
    parted = stored(rows.repartitionByRange("group", *order).withColumn("_part", F.spark_partition_id()), "manifest-parts")
    ahead = Window.partitionBy("group").orderBy("_part")                  # one row for each part that a group reaches into
    sizes = parted.groupBy("group", "_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "group", "_part", F.coalesce(F.sum("_rows").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy("group")).alias("n"))
    inside = F.row_number().over(Window.partitionBy("group", "_part").orderBy(*order))
    numbered = parted.withColumn("_inside", inside).join(sizes.hint("merge"), ["group", "_part"])
    return stored(numbered.withColumn("pos", F.col("_before") + F.col("_inside") - 1).drop("_part", "_inside", "_before"),
                  "manifest-places")


def _div(c: Column, by: int) -> Column:
    return F.floor(c / by) if by > 1 else c


def block_levels(nodes: DataFrame, with_path: bool) -> DataFrame:
    """The next LEVELS levels above `nodes` (group, pos, n, digest, ...), per block of 3^LEVELS places.

    Adds `block` and `top` (the digest at the end of the levels, on every row), and `path`: for each level that the
    group has, what stands left and right of the row's node in its run."""
    width = ARITY ** LEVELS
    rows = nodes.withColumn("block", _div(F.col("pos"), width)).withColumn("top", F.col("digest"))
    if with_path:
        rows = rows.withColumn("path", F.array().cast(f"array<{STEP}>"))
    w = Window.partitionBy("group", "block").orderBy("pos")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    none = F.lit("")
    for level in range(LEVELS):
        s = ARITY ** level
        node, count = _div(F.col("pos"), s), F.ceil(F.col("n") / s)
        slot, first, more = node % ARITY, F.col("pos") % s == 0, count > 1
        rows = rows.select(
            "*", *[F.lag("top", k * s).over(w).alias(f"_lag{k}") for k in (1, 2)],
            *[F.lead("top", k * s).over(w).alias(f"_lead{k}") for k in (1, 2)])
        right = F.concat(F.when((slot < 2) & (node + 1 < count), F.col("_lead1")).otherwise(none),
                         F.when((slot == 0) & (node + 2 < count), F.col("_lead2")).otherwise(none))
        left = F.concat(F.when(slot == 2, F.col("_lag2")).otherwise(none), F.when(slot > 0, F.col("_lag1")).otherwise(none))
        parent = F.when(more, digest(F.col("top"), right)).otherwise(F.col("top"))
        rows = rows.withColumn("_up", F.when(first & (slot == 0), parent))
        if with_path:
            rows = rows.withColumn("_at", F.when(first, F.struct(left.alias("left"), right.alias("right"))))
        spread = {"top": F.last("_up", ignorenulls=True).over(so_far)}
        if with_path:
            spread["_step"] = F.last("_at", ignorenulls=True).over(so_far)
        rows = rows.withColumns(spread).drop("_lag1", "_lag2", "_lead1", "_lead2", "_up")
        if with_path:
            rows = rows.withColumn("path", F.when(more, F.array_append("path", F.col("_step"))).otherwise(F.col("path")))
            rows = rows.drop("_step", "_at")
    return rows


def climb(nodes: DataFrame, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """`nodes` (stored: group, pos, n, digest, ...) with `path` up to the root of the group, and `root`.

    `finish` continues above the groups: it gets their roots (group, digest), one row each, and returns group with the
    path from there, the root and maybe further columns."""
    largest = nodes.agg(F.max("n")).first()[0]
    if largest is None or largest <= 1:
        if finish:
            return nodes.join(finish(nodes.select("group", "digest")).hint("merge"), "group")
        return nodes.withColumn("path", F.array().cast(f"array<{STEP}>")).withColumn("root", F.col("digest"))
    width = ARITY ** LEVELS
    tops = stored(block_levels(nodes, False).where(F.col("pos") % width == 0).select(
        "group", F.col("block").alias("pos"), F.ceil(F.col("n") / width).alias("n"), F.col("top").alias("digest")), "manifest-tops")
    above = climb(tops, finish).withColumnsRenamed({"pos": "block", "path": "_above"}).drop("n", "digest")
    # the windows have dealt the rows by (group, block) already, so this join moves the small side only
    joined = block_levels(nodes, True).drop("top").join(above.hint("merge"), ["group", "block"])
    return joined.withColumn("path", F.concat("path", "_above")).drop("_above", "block")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda d, step: digest(step["left"], d, step["right"]))


def proof(path: Column) -> Column:
    """The siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, tampered, subroot, root and path."""
    def over_sources(roots: DataFrame) -> DataFrame:
        named = roots.select(F.lit("all").alias("group"), F.col("group").alias("name"), "digest")
        return climb(places(named, ["name"])).select(F.col("name").alias("group"), "path", F.col("digest").alias("subroot"), "root")

    rows = places(stored(leaves(docs), "manifest-leaves"), ["doc_id", "digest"])
    return climb(rows, over_sources).select("doc_id", F.col("digest").alias("leaf"), "tampered", "subroot", "root", "path")


def verify(docs: DataFrame) -> DataFrame:
    """Per row: its leaf, subroot, the root, the hash of its proof, and the root that the (maybe tampered) leaf folds to."""
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return manifest(docs).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
