"""Exact dedup against a minimal perfect hash of historical digests.

The history is a set of distinct SHA-256 digests with a winner each (locator: id, length, copies).
It is cut into shards by digest; each shard is a minimal perfect hash (levels of bit arrays, a key
takes the first level in which it is alone at its place, the rank of its bit is its slot) whose
slots hold the full 32-byte digest and the locator. A lookup computes the slot and compares all 32
bytes, so a digest outside the history can never be taken for a member. Members merge with their
slot, the others are grouped by digest on their own.

Rows are aggregated by digest before any shuffle of members, so a text copied a billion times is one
row per task; the last join back to the rows is a plain equi-join that Spark splits when skewed.

Null text counts as empty. Of equal texts (after deleting white space) the longest original stays,
then the smallest id (a null id is last). Repeated rows with one id and one text are one document and share the mark.
An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import row_key, stored, text_of

KEYS_PER_SHARD = 2048      # distinct historical digests per shard: bounds the memory of one group
GAMMA = 1.6                # bits per key of each level
MAX_LEVELS = 40

INDEX_SCHEMA = "shard long, n int, sizes binary, bits binary, digests binary, ids binary, chars binary, copies binary"
FOUND_SCHEMA = "digest binary, keep_id long, chars long, group_size long, in_history boolean"
NO_ID = np.iinfo(np.int64).max     # stands for a null id while comparing: last of all


def _words(digests: np.ndarray) -> np.ndarray:
    return digests.view("<u8").reshape(len(digests), 4)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each key in a level: one of the digest's words, stirred with the level."""
    x = words[:, level % 4] ^ np.uint64((level * 0x9E3779B97F4A7C15 + 0x1234567) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Levels (sizes, bits one after the other) for distinct digests (n x 32 bytes). Keys that no
    level takes (practically none) have no slot and are answered as nonmembers by `slots`."""
    rest, sizes, parts = _words(digests), [], []
    for level in range(MAX_LEVELS):
        if not len(rest):
            break
        size = max(8, int(GAMMA * len(rest)))
        at = _places(rest, level, size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        parts.append(alone)
        rest = rest[~alone[at]]
    if len(rest):
        raise ValueError("digests are not distinct")
    return np.array(sizes, dtype=np.int64), np.concatenate(parts) if parts else np.zeros(0, bool)


def slots(sizes: np.ndarray, bits: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 where no level has its bit; a nonmember may get any slot."""
    words, rank = _words(digests), np.cumsum(bits) - 1
    out, todo, base = np.full(len(words), -1, dtype=np.int64), np.arange(len(words)), 0
    for level, size in enumerate(sizes.tolist()):
        at = base + _places(words[todo], level, size)
        hit = bits[at]
        out[todo[hit]] = rank[at[hit]]
        todo, base = todo[~hit], base + size
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), 32)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    keys = _matrix(group["digest"])
    sizes, bits = build_hash(keys)
    order = np.empty(len(keys), dtype=np.int64)
    order[slots(sizes, bits, keys)] = np.arange(len(keys))
    return pd.DataFrame([{
        "shard": group["shard"].iloc[0], "n": len(keys), "sizes": sizes.tobytes(), "bits": np.packbits(bits).tobytes(),
        "digests": keys[order].tobytes(), "ids": group["keep_id"].to_numpy(np.int64)[order].tobytes(),
        "chars": group["chars"].to_numpy(np.int64)[order].tobytes(),
        "copies": group["copies"].to_numpy(np.int64)[order].tobytes()}])


def _look_up(index: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    """All digests of a shard: slots merged with the members of the batch, then its nonmembers."""
    if len(index):
        row = index.iloc[0]
        sizes, n = np.frombuffer(row["sizes"], np.int64), int(row["n"])
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sizes.sum()].astype(bool)
        keys = np.frombuffer(row["digests"], np.uint8).reshape(n, 32)
        best, chars, copies = (np.frombuffer(row[c], np.int64).copy() for c in ("ids", "chars", "copies"))
    else:
        sizes, bits, keys = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros((0, 32), np.uint8)
        best, chars, copies = (np.zeros(0, np.int64) for _ in range(3))
    asked = _matrix(batch["digest"])
    at = slots(sizes, bits, asked)
    member = at >= 0
    member[member] = (keys[at[member]] == asked[member]).all(axis=1)      # byte check
    hit = at[member]
    got_id, got_chars, got_copies = (batch[c].to_numpy(np.int64) for c in ("keep_id", "chars", "copies"))
    copies[hit] += got_copies[member]
    wins = (got_chars[member] > chars[hit]) | ((got_chars[member] == chars[hit]) & (got_id[member] < best[hit]))
    best[hit[wins]], chars[hit[wins]] = got_id[member][wins], got_chars[member][wins]
    out = pd.DataFrame({
        "digest": [bytes(x) for x in keys] + list(batch["digest"][~member]),
        "keep_id": np.concatenate([best, got_id[~member]]), "chars": np.concatenate([chars, got_chars[~member]]),
        "group_size": np.concatenate([copies, got_copies[~member]]),
        "in_history": np.concatenate([np.ones(len(keys), bool), np.zeros((~member).sum(), bool)])})
    return out


def text_digest(text_col: str = "text") -> Column:
    """SHA-256 of the text without white space."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(text_col), r"[\x20\x09-\x0D]+", "").cast("binary"), 256))


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest of the text without white space, and code points of the original text."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_digest(text_col).alias("digest"),
                       F.char_length(text).cast("long").alias("chars"))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner and the number of rows."""
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.coalesce("doc_id", F.lit(NO_ID)).alias("i")))
    return rows.groupBy("digest").agg(best.alias("b"), F.count(F.lit(1)).alias("copies")).select(
        "digest", F.col("b.i").alias("keep_id"), (-F.col("b.c")).alias("chars"), "copies")


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def build_history(rows: DataFrame, shards: int) -> DataFrame:
    """The stored index: one row per shard."""
    return stored(_sharded(distinct_digests(rows), shards).groupBy("shard").applyInPandas(_build, INDEX_SCHEMA),
                  "digest-index")


def look_up(index: DataFrame, rows: DataFrame, shards: int) -> DataFrame:
    """One row per digest of history and batch together, with the winner over both."""
    asked = _sharded(distinct_digests(rows), shards)
    return index.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(_look_up, FOUND_SCHEMA)


def dedup(history: DataFrame, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Mark the rows of `history` and `batch` (each row of either comes back once)."""
    rows = stored(digest_rows(history, id_col, text_col).withColumn("old", F.lit(True)).unionByName(
        digest_rows(batch, id_col, text_col).withColumn("old", F.lit(False))), "digest-rows")
    return mark(rows)


def mark(rows: DataFrame) -> DataFrame:
    shards = max(1, -(-rows.count() // KEYS_PER_SHARD))
    index = build_history(rows.where("old"), shards)
    found = stored(look_up(index, rows.where("NOT old"), shards), "digest-winners").select(
        "digest", F.expr(f"nullif(keep_id, {NO_ID}L)").alias("keep_id"), "group_size", "in_history")
    return rows.join(found, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "in_history")


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Dedup one table: rows with an even crc32 of the id play the history, the others the new batch.
    The result does not depend on that split."""
    rows = digest_rows(docs, id_col, text_col)
    old = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return mark(stored(rows.withColumn("old", old), "digest-rows"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The winning row of each group, with the columns of `docs`; of repeated rows one stays."""
    kept = dedup_documents(docs, id_col, text_col).where("kept").select(
        row_key("doc_id").alias("_dedup_id"), F.unhex("text_sha256").alias("_dedup_text")).distinct()
    keyed = docs.withColumn("_dedup_id", row_key(id_col)).withColumn("_dedup_text", text_digest(text_col))
    same = Window.partitionBy("_dedup_id", "_dedup_text").orderBy(F.lit(1))
    return keyed.join(stored(kept, "digest-kept"), ["_dedup_id", "_dedup_text"], "left_semi").withColumn(
        "_dedup_n", F.row_number().over(same)).where("_dedup_n = 1").drop("_dedup_id", "_dedup_text", "_dedup_n")
