"""Token-id files with Elias-Fano document boundaries.

A file holds the ids of a run of documents one after the other (2 or 4 bytes each), and two
Elias-Fano sequences: where each document starts, and the documents' ids. A sequence of n values
below u takes about n * (2 + log2(u / n)) bits: the low bits of each value as they are, the high
bits in unary, and a 32-bit sample of every 128th one's place so that `get(i)` looks at a few bytes
only. No table of 64-bit offsets is kept.

Files are written by tasks into the shared folder under names of their own; the manifest, committed
by Spark as Parquet, names the files that count, so a task that runs twice leaves at most an
orphan. Documents are range-partitioned by id, so files and the documents in them are in ascending id order;
a file ends after FILE_IDS ids (a longer document still stays whole).

Null text is empty (its end id only). Null document ids come first. Repeated rows are kept, one entry
each. An empty table gives no files and no rows. Other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import shared_path, stored
from runlens.llm.encode import END_ID, TOKENIZER, encoder

FILE_IDS = 2_000_000
SAMPLE = 128
MAGIC = b"RLTOK1\x00\x00"
MANIFEST = "part int, seq int, file string, n_docs long, n_ids long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing sequence of values >= 0 with random access."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, "<u4"))
        top = int(values[-1])
        low_bits = max(0, (top // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1, dtype=np.uint8)
        bits[at] = 1
        return cls(n, low_bits, low.tobytes(), np.packbits(bits, bitorder="little").tobytes(), at[::SAMPLE].astype("<u4"))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits]
        return bits.reshape(self.n, self.low_bits)[i].astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))

    def get(self, i: int) -> int:
        """The i-th value: from the sample before it, count ones byte by byte."""
        at = int(self.samples[i // SAMPLE])
        left, place, byte = i % SAMPLE, at, self.high[at >> 3] & (0xFF << (at & 7)) & 0xFF
        while byte.bit_count() <= left:
            left -= byte.bit_count()
            place = (place | 7) + 1
            byte = self.high[place >> 3]
        for _ in range(left):
            byte &= byte - 1
        one = (place & ~7) + (byte & -byte).bit_length() - 1
        first = i * self.low_bits
        word = int.from_bytes(self.low[first >> 3: (first + self.low_bits + 7 >> 3)], "little") >> (first & 7)
        return (one - i << self.low_bits) | (word & ((1 << self.low_bits) - 1))

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        i = np.arange(self.n)
        return (((ones - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)).astype(np.int64)

    def to_bytes(self) -> bytes:
        return struct.pack("<QIQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low + self.high + self.samples.tobytes()

    @classmethod
    def read(cls, raw: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, a, b = struct.unpack_from("<QIQQ", raw, at)
        at += struct.calcsize("<QIQQ")
        samples = -(-n // SAMPLE)
        low, high = bytes(raw[at: at + a]), bytes(raw[at + a: at + a + b])
        at += a + b
        return cls(n, low_bits, low, high, np.frombuffer(raw, "<u4", samples, at)), at + 4 * samples


def pack_file(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """The bytes of a file: header, boundaries, document ids, then all ids. Null ids come first."""
    ends = np.cumsum([0] + [len(x) // width for x in ids])
    nulls = sum(x is None for x in doc_ids)
    known = np.array([x for x in doc_ids if x is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    names = EliasFano.build((known - least).astype(np.uint64) if len(known) else known)
    head = MAGIC + struct.pack("<IQq", width, nulls, least)
    return b"".join([head, EliasFano.build(ends).to_bytes(), names.to_bytes(), *ids])


class TokenFile:
    """A file read back; `ids(i)` are the ids of its i-th document."""

    def __init__(self, raw: bytes | memoryview):
        self.raw = memoryview(raw)
        if bytes(self.raw[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.width, self.nulls, self.least = struct.unpack_from("<IQq", self.raw, 8)
        self.bounds, at = EliasFano.read(self.raw, 8 + struct.calcsize("<IQq"))
        self.names, self.base = EliasFano.read(self.raw, at)

    def __len__(self) -> int:
        return self.bounds.n - 1

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.names.all() + self.least).tolist()

    def ids(self, i: int) -> np.ndarray:
        a, b = self.bounds.get(i), self.bounds.get(i + 1)
        return np.frombuffer(self.raw, f"<u{self.width}", b - a, self.base + a * self.width)


def _store(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_files(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int | None = END_ID, file_ids: int = FILE_IDS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and write the files; returns the stored manifest."""
    spark = docs.sparkSession
    folder = shared_path(spark, "token-files")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange(
        parts, "doc_id").sortWithinPartitions("doc_id")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        files, root = _store(folder)
        files.create_dir(root, recursive=True)
        names: list[int | None] = []
        ids: list[bytes] = []
        held, seq = 0, 0

        def close() -> pd.DataFrame:
            name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.tok"
            with files.open_output_stream(f"{root}/{name}") as f:
                f.write(pack_file(names, ids, enc.dtype.itemsize))
            return pd.DataFrame([(part, seq, name, len(names), held)], columns=["part", "seq", "file", "n_docs", "n_ids"])

        for batch in batches:
            doc_ids = batch["doc_id"].astype("Int64")
            for doc_id, text in zip(doc_ids, batch["text"]):
                found = enc.many([text or ""], end_id)[0]
                names.append(None if doc_id is pd.NA else int(doc_id))
                ids.append(found)
                held += len(found) // enc.dtype.itemsize
                if held >= file_ids:
                    yield close()
                    names, ids, held, seq = [], [], 0, seq + 1
        if names:
            yield close()

    return stored(dealt.mapInPandas(write, MANIFEST).withColumn("folder", F.lit(folder)), "token-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: its id, the ids before it in the whole array, the number of
    its ids, and their crc32 as 32-bit integers."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row per part
    inside = Window.partitionBy("part").orderBy("seq")
    files = manifest.join(before, "part").select(
        "folder", "file", (F.col("before") + F.sum("n_ids").over(inside) - F.col("n_ids")).alias("start"))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder, name, start in batch.itertuples(index=False):
                files, root = _store(folder)
                with files.open_input_stream(f"{root}/{name}") as f:
                    got = TokenFile(f.read())
                bounds = got.bounds.all()
                crc = [zlib.crc32(got.ids(i).astype("<u4").tobytes()) for i in range(len(got))]
                yield pd.DataFrame({"doc_id": pd.array(got.doc_ids(), dtype="Int64"), "start": start + bounds[:-1],
                                    "n_tokens": np.diff(bounds), "ids_crc32": crc})

    return files.repartition(n, "file").mapInPandas(read, DOCS)
