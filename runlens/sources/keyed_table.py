"""A Parquet table that is added to, replaced and read by key.

Rows live in hash buckets, `data/bucket=B/version=V/`. A write adds one version; a version counts once the manifest names
it. The manifest is one small file per commit (at most buckets x (versions + 1) entries), put in place by a rename, so
readers see a write as a whole or not at all and a failed write leaves only files that nobody reads (`vacuum` removes
them). One job writes at a time; any number read.

- `put` replaces: the rows of a group (the table's `group` columns) are those of the last version that wrote it.
- `add_new`, of a table made with adds=True, adds rows whose key (the group) is not stored yet and never replaces any.
- A bucket holds at most `versions` versions; beyond that its rows are merged into one, and only buckets that the write
  has touched are rewritten. Where a `put` replaces every group of a bucket nothing is rewritten: its version takes the
  place of the others. With versions=1 every `put` is one or the other.
- `read` lists the live folders of the wanted buckets only, so a reader that knows its keys reads their buckets, by
  partition filter, and the number of files does not grow with the number of writes.
- Files carry Parquet Bloom filters for the columns in `bloom`; `lookup` pushes a few keys down to them.

Writes take the micro-batch number of a stream; a batch that is committed already is not applied again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP_MANIFESTS = 10


@dataclass
class State:
    """A committed manifest: the live versions of each bucket, oldest first, and the last stream batch with its version."""
    number: int = 0
    live: dict[int, list[str]] = field(default_factory=dict)
    batch: int | None = None
    version: str | None = None


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, group: list[str], buckets: int = 64,
                 versions: int = 8, bucket_by: list[str] | None = None, spread: int = 2, bloom: list[str] | None = None, adds: bool = False):
        """`bucket_by` (default: the group) decides a row's bucket; `spread` is the number of pieces that a bucket is
        dealt to at least; pieces beyond Spark's advisory partition size are split, so that a write has as many tasks as
        its data needs, however few buckets there are."""
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.group, self.bucket_by, self.bloom = group, bucket_by or group, bloom or []
        self.buckets, self.versions, self.spread, self.adds = buckets, versions, spread, adds
        self.columns = [f.name for f in self.schema.fields]
        self._layout = {"group": self.group, "bucket_by": self.bucket_by, "buckets": buckets, "columns": self.columns, "adds": adds}
        self._stored = T.StructType([*self.schema.fields, T.StructField("_gone", T.BooleanType()),
                                     T.StructField("bucket", T.IntegerType()), T.StructField("version", T.StringType())])

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        """An existing table, as its manifest describes it."""
        names = (bare := cls(spark, path, "_ string", [], bucket_by=["_"]))._manifests()
        if not names:
            raise FileNotFoundError(f"no table at {path}")
        got = bare._json(names[-1])
        layout = got["layout"]
        return cls(spark, path, T.StructType.fromJson(got["schema"]), layout["group"], layout["buckets"], bucket_by=layout["bucket_by"],
                   adds=layout["adds"])

    # ── the manifest ──────────────────────────────────────────────────────────────────────────

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _files(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self) -> list[str]:
        files, folder = self._files(), self._at("manifest")
        if not files.exists(folder):
            return []
        return sorted(n for n in (s.getPath().getName() for s in files.listStatus(folder)) if n.endswith(".json"))

    def _json(self, name: str) -> dict:
        stream = self._files().open(self._at("manifest", name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _load(self, name: str) -> State:
        got = self._json(name)
        if got["layout"] != self._layout:
            raise ValueError(f"the table at {self.path} has another layout: {got['layout']}")
        return State(int(name.split(".")[0]), {int(b): v for b, v in got["live"].items()}, got["batch"], got["version"])

    def state(self) -> State:
        names = self._manifests()
        return self._load(names[-1]) if names else State()

    def _commit(self, state: State) -> None:
        files = self._files()
        temporary = self._at("manifest", f"_{uuid.uuid4().hex}")
        out = files.create(temporary, True)
        out.write(json.dumps({"layout": self._layout, "schema": json.loads(self.schema.json()), "live": state.live,
                              "batch": state.batch, "version": state.version}).encode())
        out.close()
        if not files.rename(temporary, self._at("manifest", f"{state.number:012d}.json")):
            raise RuntimeError(f"another job has written to {self.path}")
        for name in self._manifests()[:-KEEP_MANIFESTS]:
            files.delete(self._at("manifest", name), False)

    # ── reading ───────────────────────────────────────────────────────────────────────────────

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the rows' keys (`rows` needs the bucket columns); no more than the table has."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def _scan(self, live: dict[int, list[str]], buckets: list[int] | None = None) -> DataFrame:
        wanted = live if buckets is None else {b: live[b] for b in buckets if b in live}
        folders = [f"{self.path}/data/bucket={b}/version={v}" for b, versions in sorted(wanted.items()) for v in versions]
        if not folders:
            return self.spark.createDataFrame([], self._stored)
        found = self.spark.read.schema(self._stored).option("basePath", f"{self.path}/data").parquet(*folders)
        return found if buckets is None else found.where(F.col("bucket").isin(sorted(wanted)))

    def _latest(self, rows: DataFrame, live: dict[int, list[str]]) -> DataFrame:
        if not self.adds and any(len(v) > 1 for v in live.values()):
            newest = rows.groupBy(*[F.col(c).alias(f"_g_{c}") for c in self.group]).agg(F.max("version").alias("_newest"))
            same = [rows[c].eqNullSafe(newest[f"_g_{c}"]) for c in self.group] + [rows["version"] == newest["_newest"]]
            rows = rows.join(newest, same, "left_semi")
        return rows.where(~F.coalesce("_gone", F.lit(False)))

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows that hold now, of some buckets or all."""
        live = self.state().live
        kept = live if buckets is None else {b: live[b] for b in buckets if b in live}
        return self._latest(self._scan(live, buckets), kept).select(*self.columns)

    def read_version(self, version: str) -> DataFrame:
        """The rows that one write has put in, as far as they are not merged yet."""
        live = {b: [version] for b, vs in self.state().live.items() if version in vs}
        return self._scan(live).select(*self.columns)

    def lookup(self, keys: DataFrame, column: str, limit: int = 10_000) -> DataFrame:
        """The rows of a few keys (`keys` has the bucket columns and `column`): the buckets by partition filter, the
        values of `column` as an IN list, which Parquet checks against row group bounds and Bloom filters."""
        few = keys.select(*dict.fromkeys([*self.bucket_by, column])).distinct().limit(limit + 1).collect()
        if len(few) > limit:
            raise ValueError(f"lookup takes {limit} keys at most; join with read() instead")
        small = self.spark.createDataFrame(few, keys.select(*dict.fromkeys([*self.bucket_by, column])).schema)
        found = self.read(self.buckets_of(small)).where(F.col(column).isin(sorted({r[column] for r in few if r[column] is not None})))
        return found.join(F.broadcast(small), [found[c].eqNullSafe(small[c]) for c in small.columns], "left_semi")

    # ── writing ───────────────────────────────────────────────────────────────────────────────

    def _write(self, rows: DataFrame, version: str) -> list[int]:
        """Write `rows` (table columns and _gone) as a version; the buckets it has."""
        hashed = [f.name for f in self.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        placed = rows.withColumn("bucket", self.bucket()).withColumn("version", F.lit(version))
        dealt = placed.withColumn("_piece", F.pmod(F.xxhash64(*hashed), F.lit(self.spread))).hint("rebalance", "bucket", "_piece")
        dealt = dealt.drop("_piece").sortWithinPartitions("bucket", *self.group)
        writer = dealt.write.mode("append").partitionBy("bucket", "version")
        for c in self.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(f"{self.path}/data")
        found = self._files().globStatus(self._at("data", "bucket=*", f"version={version}")) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    def _version(self, number: int) -> str:
        return f"{number:012d}-{uuid.uuid4().hex[:8]}"

    def _outlived(self, live: dict[int, list[str]], version: str) -> list[int]:
        """The buckets that hold a group which `version` has not written."""
        keys = lambda versions, mark: self._scan(versions).select("bucket", *[F.col(c).alias(f"{mark}{c}") for c in self.group])
        before, now = keys({b: v[:-1] for b, v in live.items()}, "_o_"), keys({b: [version] for b in live}, "_n_")
        same = [before[f"_o_{c}"].eqNullSafe(now[f"_n_{c}"]) for c in self.group] + [before["bucket"] == now["bucket"]]
        return sorted(r[0] for r in before.join(now, same, "left_anti").select("bucket").distinct().collect())

    def _finish(self, state: State, touched: list[int], version: str, batch: int | None) -> str:
        """Merge the buckets that have too many versions, and commit. Where rows are only added, the newest write is left
        apart for `read_version`."""
        live = {b: list(v) for b, v in state.live.items()}
        for b in touched:
            live.setdefault(b, []).append(version)
        old = {b: live[b][:-1] if self.adds else live[b] for b in touched if len(live[b]) > self.versions}
        if old and not self.adds:
            mixed = self._outlived(old, version)
            live.update({b: [version] for b in old if b not in mixed})
            old = {b: old[b] for b in mixed}
        if old:
            rows = self._latest(self._scan(old), old)
            merged = self._version(state.number + 1)
            left = self._write(rows.select(*self.columns, "_gone"), merged)
            for b, parts in old.items():
                live[b] = ([merged] if b in left else []) + live[b][len(parts):]
        self._commit(State(state.number + 1, {b: v for b, v in live.items() if v},
                           state.batch if batch is None else batch, version))
        return version

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields], F.lit(False).alias("_gone"))

    def put(self, rows: DataFrame, batch: int | None = None, replaced: DataFrame | None = None) -> str | None:
        """Store `rows` in place of what their groups held; groups of `replaced` that have no rows here lose theirs."""
        if self.adds:
            raise ValueError("rows of this table are only added")
        state = self.state()
        if batch is not None and state.batch is not None and batch <= state.batch:
            return state.version
        new = self._typed(rows)
        if replaced is not None:
            gone = replaced.select(*self.group).distinct()
            new = new.unionByName(gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        version = self._version(state.number + 1)
        return self._finish(state, self._write(new, version), version, batch)

    def add_new(self, rows: DataFrame, identified: Column | None = None, batch: int | None = None) -> str | None:
        """Store the rows whose group key is not stored yet (`rows` holds each key once). Rows that are not `identified`
        have no key and are all stored."""
        if not self.adds:
            raise ValueError("rows of this table are replaced by `put`")
        state = self.state()
        if batch is not None and state.batch is not None and batch <= state.batch:
            return state.version
        known = F.lit(True) if identified is None else identified
        rows = rows.persist()                                                        # a micro-batch
        try:
            keyed = rows.where(known)
            seen = self._scan(state.live, self.buckets_of(keyed)).select(*[F.col(c).alias(f"_s_{c}") for c in self.group])
            fresh = keyed.join(seen, [keyed[c].eqNullSafe(seen[f"_s_{c}"]) for c in self.group], "left_anti")
            version = self._version(state.number + 1)
            touched = self._write(self._typed(fresh.unionByName(rows.where(~known))), version)
        finally:
            rows.unpersist()
        return self._finish(state, touched, version, batch)

    def vacuum(self) -> int:
        """Delete data folders that no kept manifest names; the number of them."""
        named = {(b, v) for name in self._manifests() for b, vs in self._load(name).live.items() for v in vs}
        files, gone = self._files(), 0
        for status in files.globStatus(self._at("data", "bucket=*", "version=*")) or []:
            path = status.getPath()
            key = (int(path.getParent().getName().split("=")[1]), path.getName().split("=")[1])
            if key not in named:
                files.delete(path, True)
                gone += 1
        return gone
