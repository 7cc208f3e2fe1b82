"""Spark session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that decide correctness or plan shape, not just speed.
#  - UTC session time zone: trace timestamps are naive UTC.
#  - AQE with skew-join splitting: one session or tenant may hold a large share of rows.
#  - ANSI stays on (Spark 4 default); operators use try_* functions so a bad row never fails a job.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "runlens",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above. For tests and the bench script;
    on a cluster the submitter owns the session and only `ensure_checkpoint_dir` is needed."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    On a cluster this setting must point at shared storage and is left alone; without it this is an error, since
    a local folder of one machine is invisible to the others. Only a session that runs in a single process
    (`local[...]`, tests) gets a scratch folder."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="runlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet below the shared checkpoint folder and read back, for large tables that are used more
    than once: compressed, and later uses read only their columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/runlens/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
