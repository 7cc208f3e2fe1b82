"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.session import ensure_checkpoint_dir
from runlens.sources.adapters import read_table  # noqa: F401  (re-exported for the query modules)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder that `spark.checkpoint.dir` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/runlens-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: the lineage is cut, lost
    executors cost nothing that was finished, and later joins see exact sizes."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """Arrow batches in pieces of a few rows, so that what a task derives from texts stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at: at + rows]


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_key(id_col: str = "doc_id") -> Column:
    """The id as a join key that is never null."""
    return F.coalesce(F.col(id_col).cast("string"), F.lit("null"))


def keep_ids(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of `docs` whose id (null included) is in `kept`, with the columns of `docs`."""
    wanted = kept.select(row_key(id_col).alias("_keep_id")).distinct()
    return docs.withColumn("_keep_id", row_key(id_col)).join(wanted, "_keep_id", "left_semi").drop("_keep_id")
