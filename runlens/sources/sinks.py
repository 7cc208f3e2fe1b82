"""Sinks (A11, A12): evals and incidents in keyed tables.

A row's id is a name-based UUID of what identifies it (an eval: session, name, agent and metric; an incident: session and
pattern), so a rerun gives the same ids. Writing replaces by session: the rows of a session take the place of its earlier ones
and other sessions are left alone, so writing twice leaves the same table. `sessions` names judged sessions that may have
no row now (their earlier ones go). Only the hash buckets of the written sessions are rewritten, and a new manifest makes
the write visible as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.functions.columns import K
from runlens.sources.keyed_table import KeyedTable

EVAL_ID = [*K, "eval_name", "agent", "metric"]
INCIDENT_ID = [*K, "pattern_name"]


def row_id(*parts: Column) -> Column:
    """A name-based UUID (MD5) of the parts; a null part differs from an empty one."""
    h = F.md5(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-3"), cut(14, 3), F.lit("-a"), cut(18, 3), F.lit("-"), cut(21, 12))


def identified_evals(evals: DataFrame) -> DataFrame:
    """Stored form of evals with their ids; of evals that agree in all of EVAL_ID the place in config order counts too."""
    from runlens.operators.evals import eval_rows
    rows = eval_rows(evals)
    own = [c for c in EVAL_ID if c in rows.columns]
    order = F.col("config_ord") if "config_ord" in rows.columns else F.col("score")
    nth = F.row_number().over(Window.partitionBy(*own).orderBy(order))
    return rows.withColumn("_nth", nth).withColumn("id", row_id(*map(F.col, own), F.col("_nth"))).drop("_nth")


def identified_incidents(incidents: DataFrame) -> DataFrame:
    """Stored form of incidents with their ids (a session has one incident of a pattern at most)."""
    from runlens.operators.detectors import incident_rows
    rows = incident_rows(incidents).withColumn("status", F.lit("open"))
    return rows.withColumn("id", row_id(*map(F.col, INCIDENT_ID)))


def _upsert(rows: DataFrame, path: str, sessions: DataFrame | None, buckets: int) -> None:
    KeyedTable(rows.sparkSession, path, rows.schema, K, buckets=buckets, versions=1).put(rows, replaced=sessions)


def write_evals(evals: DataFrame, path: str, sessions: DataFrame | None = None, buckets: int = 64) -> None:
    """Stored form (id, score rounded to 3, layer 3) in place of the sessions' earlier evals."""
    _upsert(identified_evals(evals), path, sessions, buckets)


def write_incidents(incidents: DataFrame, path: str, frames: DataFrame | None = None, sessions: DataFrame | None = None,
                    buckets: int = 64) -> None:
    """Incidents (id, cost rounded to 4, status 'open') in place of the sessions' earlier ones; frames alongside."""
    _upsert(identified_incidents(incidents), f"{path}/incidents", sessions, buckets)
    if frames is not None:
        _upsert(frames, f"{path}/frames", sessions, buckets)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows that hold now in a table written by one of these sinks."""
    return KeyedTable.open(spark, path).read()
