"""Intermediate tables in the session's shared folder: computed once, read again by several branches of a plan.

Also what Python workers need to find this package."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no shared folder and runs on one machine, as in tests.
LOCAL = "file:///tmp/checkpoints"
#: Rows up to which a table may be sent whole to all tasks: some 10 MB of them in memory at most.
SENT = 20_000


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; on a cluster there must be one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    return (base or LOCAL).rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table of its own in the shared folder and reads it back: evaluated once, lineage cut.

    A lost executor costs no more than its tasks. The tables are left to whoever owns the folder."""
    path = f"{shared_folder(df.sparkSession)}/tabulith/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return not_sent(df.sparkSession.read.schema(df.schema).parquet(path))


def not_sent(table: DataFrame, rows: int | None = None) -> DataFrame:
    """table so that a join with it is by shuffle if it has over SENT rows (counted if not given: for files from their footers).

    The planner judges by the size of files, of which rows take up to fifty times as much in memory, and the driver
    holds whole what is sent to all tasks. The hint holds for selections and groups of the table, not beyond its next join."""
    return table.hint("merge") if (table.count() if rows is None else rows) > SENT else table


def sent_if_few(table: DataFrame) -> DataFrame:
    """table for a join with a large one by a key that few values share: sent to all tasks if it has up to SENT rows."""
    return F.broadcast(table) if table.count() <= SENT else table


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it; called before one is used."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)
