"""Shared working storage and row selection that the operators of this subpackage have in common.

Intermediate tables and model files go to the folder named in ``spark.checkpoint.dir``: the
driver and every executor see it, so a lost executor takes nothing with it.
"""

from __future__ import annotations

import os
import uuid
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no shared folder and runs on one machine, as in tests.
UNSHARED = "file:///tmp/checkpoints"

#: Everything but these six characters belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, and give freed memory back."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)
        # workers live on from stage to stage: large blocks are mapped, so that freeing returns them
        env |= {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}


def new_folder(spark: SparkSession, name: str, within: str | None = None) -> str:
    """URI of a folder of its own in the shared storage, or within a named folder: what was written there before stays
    as it is, as do the maps that workers hold of it."""
    if within:
        return f"{within.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    base = base or UNSHARED
    return f"{base.rstrip('/')}/tabulith/{name}-{uuid.uuid4().hex}"


def mounted(uri: str) -> str:
    """Path by which workers open a shared folder; memory mapping needs one that is mounted."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped arrays need a mounted shared folder, not {uri}")
    return unquote(parts.path)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: evaluated once, lineage cut."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def replace_file(path: str, write) -> None:
    """Writes a file under a name of its own, then renames: a repeated task does no harm."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        write(f)
    os.replace(own, path)


def words_in(text: Column) -> Column:
    """Number of words as long; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def text_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart: the id, and a hash and the length of the text."""
    t = F.coalesce(docs[text_col], F.lit(""))
    return [docs[id_col], F.xxhash64(t), F.length(t)]


def keep_rows(docs: DataFrame, keys: list[Column], keep: DataFrame) -> DataFrame:
    """Rows of docs, with all their columns, whose keys are in ``keep(k0, k1, ..., ties)``.

    Each row of keep stands for one row that stays; where ``ties`` rows of docs have that key, one
    of them stays.
    """
    names = [f"__tl_key{i}" for i in range(len(keys))]
    left = docs.select("*", *(k.alias(n) for k, n in zip(keys, names, strict=True)))
    right = keep.select(*(F.col(f"k{i}").alias(f"__tl_keep{i}") for i in range(len(keys))), F.col("ties").alias("__tl_ties"))
    on = [left[n].eqNullSafe(right[f"__tl_keep{i}"]) for i, n in enumerate(names)]
    joined = left.join(right, on, "inner")
    kept = joined.where("__tl_ties = 1")
    if keep.where("ties > 1").limit(1).count():
        kept = kept.unionByName(joined.where("__tl_ties > 1").dropDuplicates(names))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
