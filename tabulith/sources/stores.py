"""Dictionaries of terms and labelled regions as JSON files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TERMS = "term string, category string, source_pdf string, added_on string, notes string"
BOX = "struct<x0: double, y0: double, x1: double, y1: double>"
LABELLED = f"source_pdf string, page_width double, page_height double, title_block_zone {BOX}, candidates array<struct<label: string, expected_keep: boolean, bbox: {BOX}, structure_source: string, header_texts: array<string>, row_count: long, col_count: long, nearby_title_text: string, nearby_title_regex_hit: boolean>>"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def load_terms(spark: SparkSession, path: str) -> DataFrame:
    """Terms of a JSON array or of JSON lines in a file or folder; no terms if there is none."""
    if not _exists(spark, path):
        return spark.createDataFrame([], TERMS)
    return spark.read.schema(TERMS).json(path, multiLine=not os.path.basename(path.rstrip("/")).endswith(".jsonl"))


def save_terms(terms: DataFrame, path: str) -> None:
    """One JSON object a line, nulls kept, in a folder; name it ``*.jsonl`` to load it again."""
    terms.select(*(x.split()[0] for x in TERMS.split(", "))).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def load_labelled(spark: SparkSession, path: str) -> DataFrame:
    """One row per labelled region of all JSON files in a folder, in file order: page, zone, and the region's fields.

    A folder or file named ``*.jsonl`` has a page's object a line."""
    lines = path.rstrip("/").endswith(".jsonl")
    files = spark.read.schema(LABELLED).json(path, multiLine=not lines, pathGlobFilter=None if lines else "*.json").withColumn("file", F.col("_metadata.file_name"))
    rows = files.select("file", "source_pdf", "page_width", "page_height", "title_block_zone", F.posexplode("candidates").alias("i", "c"))
    return rows.select("file", "source_pdf", "page_width", "page_height", "title_block_zone", "i", "c.*")
