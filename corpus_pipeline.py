"""A corpus from raw documents: recognised languages, no copies, sources mixed to weights, encoded.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; run() writes each stage's rows to the
shared folder and hands them to the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm import bpe, exact_dedup, language, mixing, similar
from tabulith.llm.work import stash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language: null texts and those without a letter go."""
    return language.accept(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those equal without white space: the longest, then the smallest id, null last. Null text is empty."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: pairs by SimHash and pivots over five-word shingles, similarity 0.8.

    The smallest id stays, null last; texts without a word are one component."""
    return similar.drop_near_duplicates(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for; null is a source of its own."""
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (little-endian unsigned 32-bit), n_tokens and the text decoded from ids.

    Null text is empty: no ids, n_tokens 0, decoded empty. Empty tables give none in all stages."""
    out = bpe.round_trip(docs, {c: docs[c] for c in ("doc_id", "lang", "source")})
    return out.select("doc_id", "lang", "source", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), "decoded")


STAGES = [("language ID", language_id), ("exact dedup", exact), ("SimHash near-dedup", near), ("mixing sources", mixing_sources), ("BPE encoding", encoding)]

#: Language inference, fingerprints and BPE can't be said in SQL; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
