"""Mixing sources to target weights: repetition rates from tokens per source, then whole copies.

A source's rate is its target over its size. Each document is emitted floor(rate) times, and once
more where a hash of it, as a number from 0 to 1, is below the rate's fraction: the same rows give
the same mix whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulith.llm.work import stash, words_in

WEIGHTS = (5, 2, 1)
#: A source's target stops at so many times its size.
MOST_TIMES = 3.0
#: Up to so many sources (a checked number), their rates are sent to all executors.
BROADCAST_SOURCES = 10_000


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_TIMES) -> DataFrame:
    """source_key, source_size, target, rate from (source_key, source_size), one row a source.

    Sources in code point order, null last, take the weights in turn and share all sizes by them. A
    target stops at ``most`` times the source's size. What is above is shared again by weight until
    no target is above: sources ordered by limit over weight are at their limit up to a point, and
    beyond it the rest is shared by weight, so that one pass of running sums finds it.
    """
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(Window.orderBy(F.col("source_key").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    w = sizes.select("*", weight.alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("limit"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source_key").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    w = w.withColumn("level", level)
    below = F.col("limit") > F.col("level") * F.col("weight")
    common = F.max(F.when(below, F.col("level"))).over(every)
    target = F.least("limit", F.coalesce(common * F.col("weight"), F.col("limit")))
    w = w.select("source_key", "source_size", target.alias("target"))
    return w.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def chance(docs: DataFrame, seed: int, id_col: str, text_col: str) -> Column:
    """A number from 0 to 1 that depends on the id and the text alone."""
    text = F.md5(F.coalesce(docs[text_col], F.lit("")))
    h = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(docs[id_col].cast("string"), F.lit("")), text))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long") * F.lit(2.0**-52)


def rated(docs: DataFrame, seed: int = 7, weights: Sequence[float] = WEIGHTS, most: float = MOST_TIMES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: __tl_size, __tl_source_size, __tl_target, __tl_copies, and the columns in carry.

    Null text has size 0; null is a source of its own. A source of size 0 gives no copies. Rows
    alike in id and text share one decision. An empty table gives no rows.
    """
    size = words_in(docs[text_col])
    source = docs[source_col]
    sizes = docs.groupBy(source.alias("source_key")).agg(F.sum(size).alias("source_size"))
    rates = stash(targets(sizes, weights, most), "rates")
    few = rates.count() <= BROADCAST_SOURCES
    left = docs.select(*(docs[c] for c in carry), source.alias("__tl_source"), size.alias("__tl_size"), chance(docs, seed, id_col, text_col).alias("__tl_chance"))
    right = rates.select(F.col("source_key").alias("__tl_key"), F.col("source_size").alias("__tl_source_size"), F.col("target").alias("__tl_target"), F.col("rate").alias("__tl_rate"))
    out = left.join(F.broadcast(right) if few else right, F.col("__tl_source").eqNullSafe(F.col("__tl_key")))
    whole = F.floor("__tl_rate").cast("int")
    copies = whole + (F.col("__tl_chance") < F.col("__tl_rate") - whole).cast("int")
    return out.select(*(F.col(f"`{c}`") for c in carry), "__tl_size", "__tl_source_size", "__tl_target", copies.alias("__tl_copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as its source's rate says, with all their columns.

    Rows of sources without a word are left out, null texts of others are taken at their source's rate;
    rows alike in id and text come alike often; an empty table gives no rows.
    """
    out = rated(docs, carry=docs.columns, **options)
    each = F.explode(F.when(F.col("__tl_copies") > 0, F.sequence(F.lit(1), F.col("__tl_copies"))))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns), each.alias("__tl_copy")).drop("__tl_copy")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = rated(docs, carry=["doc_id"])
    return out.select("doc_id", F.col("__tl_size").alias("size"), F.col("__tl_source_size").alias("source_size"), F.col("__tl_target").alias("target"), (F.col("__tl_size") * F.col("__tl_copies")).alias("taken"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             CAST('0x' || substr(md5(concat_ws(':', '7', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))), 1, 13) AS BIGINT) / 4503599627370496.0 AS chance
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, coalesce(max(CASE WHEN cap > level * weight THEN level END) OVER () * weight, cap)) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
