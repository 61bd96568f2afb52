"""Exact duplicates against a persistent digest index, bucketed and sorted by hash.

Texts are equal when they are identical without the six ASCII spaces. A batch is reduced to one row
for each digest, met with the index by a sort-merge anti-join, and what is new is appended with the
row that stays. Of the rest, only how many rows the batch has is appended, so that a digest's rows in
the index add up to its group.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm.work import SPACE, keep_rows, new_folder, partitions, stash, text_key

SCHEMA = "digest binary, keep_id {id}, keep_points bigint, group_size bigint, keep_key bigint, batch string, keep_row bigint"


class DigestIndex:
    """A table of digests at ``path``; opening a path that holds one goes on with it.

    With no path, a new index in the shared folder. ``buckets`` files are written for each append,
    each sorted by digest, so that a join on the digest needs no exchange of the index. The number of
    buckets and the type of ids are kept beside the table: a reopened index has those it was made
    with, whatever the session's settings and these parameters say. close() takes its name out of the
    catalog and leaves the files.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.path = spark, path or new_folder(spark, "digests")
        layout = self._layout() if path else None
        self.buckets, self.id_type = layout or (buckets or partitions(spark), id_type)
        if layout is None:
            spark.createDataFrame([(self.buckets, self.id_type)], "buckets int, id_type string").coalesce(1).write.parquet(f"{self.path}-layout")
        self.name = f"tabulith_digests_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} ({SCHEMA.format(id=self.id_type)}) USING parquet OPTIONS (path '{self.path}') CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS")

    def _layout(self) -> tuple[int, str] | None:
        try:
            return tuple(self.spark.read.parquet(f"{self.path}-layout").first())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def entries(self) -> DataFrame:
        """A row for each digest of each batch; only a digest's first batch has the row that stays."""
        return self.spark.table(self.name)

    def rows(self) -> DataFrame:
        """One row for each digest: the row that stays, and its group's size in its first batch."""
        return self.entries().where("keep_row is not null")

    def append(self, rows: DataFrame) -> None:
        rows = rows.select(*self.entries().columns).repartition(self.buckets, "digest")
        rows.write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, code points of the text, digest of the text without spaces, hash of the text."""
    t = F.coalesce(docs[text_col], F.lit(""))
    key = text_key(docs, id_col, text_col)
    return docs.select(key[0].alias("doc_id"), F.length(t).cast("long").alias("points"), F.unhex(F.sha2(F.regexp_replace(t, SPACE, ""), 256)).alias("digest"), key[1].alias("text_key"))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, points, text_key.

    The row with the most code points stays, then the smallest id (null last); rows alike in both
    leave one. Texts that the index holds from an earlier batch stay represented by their row there,
    and group_size counts the rows of all batches up to this one. Null text is empty; an empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    batch = uuid.uuid4().hex
    seen = stash(digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "digests")
    own = DigestIndex(spark, id_type=seen.schema["doc_id"].dataType.simpleString()) if index is None else None
    index = index or own
    first = F.min(F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "text_key"))
    groups = seen.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("rows"))
    if own is None:
        groups = stash(groups, "groups")
    added = {"keep_id": F.col("first.doc_id"), "keep_points": -F.col("first.less"), "keep_key": F.col("first.text_key"), "keep_row": F.col("first.row")}
    fresh = groups.hint("merge").join(index.rows().select("digest"), "digest", "left_anti")
    news = fresh.select("digest", F.col("rows").alias("group_size"), F.lit(batch).alias("batch"), *(c.alias(n) for n, c in added.items()))
    if own is None:
        again = groups.hint("merge").join(index.rows().select("digest"), "digest", "left_semi")
        nothing = [F.lit(None).cast(index.entries().schema[n].dataType).alias(n) for n in added]
        news = stash(news.unionByName(again.select("digest", F.col("rows").alias("group_size"), F.lit(batch).alias("batch"), *nothing)), "news")
    index.append(news)
    held = index.entries() if own else groups.select("digest").hint("merge").join(index.entries(), "digest")
    keeper = F.max(F.when(F.col("keep_row").isNotNull(), F.struct("keep_row", "keep_id", "batch")))
    sizes = held.groupBy("digest").agg(F.sum("group_size").alias("group_size"), keeper.alias("k")).select("digest", "k.keep_id", "group_size", "k.batch", "k.keep_row")
    # written first, so that nothing but this join stands on the exchanges and a hot digest can be split
    out = seen.hint("merge").join(stash(sizes, "groups"), "digest")
    if own:
        own.close()
    kept = (F.col("batch") == batch) & (F.col("keep_row") == F.col("row"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "points", "text_key")


def drop_duplicates(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns, names that clash with those used here included.

    Null text is empty; of rows alike in id and text one stays; an empty table gives no rows.
    """
    verdicts = stash(deduplicate(docs, index, id_col, text_col), "kept")
    keys = ["doc_id", "text_key", "points"]
    tied = verdicts.groupBy(*keys).agg(F.count(F.lit(1)).alias("ties"), F.max("kept").alias("kept")).where("kept")
    keep = tied.select(F.col("doc_id").alias("k0"), F.col("text_key").alias("k1"), F.col("points").cast("int").alias("k2"), "ties")
    return keep_rows(docs, text_key(docs, id_col, text_col), keep)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return deduplicate(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
                  row_number() OVER () AS r FROM documents),
w AS (SELECT *, first_value(doc_id) OVER g AS keep_id, first_value(r) OVER g AS keep_r,
             count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST, r))
SELECT doc_id, keep_id, group_size, r = keep_r AS kept, text_sha256 FROM w
"""
