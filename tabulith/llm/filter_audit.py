"""How document filters act on one another: what each removes, alone and after the others, in every order.

Exact duplicates are found by sorting. Rows are dealt by range over text fingerprint (64 bits, then a
digest of 256), full text and doc_id, so a text that many documents share is spread over several tasks
by its ids; each row is held against the one before it, and a run that goes on over a boundary takes
its first id from the tasks before. The failures of a document are one mask; masks are counted by part, and all 120 orders are
worked out from those counters, at most 32 for a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulith.llm.work import WORD, partitions, prepare, stash

FILTERS = "ABCDE"
#: Bit of the filter on duplicates; the other filters have the bits before it, in their order.
DUPLICATE = 16


def text_failures(text: Column) -> Column:
    """Mask of the four filters on the text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failed = (n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n, 100 * capitals > 5 * F.length(text), F.rlike(text, F.lit(r"[#$%&*|]")))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0)).cast("int")


def _first_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of fp, sha, text, doc_id without their text, with run (their run's number in the task) and first_id
    (the run's first id there)."""
    before, run, first = None, -1, None
    for batch in batches:
        if not batch.num_rows:
            continue
        fp, text, ids = batch.column("fp").to_numpy(), batch.column("text"), batch.column("doc_id")
        same = np.zeros(len(fp), bool)
        same[0] = before is not None and before[0] == fp[0] and before[1].equals(text[0])
        for at in np.flatnonzero(fp[1:] == fp[:-1]) + 1:
            same[at] = text[int(at)].equals(text[int(at) - 1])
        runs = run + np.cumsum(~same)
        starts = np.maximum.accumulate(np.where(same, -1, np.arange(len(fp))))  # -1: the run began in the batch before
        firsts = pc.take(ids, pa.array(np.maximum(starts, 0)))
        if starts[0] < 0:
            firsts = pc.if_else(pa.array(starts < 0), first, firsts)
        before, run, first = (fp[-1], text[len(fp) - 1]), int(runs[-1]), firsts[len(fp) - 1]
        kept = [batch.column(c) for c in ("task", "part", "doc_id", "mask", "sha")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(runs.astype(np.int64)), firsts], names=["task", "part", "doc_id", "mask", "sha", "run", "first_id"])


def failures(docs: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, doc_id, mask) of every row: bits A to E, E where a smaller id has the same whole text.

    Null texts are empty and null parts the empty string. A null id counts as larger than all others, and rows
    of one id and text are no copies of each other. An empty table gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(F.coalesce(docs[part_col], F.lit("")).alias("part"), docs[id_col].alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("fp"), F.unhex(F.sha2(text, 256)).alias("sha"))
    by_id = F.asc_nulls_last("doc_id")
    # the bounds of ranges pass through the driver: they have a text's digest, not the text
    dealt = rows.repartitionByRange(partitions(spark), "fp", "sha", by_id).sortWithinPartitions("fp", "sha", "text", by_id)
    ready = dealt.select("fp", "text", "doc_id", "part", text_failures(F.col("text")).alias("mask"), "sha", F.spark_partition_id().alias("task"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = stash(ready.mapInArrow(_first_ids, f"task int, part string, doc_id {id_type}, mask int, sha binary, run long, first_id {id_type}"), "runs")
    return _joined_runs(found)


def _joined_runs(found: DataFrame) -> DataFrame:
    """Runs that go on over a boundary take the first id of the task in which they begin.

    Boundaries are a row for each run at a task's edge, two a task at most; their texts are told apart by digest."""
    last = found.groupBy("task").agg(F.max("run").alias("last"))  # a row for each task
    edges = found.join(F.broadcast(last), "task").where((F.col("run") == 0) | (F.col("run") == F.col("last")))
    edges = edges.groupBy("task", "run").agg(F.first("sha").alias("sha"), F.struct(F.first("first_id").alias("id")).alias("first"))
    # a run that is its task's first goes on from the task before if that one's last run has the same text
    order = Window.orderBy("task", "run")
    goes_on = (F.col("run") == 0) & F.coalesce(F.lag("sha").over(order) == F.col("sha"), F.lit(False))
    chain = edges.withColumn("goes_on", goes_on).withColumn("chain", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(order))
    begins = F.first("first").over(Window.partitionBy("chain").orderBy("task", "run"))
    carried = chain.withColumn("begins", begins).where("goes_on").select(F.col("task").alias("t"), F.lit(0).cast("long").alias("r"), "begins")
    met = found.join(F.broadcast(carried), (F.col("task") == F.col("t")) & (F.col("run") == F.col("r")), "left")
    first = F.when(F.col("begins").isNotNull(), F.col("begins.id")).otherwise(F.col("first_id"))
    later = F.col("doc_id").isNull() & first.isNotNull() | (F.col("doc_id") > first)
    return met.select("part", "doc_id", F.when(later, F.col("mask") + DUPLICATE).otherwise(F.col("mask")).alias("mask"))


def counters(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by mask, those that any label calls good, and toxic. Rows without an id have no labels. Counters add up."""
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("g"), F.max((F.col("toxic") == 1).cast("int")).alias("t"))
    met = failed.join(told, "doc_id", "left")
    return met.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("g", F.lit(0))).cast("long").alias("good"), F.sum(F.coalesce("t", F.lit(0))).cast("long").alias("toxic"))


def _places() -> Column:
    """One entry for each filter and set of filters before it: its bit, their mask, and the orders with it there."""
    held: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in permutations(FILTERS):
        for step, f in enumerate(order):
            held.setdefault((1 << FILTERS.index(f), sum(1 << FILTERS.index(x) for x in order[:step])), []).append(("".join(order), step + 1))
    entry = lambda bit, before, orders: F.struct(F.lit(bit).alias("bit"), F.lit(before).alias("before"), F.lit(len(orders)).cast("long").alias("times"), F.array(*(F.lit(o) for o, _ in orders)).alias("orders"), F.lit(orders[0][1]).alias("step"))
    assert all(len(o) == factorial(s := bin(b).count("1")) * factorial(4 - s) for (_, b), o in held.items())
    return F.array(*(entry(*k, o) for k, o in held.items()))


def orders(counted: DataFrame) -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    at = counted.select("*", F.explode(_places()).alias("at")).select("*", "at.bit", "at.before", "at.times", "at.orders", "at.step")
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda cond, of="n": F.sum(F.when(cond, F.col(of)).otherwise(0))
    sums = at.groupBy("part", "bit", "before", "step", "times", "orders").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    sums = sums.withColumn("shapley", F.sum(F.col("removed") * F.col("times")).over(Window.partitionBy("part", "bit")))
    return sums.select("part", F.explode("orders").alias("filter_order"), "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """One row for each part, order and step; see failures() for odd rows. Empty documents give none."""
    return orders(stash(counters(failures(docs, part_col), labels), "counters"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b, 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d, doc_id > first_id AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN l USING (doc_id)),
k AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS failed,
             count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT x1.f || x2.f || x3.f || x4.f || x5.f AS filter_order FROM x x1, x x2, x x3, x x4, x x5
      WHERE len(list_distinct([x1.f, x2.f, x3.f, x4.f, x5.f])) = 5),
s AS (SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS f, substr(filter_order, 1, step - 1) AS before FROM o, range(1, 6) AS r(step)),
m AS (SELECT part, filter_order, step, f, contains(failed, f) AS fails, before <> '' AND regexp_matches(failed, '[' || before || 'x]') AS gone, failed = f AS alone, n, good, toxic FROM k, s),
t AS (SELECT part, filter_order, step, f, CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost FROM m GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM t
"""
