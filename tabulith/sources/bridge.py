"""Layout relations made from the driver's tables, in SQL that Spark and DuckDB both read.

One page for each order: its line items are table rows, their fields are words, and rulings run
around them. All coordinates are multiples of 1/4, so that both engines compute the same values.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.storage import not_sent

LINE = """SELECT l_orderkey AS doc_id, CAST(1 AS BIGINT) AS page_no, CAST(row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS BIGINT) AS line,
  l_partkey AS p, l_suppkey AS s, CAST(floor(l_quantity) AS BIGINT) AS q FROM {lineitem}"""

WORD = f"""SELECT doc_id, page_no, line * 10 + k AS word_seq,
  CAST(50 + 100 * k + p % 3 AS DOUBLE) AS x0, CAST(100 + 14 * line + (s + k) % 3 AS DOUBLE) AS y0,
  CAST(CASE WHEN k = 2 AND p % 4 = 3 THEN 143 ELSE 90 + 100 * k END + p % 3 AS DOUBLE) AS x1, CAST(108 + 14 * line + (s + k) % 3 AS DOUBLE) AS y1,
  CASE k WHEN 0 THEN concat('B', CAST(line AS STRING))
         WHEN 1 THEN concat(CAST(q AS STRING), '-T', CAST(8 + 4 * (p % 5) AS STRING))
         WHEN 2 THEN CASE p % 5 WHEN 0 THEN '25 mm' WHEN 1 THEN '6Ø130C/C' WHEN 2 THEN 'T10@150c/c' WHEN 3 THEN '2-16Ø+1-12Ø' ELSE '4-T20+unknown' END
         ELSE CASE WHEN p % 7 = 0 THEN '-' ELSE concat('R', CAST(s AS STRING)) END END AS text
  FROM ({LINE}) AS l CROSS JOIN (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT)), (CAST(2 AS BIGINT)), (CAST(3 AS BIGINT))) AS c(k)"""

_Y = "CAST(112 + 14 * line + CASE WHEN line > 5 THEN 60 ELSE 0 END AS DOUBLE)"
_X = "CAST(45 + 100 * (k - 2) AS DOUBLE) + 0.5e0 * (line % 2)"
SEGMENT = f"""SELECT doc_id, page_no, line * 10 + k AS item_seq, CASE WHEN k = 8 THEN 'c' ELSE 'l' END AS kind,
  CASE WHEN k = 0 THEN 40e0 WHEN k = 1 THEN 210e0 WHEN k < 7 THEN {_X} ELSE 0e0 END AS p1x,
  CASE WHEN k = 0 THEN {_Y} WHEN k = 1 THEN {_Y} + 0.5e0 WHEN k < 7 THEN {_Y} - 14 ELSE 0e0 END AS p1y,
  CASE WHEN k = 0 THEN 200e0 WHEN k = 1 THEN 450e0 WHEN k < 7 THEN {_X} ELSE 50e0 END AS p2x,
  CASE WHEN k = 0 THEN {_Y} + 0.25e0 WHEN k = 1 THEN {_Y} + 0.5e0 WHEN k < 7 THEN {_Y} ELSE 50e0 END AS p2y
  FROM ({LINE}) AS l CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8)) AS c(k)"""

BLOCK = """SELECT o_orderkey AS doc_id, CAST(1 AS BIGINT) AS page_no, CAST(k AS BIGINT) AS block_seq,
  CAST(50 + 120 * k AS DOUBLE) AS x0, CAST(60 + o_custkey % 50 AS DOUBLE) AS y0, CAST(150 + 120 * k AS DOUBLE) AS x1, CAST(72 + o_custkey % 50 AS DOUBLE) AS y1,
  CASE (o_orderkey + k) % 16 WHEN 0 THEN 'SCHEDULE   OF   BEAMS' WHEN 1 THEN 'Schedule of Slabs' WHEN 2 THEN 'BAR BENDING SCHEDULE' WHEN 3 THEN 'see BBS'
    WHEN 4 THEN 'Weight Schedule' WHEN 5 THEN 'Insert Schedule' WHEN 6 THEN 'Dowel Bar Schedule' WHEN 7 THEN 'REVISION SCHEDULE' WHEN 8 THEN 'GENERAL NOTES:'
    WHEN 9 THEN 'Legend' WHEN 10 THEN 'Column Schedule' WHEN 11 THEN 'Schedule of Materials' WHEN 12 THEN 'BOM' WHEN 13 THEN 'SCHEDULE OF SLAB BEAM(SB)' ELSE o_orderpriority END AS text,
  CAST(CASE WHEN (o_orderkey + k) % 9 = 0 THEN 1 ELSE 0 END AS BIGINT) AS block_type
  FROM {orders} CROSS JOIN (VALUES (0), (1), (2)) AS c(k)"""

REGION = """SELECT o_orderkey AS doc_id, CAST(1 AS BIGINT) AS page_no, CAST(0 AS BIGINT) AS region_index,
  CAST(40 + o_custkey % 7 AS DOUBLE) AS x0, CAST(90 + o_custkey % 30 AS DOUBLE) AS y0, CAST(240 + o_custkey % 90 AS DOUBLE) AS x1, CAST(300 AS DOUBLE) AS y1,
  o_custkey % 3 > 0 AS structured, o_custkey % 11 = 0 AS in_zone, o_custkey % 5 = 0 AS title_hit,
  CAST(o_custkey % 4 AS BIGINT) AS row_count, CAST(o_custkey % 6 AS BIGINT) AS col_count,
  CASE o_custkey % 6 WHEN 0 THEN 'Volume' WHEN 1 THEN 'Ref No' WHEN 2 THEN 'GRADE OF STEEL' WHEN 3 THEN 'Beam Mkd.' ELSE 'Remarks' END AS header1,
  CASE o_custkey % 7 WHEN 0 THEN 'Rev' WHEN 1 THEN 'Client' WHEN 2 THEN 'Weight' WHEN 3 THEN 'Clear  Span' ELSE 'xyzzy' END AS header2,
  o_orderstatus <> 'F' AS expected
  FROM {orders}"""

TABLES = ("lineitem", "orders")
#: For each table its order's key, and the rows in a task: a line item becomes up to nine rulings, which are sorted in the
#: task that numbers the lines; an order becomes three blocks, whose titles take long to find.
DEALT = {"lineitem": ("l_orderkey", 200_000), "orders": ("o_orderkey", 50_000)}


def _table(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, int]:
    """A table dealt by order over as many tasks as its rows ask for, and its rows: no task grows with it, nor do few files make few tasks."""
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key, rows = DEALT[name]
    n = found.count()
    tasks = ceil(n / rows)
    return found.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), key) if tasks > 1 else found, n


def relation(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Rows of a relation over the tables in a folder.

    Its fields are made once a row, in an array of one: else the planner writes a field's whole CASE into each place that
    reads it, and a method of over 8,000 bytes is never compiled by the JVM. Joins send no large one whole to all tasks."""
    tables = {t: _table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    found = spark.sql(sql, **{t: df for t, (df, _) in tables.items()})
    keys = [c for c in ("doc_id", "page_no") if c in found.columns]
    fields = [c for c in found.columns if c not in keys]
    made = found.select(*keys, F.inline(F.array(F.struct(*fields)))).select(*found.columns) if fields else found
    return not_sent(made, max(n for _, n in tables.values()))


def plain(sql: str) -> str:
    """The relation's SQL over tables by their names."""
    return sql.format(**{t: t for t in TABLES})
