"""Headers of several rows: which texts stand over which columns.

Cells of the first rows that no ruling parts are one span; a span stands over another where it covers all its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulith.operators.geometry import PAGE, centred, joined_text
from tabulith.operators.spatial import boxes_meeting, points_in
from tabulith.storage import stored


def header_spans(cells: DataFrame, lines: DataFrame, words: DataFrame, per: list[str] = PAGE, header_rows: int = 2) -> DataFrame:
    """per, r, first_c, last_c, x0, x1, text: the spans of a grid's first rows, empty ones included.

    Neighbours in a row are one span where no vertical within 2 points of their divider covers the row's height, a point
    less at each end. A word on a border between rows is in the upper one, on one between spans in both. Grids of fewer
    rows have the spans of those they have; null texts add nothing."""
    head = stored(cells.where(F.col("r") < header_rows).select(*per, "r", "c", "x0", "y0", "x1", "y1"), "header-cells")
    reach = head.where("c > 0").select(*per, "r", "c", "x0", "y0", "y1", (F.col("x0") - 2).alias("dx0"), (F.col("x0") + 2).alias("dx1"), (F.col("y0") - 1).alias("dy0"), (F.col("y1") + 1).alias("dy1"))
    upright = lines.where("orientation = 'vertical'").select(*per, F.col("position").alias("at"), "start", "end")
    met = boxes_meeting(reach, upright, [("dx0", "dx1"), ("dy0", "dy1")], [("at", "at"), ("start", "end")], per)
    parted = met.where("start <= y0 + 1 and end >= y1 - 1").select(*per, "r", "c").distinct().withColumn("parted", F.lit(1))
    row = Window.partitionBy(*per, "r").orderBy("c")
    numbered = head.join(parted, [*per, "r", "c"], "left").withColumn("span", F.sum(F.coalesce("parted", F.lit(0))).over(row))
    spans = numbered.groupBy(*per, "r", "span").agg(F.min("c").alias("first_c"), F.max("c").alias("last_c"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    spans = stored(spans, "header-spans")
    held = points_in(spans.select(*per, "r", "span", "x0", "y0", "x1", "y1"), centred(words), [("x0", "x1"), ("y0", "y1")], ["cx", "cy"])
    upper = Window.partitionBy(*per, "word_seq")
    said = held.withColumn("top", F.min("r").over(upper)).where("r = top").groupBy(*per, "r", "span").agg(F.trim(joined_text()).alias("text"))
    out = spans.join(said, [*per, "r", "span"], "left")
    return out.select(*per, "r", "first_c", "last_c", "x0", "x1", F.coalesce("text", F.lit("")).alias("text"))


def header_trees(spans: DataFrame, per: list[str] = PAGE) -> DataFrame:
    """per, col_index, raw_header, parent_header, path of every column, from header_spans().

    A column's header is the lowest text over it, "" if there is none; its path goes up from there by the next text that
    covers all columns of the one below, and is given from the top. The parent is the last but one; null without."""
    columns = spans.select(*per, "r", "first_c", "last_c", "text", F.explode(F.sequence("first_c", "last_c")).alias("col_index"))
    item = F.when(F.col("text") != "", F.struct((-F.col("r")).alias("up"), "first_c", "last_c", "text"))
    listed = columns.groupBy(*per, "col_index").agg(F.array_sort(F.collect_list(item)).alias("items"))
    covers = lambda x, last: (x["first_c"] <= last["first_c"]) & (x["last_c"] >= last["last_c"])
    step = lambda path, x: F.when((F.size(path) == 0) | covers(x, F.element_at(path, -1)), F.concat(path, F.array(x))).otherwise(path)
    path = F.aggregate("items", F.slice("items", 1, 0), step)
    texts = F.reverse(F.transform(path, lambda p: p["text"]))
    out = listed.withColumn("path", texts)
    return out.select(*per, "col_index", F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit("")).alias("raw_header"), F.try_element_at("path", F.lit(-2)).alias("parent_header"), "path")
