"""Rulings, grids and words as relations. Pages are keyed by (doc_id, page_no)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_no"]


def classify_segments(segments: DataFrame, straight: float = 2.0, least: float = 5.0, per: list[str] = PAGE) -> DataFrame:
    """Rulings from straight segments: keys, orientation, position, start, end. Horizontal goes first."""
    dx, dy = F.abs(F.col("p2x") - F.col("p1x")), F.abs(F.col("p2y") - F.col("p1y"))
    s = segments.where((F.col("kind") == "l") & (F.hypot(dx, dy) >= least) & ((dx < straight) | (dy < straight)))
    h = F.when(dy < straight, True).otherwise(False)
    mid = lambda a: (F.col(f"p1{a}") + F.col(f"p2{a}")) / 2
    low, high = lambda a: F.least(f"p1{a}", f"p2{a}"), lambda a: F.greatest(f"p1{a}", f"p2{a}")
    return s.select(*per, F.when(h, "horizontal").otherwise("vertical").alias("orientation"), F.when(h, mid("y")).otherwise(mid("x")).alias("position"), F.when(h, low("x")).otherwise(low("y")).alias("start"), F.when(h, high("x")).otherwise(high("y")).alias("end"))


def islands(df: DataFrame, keys: list[str], by: str, gap: float, start: str | None = None) -> DataFrame:
    """df with ``island``: rows in order of ``by`` stay together while (start or by) is within gap of the row before's by."""
    order = Window.partitionBy(*keys).orderBy(by)
    far = F.coalesce((F.col(start or by) - F.lag(by).over(order) > gap).cast("long"), F.lit(0))
    return df.withColumn("__far", far).withColumn("island", F.sum("__far").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__far")


def merge_collinear(lines: DataFrame, tolerance: float = 2.0, per: list[str] = PAGE) -> DataFrame:
    """One ruling for each chain of rulings within the tolerance: mean position, least start, greatest end."""
    keys = [*per, "orientation"]
    grouped = islands(lines, keys, "position", tolerance).groupBy(*keys, "island")
    return grouped.agg(F.avg("position").alias("position"), F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def row_bottoms(lines: DataFrame, gap: float = 40.0, per: list[str] = PAGE) -> DataFrame:
    """bottom: the last row of horizontals, to a tenth, before the first gap over ``gap``; only where there are two rows or more."""
    rows = lines.where("orientation = 'horizontal'").select(*per, F.bround("position", 1).alias("y")).distinct()
    order = Window.partitionBy(*per).orderBy("y")
    steps = rows.withColumn("next", F.lead("y").over(order)).groupBy(*per)
    ends = steps.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min(F.when(F.col("next") - F.col("y") > gap, F.col("y"))), F.max("y")).alias("bottom"))
    return ends.where("n >= 2").drop("n")


def trim_bottom(lines: DataFrame, gap: float = 40.0, per: list[str] = PAGE) -> DataFrame:
    """Rulings without the horizontals below the first gap over ``gap``; fewer than two rows stay as they are."""
    met = lines.join(row_bottoms(lines, gap, per), per, "left")
    return met.where("orientation = 'vertical' or bottom is null or position <= bottom + 1").drop("bottom")


def grid_positions(lines: DataFrame, per: list[str] = PAGE) -> DataFrame:
    """ys and xs, the distinct positions to a tenth in order, of each grid with at least two each way."""
    lists = lines.groupBy(*per).agg(*(F.array_sort(F.collect_set(F.when(F.col("orientation") == o, F.bround("position", 1)))).alias(n) for o, n in (("horizontal", "ys"), ("vertical", "xs"))))
    return lists.where((F.size("ys") >= 2) & (F.size("xs") >= 2))


def position_cells(grids: DataFrame, per: list[str] = PAGE) -> DataFrame:
    """Cells (r, c, x0, y0, x1, y1) between the positions ys and xs of grids, row by row."""
    spans = lambda a: F.transform(F.sequence(F.lit(1), F.size(a) - 1), lambda i: F.struct(F.element_at(a, i).alias("a"), F.element_at(a, i + 1).alias("b")))
    rows = grids.select(*per, "xs", F.posexplode(spans(F.col("ys"))).alias("r", "y"))
    cells = rows.select(*per, "r", "y", F.posexplode(spans(F.col("xs"))).alias("c", "x"))
    return cells.select(*per, F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.col("x.a").alias("x0"), F.col("y.a").alias("y0"), F.col("x.b").alias("x1"), F.col("y.b").alias("y1"))


def grid_cells(lines: DataFrame, per: list[str] = PAGE) -> DataFrame:
    """Cells (r, c, x0, y0, x1, y1) of each grid from at least two positions each way."""
    return position_cells(grid_positions(lines, per), per)


def spans_holding(positions: Column, at: Column) -> Column:
    """Numbers of the spans between ascending positions that hold a value; one on a position is in both beside it.

    The positions are gone through once for either end of the spans, which are bound for the rest."""
    below, upto = F.size(F.filter(positions, lambda p: p < at)), F.size(F.filter(positions, lambda p: p <= at))
    ends = F.struct(F.greatest(below - 1, F.lit(0)).alias("a"), F.least(upto - 1, F.size(positions) - 2).alias("z"))
    spans = lambda e: F.when(e["a"] <= e["z"], F.sequence(e["a"].cast("long"), e["z"].cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(F.array(ends), spans)[0]


def centred(words: DataFrame) -> DataFrame:
    """Page, word_seq, text, cx and cy of words."""
    return words.select(*PAGE, "word_seq", "text", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"))


def joined_text(when: Column | None = None) -> Column:
    """Aggregate: texts in order of word_seq, a space between them; only those for which ``when`` holds."""
    item = F.struct("word_seq", "text")
    return F.array_join(F.transform(F.array_sort(F.collect_list(item if when is None else F.when(when, item))), lambda s: s["text"]), " ")


def cell_text(words: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells of page grids with the words whose centre they hold, borders included, in order of word_seq.

    A word finds its rows and columns in its page's positions, and its cells by their numbers: no word
    meets a cell that does not hold it. Cells without words have an empty text."""
    grids = cells.groupBy(*PAGE).agg(*(F.array_sort(F.array_union(F.collect_set(f"{a}0"), F.collect_set(f"{a}1"))).alias(f"{a}s") for a in "yx"))
    met = centred(words).join(grids, PAGE)
    placed = met.select(*PAGE, "word_seq", "text", spans_holding(F.col("xs"), F.col("cx")).alias("cs"), F.explode(spans_holding(F.col("ys"), F.col("cy"))).alias("r"))
    placed = placed.select(*PAGE, "word_seq", "text", "r", F.explode("cs").alias("c"))
    texts = placed.groupBy(*PAGE, "r", "c").agg(joined_text().alias("text"))
    return cells.join(texts, [*PAGE, "r", "c"], "left").select(*PAGE, "r", "c", F.coalesce("text", F.lit("")).alias("text"))


def text_rows(words: DataFrame, tolerance: float = 6.0) -> DataFrame:
    """words with ``row``: in order of centre, a word joins the row while within tolerance of its running mean.

    The mean moves with each word, so this is a fold and not a window. But it never exceeds the last word's centre, so
    a step over the tolerance always begins a row: words are first cut there, by window, and the fold is over what lies
    between two such steps, not over a page. It gives the places at which rows begin, from which the rows are cut.
    Words without coordinates come first, each a row of its own."""
    # a little more than the tolerance, as a mean is rounded
    w = islands(words.withColumn("cy", (F.col("y0") + F.col("y1")) / 2), PAGE, "cy", tolerance + 1e-6)
    item = F.struct("cy", "word_seq", "x0", "y0", "x1", "y1", "text")
    pages = w.groupBy(*PAGE, "island").agg(F.array_sort(F.collect_list(item)).alias("words"))
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("starts"))

    def step(acc, x):
        same = (acc["n"] > 0) & (F.abs(x["cy"] - acc["sum"] / F.greatest(acc["n"], F.lit(1))) <= tolerance)
        on = F.struct((acc["sum"] + x["cy"]).alias("sum"), (acc["n"] + 1).alias("n"), (acc["i"] + 1).alias("i"), acc["starts"].alias("starts"))
        return F.when(same, on).otherwise(F.struct(x["cy"].alias("sum"), F.lit(1).alias("n"), (acc["i"] + 1).alias("i"), F.concat(acc["starts"], F.array(acc["i"] + 1)).alias("starts")))

    folded = pages.select(*PAGE, "island", "words", F.aggregate("words", zero, step)["starts"].alias("starts"))
    before = Window.partitionBy(*PAGE).orderBy("island").rowsBetween(Window.unboundedPreceding, -1)
    folded = folded.withColumn("first", F.coalesce(F.sum(F.size("starts")).over(before), F.lit(0)))
    end = lambda i: F.coalesce(F.get("starts", i + 1), F.size("words") + 1)
    cut = F.transform("starts", lambda s, i: F.struct((F.col("first") + i).alias("row"), F.slice("words", s, end(i) - s).alias("words")))
    rows = folded.select(*PAGE, F.explode(cut).alias("r")).select(*PAGE, F.col("r.row").alias("row"), F.explode("r.words").alias("w"))
    return rows.select(*PAGE, "w.*", "row")


def text_cells(rows: DataFrame, gap: float = 8.0) -> DataFrame:
    """Cells of text rows: words in order of centre, cut where the space before one is over ``gap``."""
    w = rows.withColumn("cx", (F.col("x0") + F.col("x1")) / 2)
    order = Window.partitionBy(*PAGE, "row").orderBy("cx", "word_seq")
    cut = F.coalesce((F.col("x0") - F.lag("x1").over(order) > gap).cast("long"), F.lit(0))
    w = w.withColumn("cut", cut).withColumn("cell", F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cx", "word_seq", "text"))), lambda s: s["text"]), " ")
    return w.groupBy(*PAGE, "row", "cell").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), words.alias("text"))


def column_grid(cells: DataFrame) -> DataFrame:
    """Column boundaries of a page: those rows of at least two cells that have most of them, averaged by place."""
    order = Window.partitionBy(*PAGE, "row").orderBy("cell")
    w = cells.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*PAGE, "row"))).where("n >= 2").withColumn("most", F.max("n").over(Window.partitionBy(*PAGE))).where("n = most")
    edge = F.when(F.col("cell") == 0, F.col("x0")).otherwise((F.lag("x1").over(order) + F.col("x0")) / 2)
    last = F.when(F.col("cell") == F.col("n") - 1, F.struct(F.col("n").alias("place"), F.col("x1").alias("edge")))
    edges = F.filter(F.array(F.struct(F.col("cell").alias("place"), edge.alias("edge")), last), lambda e: e.isNotNull())
    return w.select(*PAGE, edges.alias("edges")).select(*PAGE, F.explode("edges").alias("e")).groupBy(*PAGE, F.col("e.place").alias("place")).agg(F.avg("e.edge").alias("edge"))


def row_bounds(rows: DataFrame) -> DataFrame:
    """Row boundaries of a page: the first top, half way between rows, the last bottom."""
    r = rows.groupBy(*PAGE, "row").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    order = Window.partitionBy(*PAGE).orderBy("row")
    top = F.coalesce((F.lag("y1").over(order) + F.col("y0")) / 2, F.col("y0"))
    last = F.when(F.lead("row").over(order).isNull(), F.struct((F.col("row") + 1).alias("place"), F.col("y1").alias("edge")))
    edges = F.filter(F.array(F.struct(F.col("row").alias("place"), top.alias("edge")), last), lambda e: e.isNotNull())
    return r.select(*PAGE, edges.alias("edges")).select(*PAGE, F.explode("edges").alias("e")).select(*PAGE, "e.place", "e.edge")


def largest_gap(rows: DataFrame) -> DataFrame:
    """Text rows split at their largest horizontal gap, the first of equals: left and right text."""
    w = rows.withColumn("cx", (F.col("x0") + F.col("x1")) / 2)
    order = Window.partitionBy(*PAGE, "row").orderBy("cx", "word_seq")
    w = w.withColumn("i", F.row_number().over(order)).withColumn("gap", F.lead("x0").over(order) - F.col("x1"))
    cut = w.groupBy(*PAGE, "row").agg(F.coalesce(F.max_by("i", F.when(F.col("gap") > -1, F.struct("gap", -F.col("i")))), F.when(F.count(F.lit(1)) < 2, F.count(F.lit(1)).cast("int")).otherwise(F.lit(1))).alias("cut"))
    text = lambda left: F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("i", "text", "cut"))), lambda s: (s["i"] <= s["cut"]) == left), lambda s: s["text"]), " ")
    return w.join(cut, [*PAGE, "row"]).groupBy(*PAGE, "row").agg(text(F.lit(True)).alias("left_text"), text(F.lit(False)).alias("right_text"))
