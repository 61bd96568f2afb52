"""Regions of pages: search areas of titles, table bounds, candidates, merged headers, order of precedence.

A region is keyed by its page and the number of the block that is its title. Title blocks carry the
size of their page (width, height)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulith.operators.geometry import PAGE, centred, classify_segments, islands, joined_text, merge_collinear, position_cells, spans_holding
from tabulith.operators.spatial import boxes_meeting, points_in
from tabulith.storage import importable, stored

REGION = [*PAGE, "block_seq"]
#: The columns of an area, as tile joins take them.
AREA = [("rx0", "rx1"), ("ry0", "ry1")]
#: Points by which a ruling may miss another and still touch it.
TOUCH = 3.0
#: Greatest height of a table below its top ruling or title.
DEPTH = 900.0
#: Greatest step between two rows of a table's rulings.
GAP = 40.0


def _area(x0: Column, y0: Column, x1: Column, y1: Column) -> list[Column]:
    """An area cut to its page."""
    zero = F.lit(0.0)
    return [F.greatest(zero, x0).alias("rx0"), F.greatest(zero, y0).alias("ry0"), F.least("width", x1).alias("rx1"), F.least("height", y1).alias("ry1")]


def corridors(titles: DataFrame) -> DataFrame:
    """titles with the area (rx0, ry0, rx1, ry1) in which a table's first rulings are looked for."""
    half = F.greatest(3 * (F.col("x1") - F.col("x0")), F.lit(200.0)) / 2
    mid = (F.col("x0") + F.col("x1")) / 2
    return titles.select("*", *_area(mid - half, F.col("y0") - 50, mid + half, F.col("y1") + 150))


def text_areas(titles: DataFrame) -> DataFrame:
    """titles with the area below them that a table without rulings may fill."""
    side = F.greatest(0.7 * (F.col("x1") - F.col("x0")), F.lit(40.0))
    return titles.select("*", *_area(F.col("x0") - side, F.col("y1"), F.col("x1") + side, F.col("y1") + DEPTH))


def rulings_in(areas: DataFrame, segments: DataFrame) -> DataFrame:
    """Merged rulings of each area, from the page's segments whose drawing's box (dx0, dy0, dx1, dy1) meets the area.

    A drawing that reaches into the area gives all its segments; segments without those columns are drawings of their own."""
    drawn = {"dx0", "dy0", "dx1", "dy1"} <= set(segments.columns)
    box = [(F.col(f"d{a}{i}") if drawn else f(f"p1{a}", f"p2{a}")).alias(f"s{a}{i}") for a in "xy" for i, f in enumerate((F.least, F.greatest))]
    lines = classify_segments(segments.select("*", *box), per=[*PAGE, "sx0", "sy0", "sx1", "sy1"])
    near = boxes_meeting(areas.select(*REGION, "rx0", "ry0", "rx1", "ry1"), lines, AREA, [("sx0", "sx1"), ("sy0", "sy1")])
    return merge_collinear(near.select(*REGION, "orientation", "position", "start", "end"), per=REGION)


def table_bounds(titles: DataFrame, segments: DataFrame) -> DataFrame:
    """Region, rx0, ry0, rx1, ry1 of titles with a horizontal ruling in their corridor.

    The topmost ruling is the table's top; of the verticals that touch it, the nearest on either side
    of the title bound it, or the outermost where a side has none, or the ruling's own ends."""
    lines = rulings_in(corridors(titles), segments)
    flat, upright = F.col("orientation") == "horizontal", F.col("orientation") == "vertical"
    whole = F.struct("position", "start", "end")
    top, ups = F.min_by(whole, F.when(flat, F.col("position"))), F.collect_list(F.when(upright, whole))
    found = lines.groupBy(*REGION).agg(top.alias("top"), F.count_if(flat).alias("n"), ups.alias("ups")).where("n > 0")
    t = titles.select(*REGION, F.col("x0").alias("tx0"), F.col("x1").alias("tx1"), "height")
    y, a, z = F.col("top.position"), F.col("top.start"), F.col("top.end")
    touching = F.filter("ups", lambda v: (v["start"] <= y + TOUCH) & (v["end"] >= y - TOUCH) & v["position"].between(a - TOUCH, z + TOUCH))
    met = found.join(t, REGION).withColumn("xs", F.transform(touching, lambda v: v["position"]))
    left, right = F.array_max(F.filter("xs", lambda x: x < F.col("tx0") + TOUCH)), F.array_min(F.filter("xs", lambda x: x > F.col("tx1") - TOUCH))
    both = left.isNotNull() & right.isNotNull()
    low, high = F.when(both, left).otherwise(F.coalesce(F.array_min("xs"), a)), F.when(both, right).otherwise(F.coalesce(F.array_max("xs"), z))
    return met.select(*REGION, (low - 5).alias("rx0"), (y - 5).alias("ry0"), (high + 5).alias("rx1"), F.least("height", y + DEPTH).alias("ry1"))


def ruled_grids(bounds: DataFrame, segments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of regions(rx0, ry0, rx1, ry1): their areas cut off below the last row of rulings (far: where they ended), their grids (ys, xs), their rulings.

    Rulings below the first large gap are left out; an area with fewer than two rows is not cut."""
    found = stored(rulings_in(bounds, segments), "rulings")
    tenths = lambda o: F.array_sort(F.collect_set(F.when(F.col("orientation") == o, F.bround("position", 1))))
    last = F.element_at("rows", -1)
    ended = F.filter(F.transform("rows", lambda y, i: F.when(F.get("rows", i + 1) - y > GAP, y)), lambda y: y.isNotNull())
    bottom = F.when(F.size("rows") >= 2, F.coalesce(F.get(ended, F.lit(0)), last))
    lists = found.groupBy(*REGION).agg(tenths("horizontal").alias("rows"), tenths("vertical").alias("xs")).withColumn("bottom", bottom)
    # read for the areas, the grids and the rulings
    lists = stored(lists.withColumn("ys", F.when(F.col("bottom").isNull(), F.col("rows")).otherwise(F.filter("rows", lambda y: y <= F.col("bottom")))).drop("rows"), "positions")
    areas = bounds.join(lists.select(*REGION, "bottom"), REGION, "left").select(*REGION, "rx0", "ry0", "rx1", F.coalesce("bottom", "ry1").alias("ry1"), F.col("ry1").alias("far"))
    lines = found.join(lists.select(*REGION, "bottom"), REGION, "left").where("orientation = 'vertical' or bottom is null or position <= bottom + 1").drop("bottom")
    return areas, lists.where((F.size("ys") >= 2) & (F.size("xs") >= 2)).select(*REGION, "ys", "xs"), lines


def region_grids(bounds: DataFrame, segments: DataFrame) -> DataFrame:
    """Cells of each region's grid, without what lies below its first large gap."""
    return position_cells(ruled_grids(bounds, segments)[1], REGION)


def words_in(areas: DataFrame, words: DataFrame) -> DataFrame:
    """areas(rx0, ry0, rx1, ry1) joined with the words whose centre they hold."""
    mid = lambda a: ((F.col(f"{a}0") + F.col(f"{a}1")) / 2).alias(f"m{a}")
    return points_in(areas, words.select(*PAGE, "word_seq", "x0", "y0", "x1", "y1", "text", mid("x"), mid("y")), AREA, ["mx", "my"]).drop("mx", "my")


#: A word of an area: cy, word_seq, x0, y0, x1, y1.
_Placed = tuple[float, tuple, float, float, float, float]


def written_edges(words: list[_Placed], tolerance: float = 6.0, gap: float = 8.0) -> tuple[list[float], list[float]]:
    """ys and xs of one area's words as text_rows, row_bounds, text_cells and column_grid find them on a page; no xs without a row of two cells."""
    rows: list[list[_Placed]] = []
    total, n = 0.0, 0
    for w in sorted(words):
        if n and abs(w[0] - total / n) <= tolerance:
            rows[-1].append(w)
            total, n = total + w[0], n + 1
        else:
            rows.append([w])
            total, n = w[0], 1
    tops, ends = [min(w[3] for w in r) for r in rows], [max(w[5] for w in r) for r in rows]
    ys = [*tops[:1], *((end + top) / 2 for end, top in zip(ends, tops[1:])), *ends[-1:]]
    best: list[list[tuple[float, float]]] = []
    for row in rows:
        cells: list[tuple[float, float]] = []
        last = 0.0
        for w in sorted(row, key=lambda w: ((w[2] + w[4]) / 2, w[1])):
            if not cells or w[2] - last > gap:
                cells.append((w[2], w[4]))
            else:
                cells[-1] = (min(cells[-1][0], w[2]), max(cells[-1][1], w[4]))
            last = w[4]
        most = len(best[0]) if best else 2
        if len(cells) >= most:
            best = [*best, cells] if len(cells) == most else [cells]
    edges = [[c[0][0], *((a[1] + b[0]) / 2 for a, b in pairwise(c)), c[-1][1]] for c in best]
    return ys, [sum(e) / len(e) for e in zip(*edges)]


def written_grids(areas: DataFrame, words: DataFrame) -> DataFrame:
    """Region, ys, xs of the grids that words make in areas: from six words, two rows, three column edges.

    Rows are bounded half way between them, columns by the mean of the rows that have most cells. An area's words
    are one row, read in Python; many areas are a batch."""
    importable(words.sparkSession)
    inside = words_in(areas.select(*REGION, "rx0", "ry0", "rx1", "ry1"), words)
    word = F.struct("word_seq", *(F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")))
    listed = inside.groupBy(*REGION).agg(F.collect_list(word).alias("words")).where(F.size("words") >= 6)
    kind = ", ".join(f"{c} {listed.schema[c].dataType.simpleString()}" for c in REGION)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            # words without a number go first
            flat = [((y0 + y1) / 2, (n is not None, n), x0, y0, x1, y1) for n, x0, y0, x1, y1 in zip(*(c.to_pylist() for c in lists.flatten().flatten()), strict=True)]
            at, down, across, first = [], [], [], 0
            for area, n in enumerate(lists.value_lengths().to_pylist()):
                ys, xs = written_edges(flat[first : first + n])
                first += n
                if len(ys) >= 3 and len(xs) >= 3:
                    at.append(area)
                    down.append(ys)
                    across.append(xs)
            keys = [batch.column(c).take(pa.array(at, pa.int64())) for c in REGION]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(v, pa.list_(pa.float64())) for v in (down, across))], names=[*REGION, "ys", "xs"])

    return listed.mapInArrow(run, f"{kind}, ys array<double>, xs array<double>")


def near_title(titles: DataFrame, grids: DataFrame, most: float = 1.2) -> DataFrame:
    """grids(ys, xs) with those columns whose middle is within ``most`` title widths of the title's; without any, none.

    A kept column keeps its right edge; where fewer than three edges are left the grid stays as it is."""
    t = titles.select(*REGION, ((F.col("x0") + F.col("x1")) / 2).alias("__mid"), (most * (F.col("x1") - F.col("x0"))).alias("__far"))
    edges = F.transform(F.sequence(F.lit(1), F.size("xs") - 1), lambda i: F.struct(((F.element_at("xs", i) + F.element_at("xs", i + 1)) / 2).alias("mid"), F.element_at("xs", i + 1).alias("right")))
    near = F.transform(F.filter(edges, lambda e: F.abs(e["mid"] - F.col("__mid")) <= F.col("__far")), lambda e: e["right"])
    met = grids.join(t, REGION).withColumn("__near", near).where(F.size("__near") > 0)
    left = F.concat(F.slice("xs", 1, 1), F.col("__near"))
    return met.withColumn("xs", F.when(F.size("__near") >= 2, left).otherwise(F.col("xs"))).select(*grids.columns)


def title_grids(titles: DataFrame, segments: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables of titles: Region, rx0, ry0, rx1, ry1, source, ys, xs; and the rulings of those areas. Titles without a table are dropped.

    In bounds at least 30 wide, a grid of rulings over two rows or more goes before one of words there, and
    that before a single row of rulings. Where rulings bound nothing, words below the title make a grid of
    the columns near it."""
    bounds = stored(table_bounds(titles, segments).where("rx1 - rx0 >= 30"), "bounds")
    areas, ruled, lines = ruled_grids(bounds, segments)
    # each area with its cut and its grid of rulings, if any, and all areas to be searched for words: read several times below
    cut = stored(areas.join(ruled, REGION, "left").withColumn("n", F.coalesce(F.size("ys"), F.lit(0))), "cut")
    box = [*REGION, "rx0", "ry0", "rx1", "ry1"]
    below = text_areas(titles).select(*box).join(bounds, REGION, "left_anti")
    inside = cut.where("n < 3").select(*REGION, "rx0", "ry0", "rx1", F.col("far").alias("ry1"))
    search = stored(inside.withColumn("below", F.lit(False)).unionByName(below.withColumn("below", F.lit(True))), "search")
    written = stored(written_grids(search.select(*box), words), "written")
    vector = cut.where("n >= 3").unionByName(cut.where("n > 0 and n < 3").join(written, REGION, "left_anti"))
    vector = vector.select(*box, "ys", "xs").withColumn("source", F.lit("vector"))
    loose = written.join(cut.select(*box), REGION).unionByName(near_title(titles, written.join(search.where("below").select(*box), REGION)))
    return stored(vector.unionByName(loose.withColumn("source", F.lit("text_clustering"))), "grids"), lines


def region_shapes(titles: DataFrame, segments: DataFrame, words: DataFrame) -> DataFrame:
    """Region, detection_strategy, row_count, col_count of each title's table, header row included; titles without one are dropped."""
    grids, _ = title_grids(titles, segments, words)
    return grids.select(*REGION, (F.size("ys") - 1).cast("long").alias("row_count"), (F.size("xs") - 1).cast("long").alias("col_count"), F.col("source").alias("detection_strategy"))


def near_columns(titles: DataFrame, columns: DataFrame, most: float = 1.2) -> DataFrame:
    """columns(page, x0, x1) of each title whose middle is within ``most`` title widths of the title's."""
    c = columns.select(*PAGE, F.col("x0").alias("c0"), F.col("x1").alias("c1"), ((F.col("x0") + F.col("x1")) / 2).alias("mid"))
    far, mid = most * (F.col("x1") - F.col("x0")), (F.col("x0") + F.col("x1")) / 2
    # a little wider, as the difference below rounds otherwise than the sums here
    reach = titles.select(*REGION, far.alias("far"), mid.alias("middle"), (mid - far - 1e-6).alias("low"), (mid + far + 1e-6).alias("high"))
    met = points_in(reach, c, [("low", "high")], ["mid"]).where(F.abs(F.col("mid") - F.col("middle")) <= F.col("far"))
    return met.select(*REGION, F.col("c0").alias("x0"), F.col("c1").alias("x1"))


def merged_headers(cells: DataFrame, lines: DataFrame, per: list[str] = PAGE, header_rows: int = 1) -> DataFrame:
    """Header cells that hold two columns, and with several header rows those that hold two rows.

    No vertical at their divider covers the header's height, or no horizontal at a divider within the
    header covers the column. Grids with fewer rows than the header have none."""
    band = cells.where(F.col("r") < header_rows).groupBy(*per).agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.max("r").alias("last_row")).where(F.col("last_row") == header_rows - 1).drop("last_row")
    head = cells.where("r = 0").drop("y0", "y1").join(band, per)
    nxt = head.select(*per, (F.col("c") - 1).alias("c"), F.col("x0").alias("divider"), F.col("x1").alias("last"))
    same = [F.col(f"h.{k}") == F.col(f"v.{k}") for k in per]
    upright, flat = (lines.where(F.col("orientation") == o).alias("v") for o in ("vertical", "horizontal"))
    covers = F.expr("abs(v.position - h.divider) <= 2 and v.start <= h.y0 + 1 and v.end >= h.y1 - 1")
    alone = head.join(nxt, [*per, "c"]).alias("h").join(upright, [*same, covers], "left_anti")
    out = alone.select(*per, (F.col("c") + 1).alias("divider"), "x0", "y0", F.col("last").alias("x1"), "y1", F.lit("horizontal").alias("merge_type"))
    if header_rows > 1:
        rows = cells.where((F.col("r") > 0) & (F.col("r") < header_rows)).select(*per, F.col("r").alias("divider"), "x0", "x1", F.col("y0").alias("y")).join(band, per).alias("h")
        across = F.expr("abs(v.position - h.y) <= 2 and v.start <= h.x0 + 1 and v.end >= h.x1 - 1")
        tall = rows.join(flat, [*same, across], "left_anti")
        out = out.unionByName(tall.select(*per, "divider", "x0", "y0", "x1", "y1", F.lit("vertical").alias("merge_type")))
    return out


def header_cells(words: DataFrame, cells: DataFrame) -> DataFrame:
    """c and raw_header of page grids; an empty header is read again down to the second row's end.

    A word finds its columns in its page's positions, so it meets no other column's header."""
    second = cells.where("r = 1").groupBy(*PAGE).agg(F.max("y1").alias("far"))
    grids = cells.where("r = 0").groupBy(*PAGE).agg(F.array_sort(F.array_union(F.collect_set("x0"), F.collect_set("x1"))).alias("xs"), F.min("y0").alias("y0"), F.max("y1").alias("y1")).join(second, PAGE, "left")
    inside, wider = F.expr("cy between y0 and y1"), F.expr("cy between y0 - 3 and far")
    met = centred(words).join(grids, PAGE).where(inside | wider)
    placed = met.select(*PAGE, "word_seq", "text", inside.alias("inside"), wider.alias("wider"), F.explode(spans_holding(F.col("xs"), F.col("cx"))).alias("c"))
    texts = placed.groupBy(*PAGE, "c").agg(F.trim(joined_text(F.col("inside"))).alias("t"), F.trim(joined_text(F.col("wider"))).alias("u"))
    raw = F.coalesce(F.nullif("t", F.lit("")), "u", F.lit(""))
    return cells.where("r = 0").select(*PAGE, "c").join(texts, [*PAGE, "c"], "left").select(*PAGE, "c", raw.alias("raw_header"))


def header_texts(headers: DataFrame) -> DataFrame:
    """Distinct non-empty headers of a page as an array, in order of their first column."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("c", "raw_header"))), lambda s: s["raw_header"])
    return headers.where("raw_header <> ''").groupBy(*PAGE).agg(F.array_distinct(listed).alias("header_texts"))


def vector_candidates(lines: DataFrame) -> DataFrame:
    """Boxes of possible tables: horizontals in steps up to 40, with verticals in steps up to 20 that meet them."""
    across = islands(lines.where("orientation = 'horizontal'"), PAGE, "position", 40.0)
    bands = across.groupBy(*PAGE, "island").agg(F.min("position").alias("y0"), F.max("position").alias("y1"), F.count(F.lit(1)).alias("n")).where("n >= 2").withColumnRenamed("island", "band")
    upright = lines.where("orientation = 'vertical'").select(*PAGE, "position", "start", "end")
    reach = bands.select("*", (F.col("y0") - 5).alias("low"), (F.col("y1") + 5).alias("high"))
    met = boxes_meeting(reach, upright, [("low", "high")], [("start", "end")]).select(*PAGE, "band", "y0", "y1", "position")
    groups = islands(met, [*PAGE, "band"], "position", 20.0).groupBy(*PAGE, "band", "y0", "y1", "island")
    boxes = groups.agg(F.min("position").alias("x0"), F.max("position").alias("x1"), F.count(F.lit(1)).alias("n"))
    return boxes.where("n >= 2 and x1 - x0 >= 30 and y1 - y0 >= 15").select(*PAGE, "x0", "y0", "x1", "y1")


def large_boxes(drawings: DataFrame) -> DataFrame:
    """Drawings of at least 20 by 20, which may frame a title block."""
    return drawings.where("x1 - x0 >= 20 and y1 - y0 >= 20")


def in_zone(regions: DataFrame, zones: DataFrame, slack: float = 2.0) -> DataFrame:
    """regions with in_zone: within slack inside their page's title block; false where it has none."""
    z = zones.select(*PAGE, *(F.col(c).alias(f"z{c}") for c in ("x0", "y0", "x1", "y1")))
    inside = F.expr(f"x0 >= zx0 - {slack} and y0 >= zy0 - {slack} and x1 <= zx1 + {slack} and y1 <= zy1 + {slack}")
    return regions.join(z, PAGE, "left").select(*regions.columns, F.coalesce(inside, F.lit(False)).alias("in_zone"))


def not_covered_before(titles: DataFrame, regions: DataFrame) -> DataFrame:
    """Region keys of titles in block order, without those whose centre lies in a kept one's region before.

    Titles without a region are dropped and cover nothing. The fold holds one page's titles."""
    t = titles.select(*REGION, ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"))
    item = F.struct("block_seq", "cx", "cy", "rx0", "ry0", "rx1", "ry1")
    pages = t.join(regions, REGION).groupBy(*PAGE).agg(F.array_sort(F.collect_list(item)).alias("items"))
    holds = lambda k, x: (x["cx"].between(k["rx0"], k["rx1"])) & (x["cy"].between(k["ry0"], k["ry1"]))
    step = lambda kept, x: F.when(F.exists(kept, lambda k: holds(k, x)), kept).otherwise(F.concat(kept, F.array(x)))
    kept = F.aggregate("items", F.slice("items", 1, 0), step)
    return pages.select(*PAGE, F.explode(F.transform(kept, lambda k: k["block_seq"])).alias("block_seq"))


def overlaid_dropped(words: DataFrame, within: float = 2.0) -> DataFrame:
    """words without those whose text stands, under ``within`` away each way, in a word kept before them."""
    mid = lambda w, a: (w[f"{a}0"] + w[f"{a}1"]) / 2
    twin = lambda k, w: (F.abs(mid(k, "x") - mid(w, "x")) < within) & (F.abs(mid(k, "y") - mid(w, "y")) < within)
    item = F.struct("word_seq", "x0", "y0", "x1", "y1")
    same = words.groupBy(*PAGE, "text").agg(F.array_sort(F.collect_list(item)).alias("items"))
    step = lambda kept, w: F.when(F.exists(kept, lambda k: twin(k, w)), kept).otherwise(F.concat(kept, F.array(w)))
    kept = F.aggregate("items", F.slice("items", 1, 0), step)
    return same.select(*PAGE, "text", F.explode(kept).alias("w")).select(*PAGE, "w.word_seq", "w.x0", "w.y0", "w.x1", "w.y1", "text")


def joined_boxes(boxes: list[tuple[float, ...]], dx: float, dy: float) -> list[tuple[float, ...]]:
    """Boxes united while any two lie within dx and dy; a united box reaches further than its parts."""
    todo, before = [tuple(b) for b in boxes], -1
    while len(todo) != before:
        before, rest, todo = len(todo), todo, []
        while rest:
            x0, y0, x1, y1 = rest[0]
            apart = []
            for b in rest[1:]:
                if b[0] <= x1 + dx and b[2] >= x0 - dx and b[1] <= y1 + dy and b[3] >= y0 - dy:
                    x0, y0, x1, y1 = min(x0, b[0]), min(y0, b[1]), max(x1, b[2]), max(y1, b[3])
                else:
                    apart.append(b)
            todo.append((x0, y0, x1, y1))
            rest = apart
    return todo


_CORNERS = ["x0", "y0", "x1", "y1"]
#: Boxes that a task unites by itself at a time: pages with no more are united at once, on others more makes the first step slower and the rounds after it fewer.
_AT_ONCE = 256


def _united_nearby(boxes: DataFrame, dx: float, dy: float) -> DataFrame:
    """Boxes united with others of their part of the page, _AT_ONCE at a time; what lies across parts is left for the rounds."""
    importable(boxes.sparkSession)
    part = [F.floor(F.col(c) / (20 * d + 500)).alias(t) for c, d, t in (("x0", dx, "__tx"), ("y0", dy, "__ty"))]
    keys = [*PAGE, "__tx", "__ty"]
    kind = ", ".join(f"{c} {boxes.schema[c].dataType.simpleString()}" for c in [*PAGE, *_CORNERS])

    def unite(batches):
        for batch in batches:
            rows = []
            for key, group in batch.groupby(keys, sort=False):
                listed = list(group[_CORNERS].itertuples(index=False, name=None))
                for i in range(0, len(listed), _AT_ONCE):
                    rows += [(*key[: len(PAGE)], *b) for b in joined_boxes(listed[i : i + _AT_ONCE], dx, dy)]
            yield pd.DataFrame(rows, columns=[*PAGE, *_CORNERS])

    dealt = boxes.select(*PAGE, *_CORNERS, *part)
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "y0", "x0").mapInPandas(unite, kind)


def _united_pages(boxes: DataFrame, dx: float, dy: float) -> DataFrame:
    """Boxes united page by page: a page is one row of at most _AT_ONCE boxes, many of them are a batch."""
    importable(boxes.sparkSession)
    pages = boxes.groupBy(*PAGE).agg(F.collect_list(F.struct(*_CORNERS)).alias("boxes"))
    kind = ", ".join(f"{c} {boxes.schema[c].dataType.simpleString()}" for c in [*PAGE, *_CORNERS])

    def unite(batches):
        for batch in batches:
            lists = batch.column("boxes")
            flat = lists.flatten()
            listed = list(zip(*(x.to_pylist() for x in flat.flatten()), strict=True))
            at, out, first = [], [], 0
            for page, n in enumerate(lists.value_lengths().to_pylist()):
                united = joined_boxes(listed[first : first + n], dx, dy)
                out += united
                at += [page] * len(united)
                first += n
            keys = [batch.column(c).take(pa.array(at, pa.int64())) for c in PAGE]
            corners = [pa.array([b[i] for b in out], x.type) for i, x in enumerate(flat.flatten())]
            yield pa.RecordBatch.from_arrays([*keys, *corners], names=[*PAGE, *_CORNERS])

    return pages.mapInArrow(unite, kind)


def united_boxes(boxes: DataFrame, dx: float, dy: float) -> DataFrame:
    """Page and box of what is left when boxes of a page are united while any two lie within dx and dy.

    A united box reaches further than its parts, and still the result has no order: two near boxes are in one box at the
    end whichever pair goes first, as those that hold them are near as well. Pages with up to _AT_ONCE boxes are united
    each by itself. On others tasks unite what they have, and then all boxes go in rounds, so that no such page is one task.
    Boxes that are null or reversed or have no page are left out; equal boxes are one; no boxes give none."""
    ok = F.expr("x0 <= x1 and y0 <= y1 and doc_id is not null and page_no is not null")
    whole = stored(boxes.where(ok).select(*PAGE, *_CORNERS), "boxes")
    # NaN is greater than all here, but not in Python
    odd = F.bool_or(F.exists(F.array(*(F.col(c).cast("double") for c in _CORNERS)), F.isnan))
    crowded = whole.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n"), odd.alias("odd")).where(f"n > {_AT_ONCE} or odd").select(*PAGE)
    if crowded.isEmpty():
        return _united_pages(whole, dx, dy)
    crowded = stored(crowded, "crowded")
    few, many = (whole.join(crowded, PAGE, how) for how in ("left_anti", "left_semi"))
    return _united_pages(few, dx, dy).unionByName(_united_in_rounds(many, dx, dy))


def _united_in_rounds(boxes: DataFrame, dx: float, dy: float) -> DataFrame:
    """Boxes united in tasks and then in rounds: each joins that of its neighbours, itself included, whose hash is least, until none has a neighbour."""
    now = stored(_united_nearby(boxes.distinct(), dx, dy).distinct(), "united")
    number = 0
    while True:
        number += 1
        side = lambda p, by: [(F.col(c) + s * by * d).alias(f"{p}{c}") for c, s, d in (("x0", -1, dx), ("y0", -1, dy), ("x1", 1, dx), ("y1", 1, dy))]
        other = now.select(*PAGE, *side("o", 0), F.xxhash64(*_CORNERS, F.lit(number)).alias("rank"))
        met = boxes_meeting(now.select("*", *side("w", 1)), other, [("wx0", "wx1"), ("wy0", "wy1")], [("ox0", "ox1"), ("oy0", "oy1")])
        least = met.groupBy(*PAGE, *_CORNERS).agg(F.min(F.struct("rank", *(f"o{c}" for c in _CORNERS))).alias("to"), F.count(F.lit(1)).alias("n"))
        least = stored(least, "nearest")
        if least.where("n > 1").isEmpty():
            return now
        grown = [F.least(F.min(c), F.first(f"to.o{c}")) if c.endswith("0") else F.greatest(F.max(c), F.first(f"to.o{c}")) for c in _CORNERS]
        now = stored(least.groupBy(*PAGE, "to").agg(*(g.alias(c) for g, c in zip(grown, _CORNERS, strict=True))).select(*PAGE, *_CORNERS).distinct(), "united")


def block_regions(blocks: DataFrame, dx: float = 15.0, dy: float = 8.0) -> DataFrame:
    """Text blocks of a page joined to regions of at least 30 by 15."""
    return united_boxes(blocks.where("block_type = 0"), dx, dy).where("x1 - x0 >= 30 and y1 - y0 >= 15")


def summary(regions: DataFrame) -> DataFrame:
    """Counts of regions, notes, tables, and tables by how they were found."""
    notes = F.col("table_type").isin("general_notes", "legend", "specifications")
    by = lambda s: F.count_if(~notes & F.col("detection_strategy").startswith(s))
    return regions.agg(F.count(F.lit(1)).alias("n_regions"), F.count_if(notes).alias("n_notes"), F.count_if(~notes).alias("n_tables"), by("vector").alias("n_vector"), by("text").alias("n_text"))
