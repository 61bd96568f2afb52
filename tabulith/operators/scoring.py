"""Titles, header dictionaries, region scores, their evaluation and tuning."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.functions import vocab
from tabulith.functions.text import normalised, title_type, token_sort_ratio
from tabulith.functions.words import best_alias
from tabulith.operators.spatial import PAGE, boxes_meeting
from tabulith.storage import importable, sent_if_few, stored

REGION = ["doc_id", "region_index"]


def anchors(blocks: DataFrame, notes: bool = False) -> DataFrame:
    """Text blocks that are titles, with their type, which is found once a block (exploded) and not again by the filter."""
    t = blocks.where("block_type = 0").select("*", F.explode(F.array(title_type(F.col("text"), notes))).alias("table_type"))
    return t.where("table_type is not null")


def header_fields(headers: DataFrame) -> DataFrame:
    """headers(raw_header) with canonical_field where the text is an alias, the first of equals."""
    first = {}
    for field, aliases in vocab.HEADER_ALIASES.items():
        for a in aliases:
            first.setdefault(a, field)
    table = F.create_map(*map(F.lit, chain.from_iterable(first.items())))
    return headers.withColumn("canonical_field", F.try_element_at(table, normalised(F.col("raw_header"))))


def header_fields_fuzzy(headers: DataFrame) -> DataFrame:
    """headers(raw_header) with canonical_field by alias, or by the best alias that is near enough.

    Each distinct header is matched once, and few of them are sent to where the many are; the literal aliases travel with the function."""
    importable(headers.sparkSession)
    aliases: dict[str, str] = {}
    for field, names in vocab.HEADER_ALIASES.items():
        for a in names:
            aliases.setdefault(a, field)
    distinct = headers.select(F.col("raw_header").alias("h")).distinct().withColumn("canonical_field", best_alias(aliases)(normalised(F.col("h"))))
    distinct = sent_if_few(stored(distinct, "fields"))
    return headers.join(distinct, F.col("raw_header").eqNullSafe(F.col("h")), "left").drop("h")


def dictionary_hits(headers: DataFrame, terms: dict[str, tuple[str, ...]]) -> DataFrame:
    """Each distinct header with its best term: term, category, score; the first of equals.

    The dictionary is a literal array, so distinct headers are scored without a join."""
    entries = F.array(*(F.struct(F.lit(-i).alias("ord"), F.lit(t).alias("term"), F.lit(c).alias("category")) for i, (c, t) in enumerate((c, t) for c, ts in terms.items() for t in ts)))
    scored = F.transform(entries, lambda e: F.struct(token_sort_ratio(F.col("header"), e["term"]).alias("score"), e["ord"].alias("ord"), e["term"].alias("term"), e["category"].alias("category")))
    best = headers.select("header").distinct().withColumn("b", F.array_max(scored))
    return best.select("header", F.col("b.term").alias("term"), F.col("b.category").alias("category"), F.col("b.score").alias("score"))


def region_scores(regions: DataFrame, weights: dict[str, float] | None = None, threshold: float = vocab.CONFIDENCE_THRESHOLD) -> DataFrame:
    """regions(allow_score, deny_score, structured, in_zone, title_hit, row_count, col_count) with confidence and keep."""
    w = vocab.WEIGHTS | (weights or {})
    on = lambda cond, name: F.when(cond, F.lit(w[name])).otherwise(0)
    shape = F.when((F.col("row_count") == 0) | (F.col("col_count") == 0), 0).when(F.col("col_count") >= 5, -w["shape_sanity"]).otherwise(w["shape_sanity"])
    least = vocab.FUZZY_THRESHOLD
    total = on(F.col("structured"), "structure_found") + on(F.col("allow_score") >= least, "allow_list") + on(F.col("deny_score") >= least, "deny_list") + on(F.col("in_zone"), "inside_title_block") + on(F.col("title_hit"), "nearby_title") + shape
    return regions.withColumn("confidence", total.cast("long")).withColumn("keep", F.col("confidence") >= threshold)


def metrics(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Confusion counts of keep against expected, and accuracy, precision, recall, f1; 0 where undefined."""
    n = lambda a, b: F.count_if((F.col("keep") == a) & (F.col("expected") == b))
    m = scored.groupBy(*keys).agg(n(True, True).alias("tp"), n(True, False).alias("fp"), n(False, False).alias("tn"), n(False, True).alias("fn"))
    return _with_ratios(m)


def _with_ratios(m: DataFrame) -> DataFrame:
    """Confusion counts with accuracy, precision, recall, f1; 0 where undefined."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    m = m.withColumn("accuracy", ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))).withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return m.withColumn("f1", ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


#: Values of each weight and threshold that a grid search tries, in product order.
DEFAULT_GRID = {
    "structure_found": (20, 40, 60), "allow_list": (30, 45, 60), "deny_list": (-90, -70, -50), "inside_title_block": (-50, -30, -15),
    "nearby_title": (5, 15, 25), "shape_sanity": (5, 10, 15), "confidence_threshold": (30, 50, 70), "fuzzy_threshold": (75, 85, 95),
}


def grid_search(regions: DataFrame, grid: dict[str, tuple[float, ...]] | None = None, metric: str = "accuracy") -> DataFrame:
    """Every setting of a grid over all eight parameters with its confusion counts and metrics: combo_id, the parameters,
    tp, fp, tn, fn, accuracy, precision, recall, f1; best metric first, product order on ties.

    Takes regions like region_scores, with expected. Regions are first counted by what settings can tell apart, for
    each fuzzy threshold: settings then meet at most 2 ** 6 x 3 rows each. Without regions all metrics are 0."""
    grid = DEFAULT_GRID | (grid or {})
    names = list(grid)
    spark = regions.sparkSession
    combos = spark.range(1).select(F.lit(0).cast("long").alias("combo_id"))
    for name, values in grid.items():
        each = F.posexplode(F.array(*(F.lit(float(v)) for v in values))).alias("i", name)
        combos = combos.select("*", each).withColumn("combo_id", F.col("combo_id") * len(values) + F.col("i")).drop("i")
    hit = lambda c: F.coalesce(F.col(c) >= F.col("least"), F.lit(False))
    shape = F.when((F.col("row_count") == 0) | (F.col("col_count") == 0), 0).when(F.col("col_count") >= 5, -1).otherwise(1)
    least = F.explode(F.array(*(F.lit(float(v)) for v in dict.fromkeys(grid["fuzzy_threshold"])))).alias("least")
    flags = regions.select("*", least).select("least", "structured", hit("allow_score").alias("allow"), hit("deny_score").alias("deny"), "in_zone", "title_hit", shape.alias("shape"), "expected")
    kinds = flags.groupBy(*flags.columns).agg(F.count(F.lit(1)).alias("n"))
    on = lambda f, w: F.when(F.col(f), F.col(w)).otherwise(0.0)
    total = on("structured", "structure_found") + on("allow", "allow_list") + on("deny", "deny_list") + on("in_zone", "inside_title_block") + on("title_hit", "nearby_title") + F.col("shape") * F.col("shape_sanity")
    met = combos.join(F.broadcast(kinds), F.col("fuzzy_threshold") == F.col("least"), "left").withColumn("keep", total >= F.col("confidence_threshold"))
    n = lambda a, b: F.coalesce(F.sum(F.when((F.col("keep") == a) & (F.col("expected") == b), F.col("n"))), F.lit(0))
    counted = met.groupBy("combo_id", *names).agg(n(True, True).alias("tp"), n(True, False).alias("fp"), n(False, False).alias("tn"), n(False, True).alias("fn"))
    return _with_ratios(counted).orderBy(F.desc(metric), "combo_id")


def search_summary(found: DataFrame, regions: DataFrame, metric: str = "accuracy", source_col: str = "doc_id") -> DataFrame:
    """One row: n_sources (distinct sources of the labelled regions), n_settings, best (the top value of the metric), n_best (settings that reach it)."""
    top = found.groupBy(F.col(metric).alias("best")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("best", "n")).alias("t"), F.sum("n").alias("n_settings"))
    return top.crossJoin(regions.agg(F.countDistinct(source_col).alias("n_sources"))).select("n_sources", "n_settings", "t.best", F.col("t.n").alias("n_best"))


def title_zones(rects: DataFrame, fraction: float = 0.28) -> DataFrame:
    """The largest rectangle of each page that lies mostly in the right margin, the first of equals."""
    edge = F.col("width") * (1 - fraction)
    inside = F.greatest(F.lit(0.0), F.col("x1") - F.greatest("x0", edge)) / F.greatest(F.lit(1.0), F.col("x1") - F.col("x0"))
    area = F.greatest(F.lit(0.0), F.col("x1") - F.col("x0")) * F.greatest(F.lit(0.0), F.col("y1") - F.col("y0"))
    best = rects.where(inside > 0.6).groupBy("doc_id", "page_no").agg(F.max_by(F.struct("x0", "y0", "x1", "y1"), F.struct(area, -F.col("drawing_seq"))).alias("b"))
    return best.select("doc_id", "page_no", "b.*")


def uncovered(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """Text blocks that overlap no region of their page; those that only touch one at a border stay, as do those without a number."""
    texts = blocks.where("block_type = 0")
    areas = regions.select(*PAGE, *(F.col(c).alias(f"r{c}") for c in ("x0", "y0", "x1", "y1")))
    met = boxes_meeting(areas, texts.select(*PAGE, "block_seq", "x0", "y0", "x1", "y1"), [("rx0", "rx1"), ("ry0", "ry1")], [("x0", "x1"), ("y0", "y1")])
    touched = met.where("x0 < rx1 and rx0 < x1 and y0 < ry1 and ry0 < y1").select(*PAGE, "block_seq").distinct()
    return texts.join(touched, [*PAGE, "block_seq"], "left_anti")


def nearby_titles(regions: DataFrame, blocks: DataFrame, margin: float = 40.0) -> DataFrame:
    """regions with the first title in block order that touches them within the margin."""
    titles = anchors(blocks, notes=True).select("doc_id", "page_no", F.col("block_seq"), F.col("text").alias("title"), *(F.col(c).alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")))
    keys = [*REGION, "page_no"]
    wide = regions.select(*keys, *((F.col(c) + s * margin).alias(f"w{c}") for c, s in (("x0", -1), ("y0", -1), ("x1", 1), ("y1", 1))))
    near = boxes_meeting(wide, titles, [("wx0", "wx1"), ("wy0", "wy1")], [("bx0", "bx1"), ("by0", "by1")]).where("bx0 < wx1 and wx0 < bx1 and by0 < wy1 and wy0 < by1")
    best = near.groupBy(*keys).agg(F.min_by("title", "block_seq").alias("title"))
    return regions.select(*keys).join(best, keys, "left")
