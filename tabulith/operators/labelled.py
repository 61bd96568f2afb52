"""Labelled regions of files: what a score needs of them, and which found regions they are.

Labels come as ``stores.load_labelled`` gives them: a region's fields, its page's title block, and whether it is to
be kept. Either their own fields are scored, or those of the region found in their place."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulith.functions import vocab
from tabulith.operators.scoring import dictionary_hits
from tabulith.operators.similarity import best_terms
from tabulith.operators.spatial import PAGE, boxes_meeting
from tabulith.storage import stored

BOX = ("x0", "y0", "x1", "y1")
#: What a score reads of a region.
SIGNALS = ("allow_score", "deny_score", "structured", "in_zone", "title_hit", "row_count", "col_count")
LABEL = ["file", "source_pdf", "i"]
#: Sources of structure that count as found.
STRUCTURES = ("vector_grid", "text_clustering")
#: Least score of a term that a store is asked for: no setting of a grid goes below it.
LEAST = 50.0


def header_scores(regions: DataFrame, key: list[str], allow: DataFrame | None = None, deny: DataFrame | None = None, least: float = LEAST) -> DataFrame:
    """key, allow_score and deny_score of regions(key, header_texts): the best term of any header, 0 without one.

    Distinct headers are scored once, against the own dictionaries or loaded stores(term, category); a store's terms
    under ``least`` count as 0."""
    heads = regions.select(*key, F.explode("header_texts").alias("header")).where("header is not null")
    distinct = stored(heads.select("header").distinct(), "label-headers")
    scored = distinct
    for name, store, own in (("allow_score", allow, vocab.ALLOW), ("deny_score", deny, vocab.DENY)):
        hits = dictionary_hits(distinct, own) if store is None else best_terms(distinct, store, least)
        scored = scored.join(hits.select("header", F.coalesce("score", F.lit(0.0)).alias(name)), "header", "left")
    # a header that many regions have is joined on the regions' side of a small table of distinct headers
    best = heads.join(scored, "header").groupBy(*key).agg(F.max("allow_score").alias("allow_score"), F.max("deny_score").alias("deny_score"))
    return regions.select(*key).join(best, key, "left").fillna(0.0, ["allow_score", "deny_score"])


def labelled_regions(labels: DataFrame, allow: DataFrame | None = None, deny: DataFrame | None = None) -> DataFrame:
    """Labels by their own fields: file, source_pdf, i, label, the signals of a score, expected; for region_scores() and grid_search().

    Without a title block or a box a label is in none; missing counts are 0 and a missing hit is none. Labels that do
    not say whether to keep them are left out; repeated ones count again."""
    known = stored(labels.where("expected_keep is not null").withColumn("__n", F.monotonically_increasing_id()), "labels")
    slack = 2.0
    inside = [F.col(f"bbox.{c}") >= F.col(f"title_block_zone.{c}") - slack for c in ("x0", "y0")] + [F.col(f"bbox.{c}") <= F.col(f"title_block_zone.{c}") + slack for c in ("x1", "y1")]
    or_not = lambda c: F.coalesce(c, F.lit(False))
    told = known.withColumns({
        "structured": or_not(F.col("structure_source").isin(*STRUCTURES)), "in_zone": or_not(reduce(and_, inside)), "title_hit": or_not(F.col("nearby_title_regex_hit")),
        "expected": F.col("expected_keep"), **{c: F.coalesce(c, F.lit(0)).cast("long") for c in ("row_count", "col_count")},
    })
    return told.join(header_scores(known, ["__n"], allow, deny), "__n").select(*LABEL, "label", *SIGNALS, "expected")


def _overlap(a: str, b: str) -> Column:
    """What two boxes share of their common area."""
    side = lambda x, y: F.least(f"{a}{y}", f"{b}{y}") - F.greatest(f"{a}{x}", f"{b}{x}")
    area = lambda p: (F.col(f"{p}x1") - F.col(f"{p}x0")) * (F.col(f"{p}y1") - F.col(f"{p}y0"))
    both = F.greatest(side("x0", "x1"), F.lit(0.0)) * F.greatest(side("y0", "y1"), F.lit(0.0))
    return F.try_divide(both, area(a) + area(b) - both)


def match_labels(found: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, page_no, region_index, label_index, overlap: regions and labels of a page, one to one.

    Takes found(doc_id, page_no, region_index, box) and labels(doc_id, page_no, label_index, box). Pairs go by overlap
    (intersection over union, at least ``least``, over 0), then region_index, then label_index; a pair is taken unless one
    of its two is. In rounds: what is the first pair of both its region and its label is taken, and rules out the others
    of either, until none is left. Boxes that are null, reversed or without area match nothing; numbers must be unique on a page."""
    one, other = ("region_index", "f"), ("label_index", "l")
    side = lambda df, n, p: df.select(*PAGE, n, *(F.col(c).alias(f"{p}{c}") for c in BOX))
    met = boxes_meeting(side(found, *one), side(labels, *other), [("fx0", "fx1"), ("fy0", "fy1")], [("lx0", "lx1"), ("ly0", "ly1")])
    near = met.withColumn("overlap", _overlap("f", "l")).where((F.col("overlap") >= least) & (F.col("overlap") > 0))
    left, taken = stored(near.select(*PAGE, one[0], other[0], "overlap"), "pairs"), None
    while True:
        first = lambda k: F.row_number().over(Window.partitionBy(*PAGE, k).orderBy(F.desc("overlap"), one[0], other[0]))
        now = stored(left.withColumns({"a": first(one[0]), "b": first(other[0])}).where("a = 1 and b = 1").drop("a", "b"), "matched")
        taken = now if taken is None else taken.unionByName(now)
        rest = left
        for k in (one[0], other[0]):
            rest = rest.join(now.select(*PAGE, k), [*PAGE, k], "left_anti")
        left = stored(rest, "pairs")
        if left.isEmpty():
            return taken


def labelled_found(found: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Labels(doc_id, page_no, label_index, box, expected) with the signals of the region found in their place.

    found has a region's signals beside what match_labels() takes. A label without a region is one that no setting
    can keep by its signals: they are all false, the scores 0 and the counts 0. Regions without a label say nothing."""
    pairs = match_labels(found, labels, least).select(*PAGE, "region_index", "label_index")
    with_signals = pairs.join(found.select(*PAGE, "region_index", *SIGNALS), [*PAGE, "region_index"])
    out = labels.select(*PAGE, "label_index", "expected").join(with_signals, [*PAGE, "label_index"], "left")
    return out.fillna(0.0, ["allow_score", "deny_score"]).fillna(False, ["structured", "in_zone", "title_hit"]).fillna(0, ["row_count", "col_count"])
