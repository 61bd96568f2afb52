"""Boxes and points of one page that meet, in one or two directions: a join on pages, or on tiles.

On a page with up to FEW boxes, all that stands there is met with each of them: that is at most FEW times the input,
and rows that lie together by page already are not moved. On the other pages both sides are dealt to tiles of their page and met there, so that neither a crowded page nor a large
one is a task of its own, and no pair of a page is looked at that is not near. Tiles are as large as the
boxes are on average, so a box lies in about four, and what stands in them is about four times what
stands in the box; they are never so small that all boxes together span over MOST_TILES.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulith.storage import not_sent, stored

PAGE = ["doc_id", "page_no"]
#: Tiles that the boxes of all pages may span in a direction: a page-wide box among small ones covers no more.
MOST_TILES = 256
#: Boxes of a page up to which what stands there is met with each of them.
FEW = 16

#: For each direction a box's columns: from, to. For a point its column.
Box = list[tuple[str, str]]


def _tiling(boxes: DataFrame, box: Box) -> list[tuple[float, float, float]]:
    """For each direction the tiles' size and the extent of all boxes, by one aggregate over them."""
    each = [f(c) for a, z in box for c, f in ((F.col(z) - F.col(a), F.avg), (F.col(a), F.min), (F.col(z), F.max))]
    found = boxes.agg(*(x.alias(f"x{i}") for i, x in enumerate(each))).first()
    out = []
    for i in range(0, len(each), 3):
        mean, low, high = (v if v is not None else 0.0 for v in found[i : i + 3])
        out.append((float(max(mean, (high - low) / MOST_TILES, 1e-3)), float(low), float(high)))
    return out


def _whole(box: Box) -> Column:
    """Whether a box has all its coordinates, in order."""
    ok = F.lit(True)
    for a, z in box:
        ok = ok & (F.col(a) <= F.col(z))
    return ok


def _tile(x: Column, size: float) -> Column:
    return F.floor(x / size)


def _dealt(df: DataFrame, box: Box, tiling: list[tuple[float, float, float]]) -> DataFrame:
    """df with a row for each tile that its box, cut to the extent, covers: __t0, __t1."""
    for i, ((a, z), (size, low, high)) in enumerate(zip(box, tiling, strict=True)):
        first, last = _tile(F.greatest(F.col(a), F.lit(low)), size), _tile(F.least(F.col(z), F.lit(high)), size)
        df = df.withColumn(f"__t{i}", F.explode(F.sequence(first, last)))
    return df


def _tiles(box: Box) -> list[str]:
    return [f"__t{i}" for i in range(len(box))]


def _by_crowd(boxes: DataFrame, per: list[str], simple, tiled, crowd: DataFrame | None = None) -> DataFrame:
    """simple(boxes) of pages with up to FEW boxes, and tiled(boxes) of those with more, if there are any; the rows of ``crowd`` are counted if it is given."""
    crowded = (boxes if crowd is None else crowd).groupBy(*per).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > FEW).drop("__n")
    if crowded.isEmpty():
        return simple(boxes)
    crowded = stored(crowded, "crowded")
    return simple(not_sent(boxes.join(crowded, per, "left_anti"))).unionByName(tiled(boxes.join(crowded, per, "left_semi")))


def points_in(boxes: DataFrame, points: DataFrame, box: Box, at: list[str], per: list[str] = PAGE, crowd: DataFrame | None = None) -> DataFrame:
    """boxes joined with the points of their page that they hold, borders included; columns of both.

    ``crowd`` tells by its rows which pages are crowded: the points if they are fewer, or what boxes of some cost are made from.
    Boxes and points without coordinates meet nothing, nor do boxes that end before they begin. Repeated rows meet again."""
    def tiled(whole: DataFrame) -> DataFrame:
        tiling = _tiling(whole, box)
        near = points
        for c, (size, low, high) in zip(at, tiling, strict=True):
            near = near.where(F.col(c).between(low, high))
        near = near.withColumns({f"__t{i}": _tile(F.col(c), size) for i, (c, (size, _, _)) in enumerate(zip(at, tiling, strict=True))})
        return held(_dealt(whole, box, tiling).join(near, [*per, *_tiles(box)])).drop(*_tiles(box))

    def held(met: DataFrame) -> DataFrame:
        for (a, z), c in zip(box, at, strict=True):
            met = met.where(F.col(c).between(F.col(a), F.col(z)))
        return met

    return _by_crowd(boxes.where(_whole(box)), per, lambda few: held(few.join(points, per)), tiled, crowd)


def boxes_meeting(boxes: DataFrame, others: DataFrame, box: Box, other: Box, per: list[str] = PAGE, crowd: DataFrame | None = None) -> DataFrame:
    """boxes joined with the other boxes of their page that they touch or overlap; columns of both.

    ``crowd`` tells by its rows which pages are crowded, if not by the boxes themselves.
    Two boxes share many tiles: their pair is taken in the one that holds the corner where their common part begins.
    Boxes without coordinates, or that end before they begin, meet nothing. Repeated rows meet again."""
    others = others.where(_whole(other))

    def tiled(whole: DataFrame) -> DataFrame:
        tiling = _tiling(whole, box)
        near = others
        for (a, z), (_, low, high) in zip(other, tiling, strict=True):
            near = near.where((F.col(a) <= high) & (F.col(z) >= low))
        met = _dealt(whole, box, tiling).join(_dealt(near, other, tiling), [*per, *_tiles(box)])
        for i, ((a, _), (b, _), (size, _, _)) in enumerate(zip(box, other, tiling, strict=True)):
            met = met.where(F.col(f"__t{i}") == _tile(F.greatest(a, b), size))
        return touching(met).drop(*_tiles(box))

    def touching(met: DataFrame) -> DataFrame:
        for (a, z), (b, y) in zip(box, other, strict=True):
            met = met.where((F.col(a) <= F.col(y)) & (F.col(b) <= F.col(z)))
        return met

    return _by_crowd(boxes.where(_whole(box)), per, lambda few: touching(few.join(others, per)), tiled, crowd)
