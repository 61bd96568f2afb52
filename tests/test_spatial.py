"""Tile joins and the cut of text rows against versions over all pairs and whole pages."""

import random
import time

from pyspark.sql import functions as F

from tabulith.operators import geometry
from tabulith.operators.spatial import boxes_meeting, points_in

AREA, SPAN = [("x0", "x1"), ("y0", "y1")], [("a0", "a1"), ("b0", "b1")]


def _boxes(rng, n, size):
    out = []
    for i in range(n):
        x, y = rng.choice([rng.uniform(-50, 900), float(rng.randint(-5, 90) * 10)]), float(rng.randint(0, 60) * 10)
        w, h = rng.choice([0.0, 10.0, rng.uniform(0, size), 2000.0 if i % 40 == 0 else 5.0]), rng.choice([0.0, 10.0, rng.uniform(0, 2 * size), 300.0])
        out.append((rng.randint(1, 2), 1, i, x, y, x + w, y + h) if i % 19 else (1, 1, i, rng.choice([None, x]), y, x - 1, y))
    return out


def _ok(b):
    return None not in b and b[3] <= b[5] and b[4] <= b[6]


def test_points_in(spark):
    rng = random.Random(4)
    boxes = [*_boxes(rng, 300, 80), (1, 1, 900, 0.0, 0.0, 10.0, 10.0), (1, 1, 900, 0.0, 0.0, 10.0, 10.0), (7, 1, 901, 0.0, 0.0, 10.0, 10.0)]
    points = [(rng.randint(1, 2), 1, i, float(rng.randint(-10, 95) * 10), float(rng.randint(0, 61) * 10)) for i in range(500)] + [(1, 1, 600, None, 1.0), (1, 1, 601, 1.0, None)]
    b = spark.createDataFrame(boxes, "doc_id long, page_no long, box long, x0 double, y0 double, x1 double, y1 double")
    p = spark.createDataFrame(points, "doc_id long, page_no long, point long, cx double, cy double")
    got = sorted((r.box, r.point) for r in points_in(b, p, AREA, ["cx", "cy"]).collect())
    want = sorted((x[2], q[2]) for x in boxes if _ok(x) for q in points if None not in q and x[0] == q[0] and x[3] <= q[3] <= x[5] and x[4] <= q[4] <= x[6])
    assert got == want and len(want) > 150
    flat = sorted((r.box, r.point) for r in points_in(b.where("x0 <= x1 and y0 <= y1"), p.where("cy is not null"), AREA[:1], ["cx"]).collect())
    assert flat == sorted((x[2], q[2]) for x in boxes if _ok(x) for q in points if None not in q and x[0] == q[0] and x[3] <= q[3] <= x[5])
    assert points_in(b.where("false"), p, AREA, ["cx", "cy"]).count() == points_in(b, p.where("false"), AREA, ["cx", "cy"]).count() == 0


def test_boxes_meeting(spark):
    rng = random.Random(5)
    left, right = _boxes(rng, 200, 90), _boxes(rng, 260, 30)
    a = spark.createDataFrame(left, "doc_id long, page_no long, one long, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame(right, "doc_id long, page_no long, two long, a0 double, b0 double, a1 double, b1 double")
    meet = lambda x, y, d: all(x[3 + i] <= y[5 + i] and y[3 + i] <= x[5 + i] for i in range(d))
    for d in (1, 2):
        got = sorted((r.one, r.two) for r in boxes_meeting(a.where("x0 <= x1 and y0 <= y1"), b.where("a0 <= a1 and b0 <= b1"), AREA[:d], SPAN[:d]).collect())
        want = sorted((x[2], y[2]) for x in left if _ok(x) for y in right if _ok(y) and x[0] == y[0] and meet(x, y, d))
        assert got == want and len(set(want)) == len(want) > 100
    assert boxes_meeting(a, b, AREA, SPAN).count() == len([1 for x in left if _ok(x) for y in right if _ok(y) and x[0] == y[0] and meet(x, y, 2)])
    assert boxes_meeting(a, b.where("false"), AREA, SPAN).count() == boxes_meeting(a.where("false"), b, AREA, SPAN).count() == 0


def test_a_crowded_page_ends_in_seconds(spark):
    """A page of 100,000 words and 1,000 areas: as many rows as pairs, which are few beside all."""
    words = spark.range(100_000).select(F.lit(1).alias("doc_id"), F.lit(1).alias("page_no"), F.col("id").alias("word_seq"), (F.col("id") % 400 * 6.0).alias("cx"), (F.floor(F.col("id") / 400) * 10.0).alias("cy"))
    areas = spark.range(1000).select(F.lit(1).alias("doc_id"), F.lit(1).alias("page_no"), F.col("id").alias("area"), (F.col("id") % 40 * 60.0).alias("x0"), (F.floor(F.col("id") / 40) * 100.0).alias("y0"))
    areas = areas.withColumns({"x1": F.col("x0") + 54.0, "y1": F.col("y0") + 90.0})
    began = time.time()
    assert points_in(areas, words, AREA, ["cx", "cy"]).groupBy("area").count().where("count = 100").count() == 1000
    assert time.time() - began < 20


def _rows_of(words, tolerance):
    """Rows by a plain loop over each page."""
    out, row, page, total, n = {}, -1, None, 0.0, 0
    for doc, cy, seq in sorted((w[0], (w[4] + w[6]) / 2, w[2]) for w in words):
        if doc != page:
            page, row, n = doc, -1, 0
        if n and abs(cy - total / n) <= tolerance:
            total, n = total + cy, n + 1
        else:
            row, total, n = row + 1, cy, 1
        out[doc, seq] = row
    return out


def test_text_rows(spark):
    rng = random.Random(6)
    words = []
    for doc in range(6):
        for i in range(rng.choice([1, 40, 400])):
            y = rng.choice([float(rng.randint(0, 60) * 6), rng.uniform(0, 400), float(rng.randint(0, 200) * 2)])
            words.append((doc, 1, i, 0.0, y, 5.0, y + 8, "w"))
    df = spark.createDataFrame(words, "doc_id long, page_no long, word_seq long, x0 double, y0 double, x1 double, y1 double, text string").repartition(5)
    for tolerance in (0.0, 2.0, 6.0):
        assert {(r.doc_id, r.word_seq): r.row for r in geometry.text_rows(df, tolerance).collect()} == _rows_of(words, tolerance)
    assert geometry.text_rows(df.where("false")).count() == 0
