"""How the bridge's rows are dealt, how large the methods made for them are, and joins on pages with few boxes."""

import re

from pyspark.sql import functions as F

from tabulith.operators import spatial
from tabulith.plans.registry import QUERIES
from tabulith.sources import bridge
from tests.conftest import DATA

AREA = [("x0", "x1"), ("y0", "y1")]


def test_tasks_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(bridge, "DEALT", {"lineitem": ("l_orderkey", 200), "orders": ("o_orderkey", 50)})
    for sql in (bridge.SEGMENT, bridge.BLOCK):
        found = bridge.relation(spark, str(DATA / "sf0.001"), sql)
        sizes = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(sizes) >= 20 and max(r["count"] for r in sizes) < found.count() / 8


def test_methods_are_small_enough_to_be_compiled(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("table_bounds", "grid_cells"):
            df = QUERIES[name][0](spark, str(DATA / "sf0.001"))
            text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_pages_with_few_boxes_need_no_tiles(spark, monkeypatch):
    """Pages with up to FEW boxes are met as they are; with a crowded page beside them nothing is lost or met twice."""
    boxes = [(d, 1, i, float(i), 0.0, i + 2.5, 5.0) for d, n in ((1, spatial.FEW), (2, spatial.FEW + 1), (3, 1)) for i in range(n)]
    points = [(d, 1, i, i / 2, 5.0) for d in (1, 2, 3, 4) for i in range(60)]
    b = spark.createDataFrame(boxes, "doc_id long, page_no long, box long, x0 double, y0 double, x1 double, y1 double")
    p = spark.createDataFrame(points, "doc_id long, page_no long, point long, cx double, cy double")
    want = sorted((x[0], x[2], q[2]) for x in boxes for q in points if x[0] == q[0] and x[3] <= q[3] <= x[5])
    assert sorted((r.doc_id, r.box, r.point) for r in spatial.points_in(b, p, AREA, ["cx", "cy"]).collect()) == want
    other = p.select("doc_id", "page_no", "point", F.col("cx").alias("a0"), F.col("cx").alias("a1"), F.lit(4.0).alias("b0"), F.lit(9.0).alias("b1"))
    met = spatial.boxes_meeting(b, other, AREA, [("a0", "a1"), ("b0", "b1")])
    assert sorted((r.doc_id, r.box, r.point) for r in met.collect()) == want
    monkeypatch.setattr(spatial, "_tiling", None)
    few = b.where("doc_id <> 2")
    assert spatial.points_in(few, p, AREA, ["cx", "cy"]).count() == len([x for x in want if x[0] != 2])
