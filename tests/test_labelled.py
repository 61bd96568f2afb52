"""Labelled regions: their own fields, and the regions found in their place."""

import json
import random

from tabulith import tune
from tabulith.operators import labelled
from tabulith.sources import stores

FOUND = "doc_id long, page_no long, region_index long, x0 double, y0 double, x1 double, y1 double"
LABELS = FOUND.replace("region_index", "label_index")


def _overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0.0) * max(h, 0.0)
    whole = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / whole if whole else 0.0


def _one_by_one(found, labels, least):
    out = []
    for page in {f[:2] for f in found}:
        pairs = sorted((-_overlap(f[3:], n[3:]), f[2], n[2]) for f in found for n in labels if f[:2] == n[:2] == page)
        used, named = set(), set()
        for less, f, n in pairs:
            if less < 0 and -less >= least and f not in used and n not in named:
                used.add(f)
                named.add(n)
                out.append((*page, f, n, -less))
    return sorted(out)


def test_matches_are_those_of_one_pass(spark):
    """Pages crowded so that most pairs are ruled out by others, with many ties; a chain of pairs, each better than the one before."""
    dice = random.Random(5)
    box = lambda: (lambda x, y: (x, y, x + dice.choice((20.0, 30.0, 40.0)), y + dice.choice((20.0, 30.0))))(10.0 * dice.randrange(12), 10.0 * dice.randrange(8))
    found = [(d, 1, i, *box()) for d in range(6) for i in range(60)]
    labels = [(d, 1, i, *box()) for d in range(6) for i in range(50)]
    found += [(7, 2, i, 10.0 * i, 0.0, 10.0 * i + 100, 10.0) for i in range(15)]
    labels += [(7, 2, i, 10.0 * i + 5 - i * 0.125, 0.0, 10.0 * i + 105 - i * 0.125, 10.0) for i in range(15)]
    for least in (0.0, 0.3):
        got = labelled.match_labels(spark.createDataFrame(found, FOUND), spark.createDataFrame(labels, LABELS), least).collect()
        assert sorted(map(tuple, got)) == _one_by_one(found, labels, least) and len(got) > 150


def test_odd_boxes_match_nothing(spark):
    odd = [(1, 1, 0, None, 0.0, 1.0, 1.0), (1, 1, 1, 5.0, 0.0, 1.0, 1.0), (1, 1, 2, 3.0, 3.0, 3.0, 3.0), (None, 1, 3, 0.0, 0.0, 9.0, 9.0)]
    assert labelled.match_labels(spark.createDataFrame(odd, FOUND), spark.createDataFrame(odd, LABELS), 0.0).count() == 0
    assert labelled.match_labels(spark.createDataFrame([], FOUND), spark.createDataFrame(odd, LABELS)).count() == 0


def _region(keep, **fields):
    return {"label": "t", "expected_keep": keep, "bbox": {"x0": 1, "y0": 2, "x1": 3, "y1": 4}, "structure_source": "vector_grid", "header_texts": ["Ref No."], "row_count": 1, "col_count": 2} | fields


def test_labels_by_their_own_fields(spark, tmp_path):
    zone = {"x0": 2, "y0": 4, "x1": 9, "y1": 9}
    pages = [
        {"source_pdf": "p", "title_block_zone": zone, "candidates": [_region(True), _region(False, bbox={"x0": -1, "y0": 2, "x1": 3, "y1": 4}), _region(True)]},
        {"source_pdf": "q", "candidates": [_region(True, structure_source="none", header_texts=[], row_count=None), _region(None), _region(False, bbox=None, header_texts=None, nearby_title_regex_hit=True), _region(False, header_texts=[None, "xyzzy", "Rev"])]},
    ]
    for p in pages:
        (tmp_path / f"{p['source_pdf']}.json").write_text(json.dumps(p))
    labels = stores.load_labelled(spark, str(tmp_path))
    got = {(r.source_pdf, r.i): r for r in labelled.labelled_regions(labels).collect()}
    assert {k: (r.in_zone, r.structured, r.title_hit, r.row_count, r.expected) for k, r in got.items()} == {
        ("p", 0): (True, True, False, 1, True), ("p", 1): (False, True, False, 1, False), ("p", 2): (True, True, False, 1, True),
        ("q", 0): (False, False, False, 0, True), ("q", 2): (False, True, True, 1, False), ("q", 3): (False, True, False, 1, False),
    }
    assert got["p", 0].allow_score == 100.0 and got["q", 0].allow_score == got["q", 2].deny_score == 0.0 and got["q", 3].deny_score == 100.0
    store = spark.createDataFrame([("xyzzi", "c")], "term string, category string")
    stored = {(r.source_pdf, r.i): r.allow_score for r in labelled.labelled_regions(labels, allow=store).collect()}
    assert stored["q", 3] == 80.0 and stored["p", 0] < 75 and stored["q", 0] == 0.0
    told = tune.report(labels, "f1", 2)
    assert told[0] == "6 labelled regions of 2 sources: too few to tell settings apart" and told[1].split(" settings")[0].endswith("of 6561") and len(told) == 4
    assert tune.report(labels.where("false")) == ["no labelled regions"]


def test_a_label_without_a_region(spark):
    found = spark.createDataFrame([(1, 1, 4, 0.0, 0.0, 10.0, 10.0, 90.0, 0.0, True, False, True, 2, 3)], f"{FOUND}, allow_score double, deny_score double, structured boolean, in_zone boolean, title_hit boolean, row_count long, col_count long")
    labels = spark.createDataFrame([(1, 1, 0, 0.0, 0.0, 10.0, 9.0, True), (1, 1, 1, 0.0, 0.0, 10.0, 5.0, False), (2, 1, 0, 0.0, 0.0, 10.0, 9.0, True)], f"{LABELS}, expected boolean")
    got = sorted((r.doc_id, r.label_index, r.expected, r.region_index, r.allow_score, r.structured, r.row_count) for r in labelled.labelled_found(found, labels).collect())
    assert got == [(1, 0, True, 4, 90.0, True, 2), (1, 1, False, None, 0.0, False, 0), (2, 0, True, None, 0.0, False, 0)]
