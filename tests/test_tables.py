"""Pages to finished regions on small fixtures with known answers."""

import itertools
import json
import time

import pytest
from pyspark.sql import functions as F

from tabulith import storage
from tabulith.functions import vocab
from tabulith.operators import geometry as g
from tabulith.operators import regions as r
from tabulith.operators import scoring
from tabulith.operators import tables as t
from tabulith.sources import pages, sinks

WORD = "doc_id long, page_no long, word_seq long, x0 double, y0 double, x1 double, y1 double, text string"
SEGMENT = "doc_id long, page_no long, kind string, p1x double, p1y double, p2x double, p2y double"
BLOCK = "doc_id long, page_no long, block_seq long, x0 double, y0 double, x1 double, y1 double, text string, block_type long"
PAGES = "doc_id long, page_no long, width double, height double"


def _words(doc, rows, x0=100.0, y0=100.0, dx=60.0, dy=20.0, first=0):
    """Words 30 by 8 of a table's texts; those with a space are several words of one cell."""
    out = []
    for i, row in enumerate(rows):
        for j, text in enumerate(row):
            for k, part in enumerate(text.split()):
                out.append((doc, 1, first + len(out), x0 + dx * j + 4 + 15 * k, y0 + dy * i + 6, x0 + dx * j + 18 + 15 * k, y0 + dy * i + 14, part))
    return out


def _rules(doc, xs, ys, skip=()):
    flat = [(doc, 1, "l", xs[0], y, xs[-1], y) for y in ys]
    upright = [(doc, 1, "l", x, a, x, z) for x in xs for a, z in itertools.pairwise(ys) if (x, a) not in skip]
    return flat + upright


TABLE = [["Beam Mkd.", "Stirups", "Remarks"], ["B1", "2-T16+1-T12", "R1"], ["B2", "T10@150c/c", ""]]


@pytest.fixture(scope="module")
def sheet(spark):
    """Doc 1: a ruled table whose second divider misses the header, a title within it, notes below. Doc 2: the table
    without rulings. Doc 3: rulings around the header only. Doc 4: a title over nothing. Doc 5: no title."""
    xs, ys = [100.0, 160.0, 220.0, 280.0], [100.0, 120.0, 140.0, 160.0]
    words = [w for d in (1, 2, 3, 5) for w in _words(d, TABLE)]
    words += _words(1, [["COVER:"], ["COLUMN", "", "-", "40mm"], ["ALL", "DIMENSIONS", "IN", "MM"]], 100.0, 620.0, first=100)
    segments = _rules(1, xs, ys, {(220.0, 100.0)}) + _rules(3, xs, ys[:2]) + [(1, 1, "c", 0.0, 0.0, 9.0, 9.0)]
    title = lambda d, n, x, y, text, kind=0: (d, 1, n, x, y, x + 200, y + 10, text, kind)
    blocks = [title(d, 0, 90.0, 80.0, "SCHEDULE  OF\nBEAMS") for d in (1, 2, 3, 4)]
    blocks += [title(1, 1, 100.0, 125.0, "Weight Schedule"), title(1, 2, 100.0, 600.0, "GENERAL NOTES:"), title(1, 3, 500.0, 80.0, "Slab Schedule", 1), title(5, 0, 90.0, 80.0, "REVISION SCHEDULE")]
    pages = [(d, 1, 800.0, 1200.0) for d in range(1, 6)]
    make = spark.createDataFrame
    return make(blocks, BLOCK), make(words, WORD), make(segments, SEGMENT), make(pages, PAGES)


def test_extract_regions(sheet):
    got = {(x.doc_id, x.block_seq): x for x in t.extract_regions(*(df.withColumn("extra", F.lit(None).cast("string")) for df in sheet)).collect()}
    assert set(got) == {(1, 0), (1, 2), (2, 0), (3, 0)}
    one = got[1, 0]
    assert (one.table_type, one.region_type, one.detection_strategy, one.row_count, one.col_count) == ("beam_schedule", "schedule", "vector", 2, 3)
    assert tuple(one.source_region_bbox) == (95.0, 95.0, 285.0, 160.0)
    assert [(h.raw_header, h.canonical_field) for h in one.headers] == [("Beam Mkd.", "beam_mark"), ("Stirups", "stirrups"), ("Remarks", "remarks")]
    assert [(tuple(m.bbox), m.merge_type) for m in one.merged_header_cells] == [((160.0, 100.0, 280.0, 120.0), "horizontal")]
    assert [[c.raw_text for c in row.cells] for row in one.rows] == TABLE[1:]
    bars = [[None if c.normalized_value is None else [(v["count"], v.bar_type, v.spacing_mm) for v in c.normalized_value] for c in row.cells] for row in one.rows]
    assert bars == [[None, [(2, "T16", None), (1, "T12", None)], None], [None, [(None, "T10", 150)], None]]
    note = got[1, 2]
    assert (note.table_type, note.region_type, note.rows, note.row_count) == ("general_notes", "general_notes", None, None)
    assert [tuple(x) for x in note.notes] == [("note", "cover", "column", "40mm"), ("metadata", None, None, "ALL DIMENSIONS IN MM")]
    for doc in (2, 3):
        other = got[doc, 0]
        assert (other.detection_strategy, other.row_count, other.col_count, other.merged_header_cells) == ("text_clustering", 2, 3, [])
        assert [h.canonical_field for h in other.headers] == ["beam_mark", "stirrups", "remarks"] and [c.raw_text for c in other.rows[1].cells] == TABLE[2]
    tables = {(x.doc_id, x.block_seq) for x in t.extract_tables(*sheet).collect()}
    assert tables == {(1, 0), (1, 1), (2, 0), (3, 0)}


def test_empty_relations(sheet):
    none = [df.where("false") for df in sheet]
    assert t.extract_regions(*none).count() == 0 and t.extract_tables(*none).count() == 0
    drawings = none[0].select("doc_id", "page_no", F.col("block_seq").alias("drawing_seq"), "x0", "y0", "x1", "y1")
    assert t.extract_confident(*none[:3], drawings, none[3]).count() == 0


def test_null_texts_and_positions(sheet):
    blocks, words, segments, pages = sheet
    odd = words.where("doc_id = 2").unionByName(words.where("doc_id = 2").withColumns({"text": F.lit(None).cast("string"), "word_seq": F.col("word_seq") + 500})).unionByName(words.where("doc_id = 2").limit(1).withColumn("x0", F.lit(None).cast("double")))
    got = t.extract_tables(blocks, odd, segments, pages).where("doc_id = 2").collect()
    assert len(got) == 1 and [c.raw_text for c in got[0].rows[0].cells] == TABLE[1]


def test_headers_that_overflow_their_row(spark):
    """A header row too low for its text is read down to the second row's end."""
    grid = spark.createDataFrame([(1, 1, 0, [100.0, 103.0, 120.0, 140.0], [100.0, 160.0, 220.0])], "doc_id long, page_no long, block_seq long, ys array<double>, xs array<double>")
    words = spark.createDataFrame(_words(1, [["Type", "Count"], ["a", "b"]], dx=60.0), WORD)
    got = {x.col_index: (x.raw_header, x.canonical_field) for x in t.grid_headers(grid, words).collect()}
    assert got == {0: ("Type", "type"), 1: ("Count", "count")}


def test_columns_near_a_title(spark):
    titles = spark.createDataFrame([(i, 1, 0, 100.0, 130.0) for i in range(4)], "doc_id long, page_no long, block_seq long, x0 double, x1 double")
    grids = spark.createDataFrame([(0, 1, 0, [50.0, 100.0, 130.0, 150.0, 300.0]), (1, 1, 0, [50.0, 120.0, 190.0]), (2, 1, 0, [400.0, 500.0, 600.0]), (3, 1, 0, [80.0, 110.0, 140.0])], "doc_id long, page_no long, block_seq long, xs array<double>")
    got = {x.doc_id: x.xs for x in r.near_title(titles, grids).collect()}
    # columns of 0 lie 40, 0, 25 and 110 off with 36 allowed; of 1 only one is near, so it stays; of 2 none is
    assert got == {0: [50.0, 130.0, 150.0], 1: [50.0, 120.0, 190.0], 3: [80.0, 110.0, 140.0]}


def test_words_find_their_cells(spark):
    """The search by positions gives what testing every cell gives, borders and repeated positions included."""
    edges = [[0.0, 1.0, 2.0], [0.0, 5.0], [1.0, 1.0, 4.0], [2.0]]
    points = [-1.0, 0.0, 0.5, 1.0, 1.5, 2.0, 4.0, 5.0, 6.0]
    df = spark.createDataFrame([(e, p) for e in edges for p in points], "e array<double>, p double")
    for row in df.select("e", "p", g.spans_holding(F.col("e"), F.col("p")).alias("s")).collect():
        want = [i for i, (a, z) in enumerate(itertools.pairwise(row.e)) if a <= row.p <= z]
        assert row.s == want, row


def test_headers_merged_over_rows(spark):
    cells = spark.createDataFrame([(1, 1, i, j, 60.0 * j, 20.0 * i, 60.0 * j + 60, 20.0 * i + 20) for i in range(3) for j in range(2)], "doc_id long, page_no long, r long, c long, x0 double, y0 double, x1 double, y1 double")
    lines = spark.createDataFrame([(1, 1, "horizontal", 20.0, 60.0, 120.0), (1, 1, "horizontal", 40.0, 0.0, 120.0), (1, 1, "vertical", 60.0, 20.0, 60.0)], "doc_id long, page_no long, orientation string, position double, start double, end double")
    got = sorted((x.merge_type, x.divider, x.x0, x.y0, x.x1, x.y1) for x in r.merged_headers(cells, lines, header_rows=2).collect())
    assert got == [("horizontal", 1, 0.0, 0.0, 120.0, 40.0), ("vertical", 1, 0.0, 0.0, 60.0, 40.0)]
    assert r.merged_headers(cells, lines, header_rows=4).count() == 0


def test_segments_of_a_drawing_that_meets_the_area(spark):
    """With drawings' boxes it is the drawing that must meet an area, so its other segments come along."""
    area = spark.createDataFrame([(1, 1, 0, 0.0, 0.0, 50.0, 50.0)], "doc_id long, page_no long, block_seq long, rx0 double, ry0 double, rx1 double, ry1 double")
    segments = spark.createDataFrame([(1, 1, "l", 0.0, 10.0, 40.0, 10.0), (1, 1, "l", 0.0, 90.0, 40.0, 90.0)], SEGMENT)
    assert [x.position for x in r.rulings_in(area, segments).collect()] == [10.0]
    drawn = segments.selectExpr("*", "0d as dx0", "10d as dy0", "40d as dx1", "90d as dy1")
    assert sorted(x.position for x in r.rulings_in(area, drawn).collect()) == [10.0, 90.0]


def test_candidates_and_confidence(spark):
    """A ruled table with columns 18 apart and an allowed header, a written one by a title, notes by a cue, and a title block."""
    xs, ys = [100.0, 118.0, 136.0], [100.0, 120.0, 140.0]
    ruled = _words(1, [["Type", "Count"], ["a", "b"]], dx=18.0)
    written = _words(1, [["foo", "bar", "baz"], ["c", "d", "e"], ["f", "g", "h"]], 100.0, 300.0, first=50)
    cues = _words(1, [["COVER", "-", "40mm"], ["LEGENDS", "-", "x"]], 400.0, 600.0, first=80)
    admin = _words(1, [["Client", "Project"], ["x", "y"], ["z", "w"]], 700.0, 900.0, dx=40.0, first=90)
    block = lambda n, x0, y0, x1, y1, text: (1, 1, n, x0, y0, x1, y1, text, 0)
    blocks = [block(0, 100.0, 100.0, 136.0, 140.0, "Type Count a b"), block(1, 100.0, 300.0, 280.0, 360.0, "foo bar baz"), block(2, 100.0, 270.0, 200.0, 280.0, "Slab  Schedule"), block(3, 400.0, 600.0, 580.0, 640.0, "COVER - 40mm"), block(4, 700.0, 900.0, 790.0, 960.0, "Client Project")]
    drawings = spark.createDataFrame([(1, 1, 0, 690.0, 880.0, 795.0, 1000.0), (1, 1, 1, 0.0, 0.0, 5.0, 5.0)], "doc_id long, page_no long, drawing_seq long, x0 double, y0 double, x1 double, y1 double")
    frames = spark.createDataFrame(blocks, BLOCK), spark.createDataFrame(ruled + written + cues + admin, WORD), spark.createDataFrame(_rules(1, xs, ys), SEGMENT)
    pages = spark.createDataFrame([(1, 1, 800.0, 1200.0)], PAGES)
    found, _ = t.scan_candidates(*frames)
    got = {tuple(x.header_texts)[0]: x for x in t.score_candidates(found, drawings, pages).collect()}
    assert set(got) == {"Type", "foo", "COVER", "Client"}
    assert {k: (x.source, x.confidence, x.keep, x.category) for k, x in got.items()} == {
        "Type": ("vector_grid", 95, True, "schedule_headers"), "foo": ("text_clustering", 65, True, None),
        "COVER": ("text_clustering", 95, True, "notes_structural_cues"), "Client": ("text_clustering", -50, False, None),
    }
    assert got["foo"].title == "Slab  Schedule" and got["Client"].in_zone and got["foo"].header_texts == ["foo", "bar", "baz", "c", "d", "e", "f", "g", "h"]
    kept = {x.table_type: x for x in t.extract_confident(*frames, drawings, pages).collect()}
    assert set(kept) == {"schedule", "slab_schedule", "general_notes"}
    assert (kept["schedule"].title_raw, kept["schedule"].detection_strategy, [c.raw_text for c in kept["schedule"].rows[0].cells]) == ("", "vector_grid", ["a", "b"])
    assert kept["general_notes"].confidence == 95.0 and kept["general_notes"].title_raw == "GENERAL NOTES"
    assert {x.table_type for x in t.without_notes(t.extract_confident(*frames, drawings, pages)).collect()} == {"schedule", "slab_schedule"}
    assert vocab.CONFIDENCE_THRESHOLD == 50


def _layout_file(folder, sheet, doc):
    """A document of the sheet as a file of JSON, one drawing a segment."""
    blocks, words, segments, pages = ([x for x in df.where(f"doc_id = {doc}").collect()] for df in sheet)
    page = {
        "width": pages[0].width, "height": pages[0].height, "words": [[w.x0, w.y0, w.x1, w.y1, w.text] for w in words],
        "blocks": [[b.x0, b.y0, b.x1, b.y1, b.text, b.block_type] for b in sorted(blocks, key=lambda b: b.block_seq)],
        "drawings": [{"rect": [min(s.p1x, s.p2x), min(s.p1y, s.p2y), max(s.p1x, s.p2x), max(s.p1y, s.p2y)], "items": [[s.kind, [s.p1x, s.p1y], [s.p2x, s.p2y]]]} for s in segments],
    }
    (folder / f"plan{doc}.json").write_text(json.dumps({"pages": [page]}), encoding="utf-8")


def test_files_to_documents(spark, sheet, tmp_path):
    """Layout files are read by the data source, extracted, and written as two files a document."""
    for doc in (1, 2):
        _layout_file(tmp_path, sheet, doc)
    block, word, segment, drawing, page = pages.read_layout(spark, str(tmp_path), "block", "word", "segment", "drawing", "page")
    assert page.count() == 2 and segment.where("doc_id = 'plan1' and kind <> 'l'").count() == 0 and drawing.count() == sheet[2].where("doc_id = 1").count()
    regions = t.extract_regions(block, word, segment, page)
    out = tmp_path / "out"
    assert sinks.write_documents(regions, str(out)) == [f"{out}: 2 documents, 4 files"]
    assert sorted(x.name for x in out.iterdir()) == [f"plan{d}_{k}.json" for d in (1, 2) for k in ("canonical", "simplified")]
    whole = json.loads((out / "plan1_canonical.json").read_text(encoding="utf-8"))
    assert [(x["table_type"], x.get("row_count")) for x in whole] == [("beam_schedule", 2), ("general_notes", None)]
    assert whole[0]["rows"][0]["cells"][1]["normalized_value"][0] == {"count": 2, "bar_type": "T16"}
    simple = json.loads((out / "plan1_simplified.json").read_text(encoding="utf-8"))["tables"]
    assert simple[0] == {"name": "SCHEDULE  OF", "type": "beam_schedule", "rows": [{"Beam Mkd.": "B1", "Stirups": "2-T16+1-T12", "Remarks": "R1"}, {"Beam Mkd.": "B2", "Stirups": "T10@150c/c", "Remarks": ""}]}
    assert simple[1] == {"name": "GENERAL NOTES", "type": "general_notes", "Cover": {"Column": "40mm"}, "additional_notes": ["All dimensions in mm"]}
    assert whole[1]["general_notes"] == {"cover": {"column": "40mm"}} and whole[1]["legends"] == {} and whole[1]["metadata"] == ["ALL DIMENSIONS IN MM"]
    assert len(whole[0]["source_region_bbox"]) == len(whole[0]["rows"][0]["cells"][0]["bbox"]) == 4 and whole[0]["page_number"] == whole[1]["page_number"] == 1


def test_documents_in_both_forms(spark):
    """Notes with a section, a line without a key and a legend without a text; a table without rows; keys that repeat."""
    bbox = (1.0, 2.0, 3.0, 4.0)
    kinds = "doc_id string, page_no long, block_seq long, table_type string, region_type string, title_raw string, source_region_bbox struct<x0: double, y0: double, x1: double, y1: double>, notes array<struct<kind: string, section: string, key: string, value: string>>"
    table = "detection_strategy string, row_count long, col_count long, header_row_index int, headers array<struct<col_index: long, raw_header: string, canonical_field: string, parent_header: string>>, merged_header_cells array<struct<bbox: struct<x0: double, y0: double, x1: double, y1: double>, merge_type: string>>, rows array<struct<row_index: long, cells array<struct<col_index: long, raw_text: string, confidence: double, normalized_value array<struct<count: int, bar_type: string, diameter_mm: double, spacing_mm: int>>, bbox struct<x0: double, y0: double, x1: double, y1: double>>>>>"
    notes = [("note", None, "grade_of_concrete", "M50"), ("note", "cover", "column", "40mm"), ("note", None, "grade_of_steel", "Fe 500 \"x\""), ("note", "cover", "slab", "20mm"), ("legend", None, "erection_mark", ""), ("legend", None, "dowel", "pipe"), ("metadata", None, None, "ALL DIMENSIONS ARE IN MM")]
    head = [(0, "Ref", "ref_no", None), (1, "Dia", None, None), (2, "Ref", None, None)]
    cells = [(0, "N7", 1.0, None, bbox), (1, '25 "count":null mm', 1.0, [(None, None, 25.0, None)], bbox), (2, "last", 1.0, [(2, "T16", None, None)], bbox)]
    rows = [
        ("d", 1, 0, "general_notes", "general_notes", "GENERAL NOTES:\nGENERAL NOTES:", bbox, notes, *[None] * 7), ("d", 1, 1, "dowel_bar_schedule", "schedule", "Dowel Bar Schedule", bbox, None, "text_clustering", 1, 3, 0, head, [(bbox, "horizontal")], [(0, cells)]),
        ("d", 2, 0, "legend", "legend", None, bbox, None, *[None] * 7), ("d", 2, 1, None, "schedule", None, bbox, None, "vector", 0, 1, 0, [], [], None),
    ]
    made = sinks.documents(spark.createDataFrame(rows, f"{kinds}, {table}")).first()
    whole, simple = json.loads(made.canonical), json.loads(made.simplified)["tables"]
    assert list(whole[0]) == ["table_type", "region_type", "title_raw", "source_region_bbox", "general_notes", "legends", "metadata", "page_number"]
    assert whole[0]["general_notes"] == {"grade_of_concrete": "M50", "cover": {"column": "40mm", "slab": "20mm"}, "grade_of_steel": 'Fe 500 "x"'} and list(whole[0]["general_notes"]) == ["grade_of_concrete", "cover", "grade_of_steel"]
    assert whole[0]["legends"] == {"erection_mark": "", "dowel": "pipe"} and whole[0]["metadata"] == ["ALL DIMENSIONS ARE IN MM"] and whole[0]["source_region_bbox"] == list(bbox)
    assert [c["normalized_value"] for c in whole[1]["rows"][0]["cells"]] == [None, [{"diameter_mm": 25.0}], [{"count": 2, "bar_type": "T16"}]]
    assert whole[1]["headers"][1] == {"col_index": 1, "raw_header": "Dia", "canonical_field": None, "parent_header": None} and whole[1]["merged_header_cells"] == [{"bbox": list(bbox), "merge_type": "horizontal"}]
    assert whole[1]["rows"][0]["cells"][1]["raw_text"] == '25 "count":null mm' and whole[2]["general_notes"] == {} and whole[3]["page_number"] == 2
    assert simple[0] == {"name": "GENERAL NOTES", "type": "general_notes", "notes": {"Grade Of Concrete": "M50", "Grade Of Steel": 'Fe 500 "x"'}, "Cover": {"Column": "40mm", "Slab": "20mm"}, "additional_notes": ["All dimensions are in mm"], "legends": {"Erection Mark": None, "Dowel": "pipe"}, "flags": ["Erection Mark (symbol/icon in source drawing -- not text-extractable)"]}
    assert list(simple[0]) == ["name", "type", "notes", "Cover", "additional_notes", "legends", "flags"]
    assert simple[1:] == [{"name": "Dowel Bar Schedule", "type": "dowel_bar_schedule", "rows": [{"Ref": "last", "Dia": '25 "count":null mm'}]}, {"name": "legend", "type": "legend"}, {"name": "Table", "type": "", "rows": []}]


def _two_pages(data):
    for n in (1, 2):
        yield "page", {"page_no": n, "width": float(len(data)), "height": 2.0, "other": 1}
        yield "word", {"page_no": n, "word_seq": 0, "text": data.decode()}


def test_parser_of_ones_own(spark, tmp_path):
    (tmp_path / "a.txt").write_text("abc")
    (tmp_path / "b.json").write_text("{}")
    word, page = pages.read_layout(spark, str(tmp_path), "word", "page", parser="tests.test_tables:_two_pages", pattern="*.txt")
    assert sorted(tuple(x) for x in page.collect()) == [("a", 1, 3.0, 2.0), ("a", 2, 3.0, 2.0)]
    assert [(x.text, x.x0) for x in word.collect()] == [("abc", None)] * 2
    none = pages.read_layout(spark, str(tmp_path / "none"), "page")
    assert none[0].count() == 0


def _counted(data):
    """Tells of its calls by a line each in the file that the data names first."""
    where, _, text = data.decode().partition(" ")
    with open(where, "a") as f:
        f.write("called\n")
    if text == "broken":
        raise RuntimeError("no layout")
    yield "word", {"page_no": 2, "word_seq": 0, "x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0, "text": text}
    yield "page", {"page_no": 1, "width": 1.0, "height": 2.0}
    yield "page", {"page_no": 2, "width": 1.0, "height": 2.0}


def test_files_are_parsed_once(spark, tmp_path):
    """Five relations, each read twice, of 30 files: 30 calls; a page without any rows but its own stays."""
    files, calls = tmp_path / "files", tmp_path / "calls"
    files.mkdir()
    for i in range(30):
        (files / f"{i}.txt").write_text(f"{calls} {'long ' * i}")
    options = {"parser": "tests.test_tables:_counted", "pattern": "*.txt", "maxPartitionBytes": "500"}
    got = pages.read_layout(spark, str(files), "block", "word", "segment", "drawing", "page", **options)
    for _ in range(2):
        assert [x.count() for x in got] == [0, 30, 0, 0, 60]
    assert len(calls.read_text().split()) == 30
    assert [x.columns for x in got] == [[c.split()[0] for c in pages.RELATIONS[r].split(", ")] for r in ("block", "word", "segment", "drawing", "page")]
    flat = spark.read.format("layout").options(relation="word", **options).load(str(files))
    assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, got[1].collect()))


def test_a_file_that_cannot_be_parsed(spark, tmp_path):
    files, calls = tmp_path / "files", tmp_path / "calls"
    files.mkdir()
    (files / "good.txt").write_text(f"{calls} x")
    (files / "bad.txt").write_text(f"{calls} broken")
    options = {"parser": "tests.test_tables:_counted", "pattern": "*.txt"}
    with pytest.raises(Exception, match="bad.txt could not be parsed: no layout"):
        pages.read_layout(spark, str(files), "word", **options)
    kept = pages.read_pages(spark, str(files), mode="PERMISSIVE", **options)
    assert sorted((x.doc_id, x.page_no, x.error) for x in kept.select("doc_id", "page_no", "error").collect() if x.error) == [("bad", None, "RuntimeError: no layout")]
    assert [x.doc_id for x in pages.relation_of(kept, "word").collect()] == ["good"]


def test_packing():
    assert pages.packed([("a", 5), ("b", 3), ("c", 3), ("d", 20), ("e", 0)], 6) == [["d"], ["a"], ["b", "c", "e"]]
    assert pages.packed([], 6) == []


def _texts(spark, n):
    rows = spark.range(n).repartition(4).selectExpr("case when id = 0 then null else concat('plan/', id, '%') end as doc_id", "concat('[', id, ']') as canonical", "cast(id as string) as simplified")
    spark.dataSource.register(sinks.DocumentSink)
    return rows


def test_documents_are_written_whole(spark, tmp_path):
    """Files replace those of their name, and leave others; names with a stroke stay names."""
    out = tmp_path / "out"
    for n in (3, 9):
        _texts(spark, n).write.format("layout_documents").mode("append").save(str(out))
        (out / "other.txt").write_text("kept")
    names = {f"{d}_{k}.json" for d in ["%null", *(f"plan%2F{i}%25" for i in range(1, 9))] for k in ("canonical", "simplified")}
    assert {x.name for x in out.iterdir()} == names | {"other.txt"} and (out / "plan%2F8%25_canonical.json").read_text() == "[8]"
    _texts(spark, 2).write.format("layout_documents").mode("append").save(f"file://{tmp_path}/uri")
    assert len(list((tmp_path / "uri").iterdir())) == 4
    _texts(spark, 0).write.format("layout_documents").mode("append").save(str(tmp_path / "none"))
    assert list((tmp_path / "none").iterdir()) == []
    assert [sinks.file_name(x) for x in (None, "", ".", "..", "a.b", "é", "a/../b")] == ["%null", "%", "%.", "%..", "a.b", "é", "a%2F..%2Fb"]


def test_a_job_that_fails_leaves_no_file(spark, tmp_path):
    bad = _texts(spark, 40).withColumn("canonical", F.expr("case when canonical = '[33]' then raise_error('no text') else canonical end"))
    for i in range(5):  # other tasks may be writing when one fails
        with pytest.raises(Exception, match="no text"):
            bad.write.format("layout_documents").mode("append").save(str(tmp_path / str(i)))
    time.sleep(1)
    assert [x for i in range(5) for x in (tmp_path / str(i)).rglob("*")] == []


def test_search_summary(spark):
    found = spark.createDataFrame([(0, 0.5), (1, 0.75), (2, 0.75)], "combo_id long, accuracy double")
    regions = spark.createDataFrame([("p",), ("p",), ("q",)], "source_pdf string")
    assert [tuple(x) for x in scoring.search_summary(found, regions, source_col="source_pdf").collect()] == [(2, 3, 0.75, 2)]


def test_large_stored_tables_are_not_sent_whole(spark, monkeypatch):
    """Small files of many rows: the planner would send them to all tasks by the size of the files (F5, F6, F9, F11)."""
    monkeypatch.setattr(storage, "SENT", 1000)
    plan = lambda df: df._jdf.queryExecution().toString()
    rows = spark.range(5000).select((F.col("id") % 4).alias("doc_id"), F.lit(1).alias("page_no"), "id")
    many, few = storage.stored(rows, "many"), storage.stored(rows.where("id < 50"), "few")
    assert "Broadcast" in plan(few.join(few.groupBy("id").count(), "id"))
    for right in (many, many.where("id > 3").groupBy("id").count(), many.select("id").distinct()):
        assert "Broadcast" not in plan(few.join(right, "id")) and few.join(right, "id").count() in (50, 46)
    heads = storage.stored(rows.select(F.concat(F.lit("h"), "doc_id").alias("raw_header")), "heads")
    named = scoring.header_fields_fuzzy(heads)
    assert "BroadcastHashJoin" in plan(named) and named.count() == 5000  # few distinct headers go to where the many are


def test_candidates_are_read_from_one_table(spark):
    """Branches that read candidates do not make them again, where a join that is left out would lose its hint (F5)."""
    none = lambda kind: spark.createDataFrame([], kind)
    found, _ = t.scan_candidates(none(BLOCK), none(WORD), none(SEGMENT))
    assert "Join" not in found._jdf.queryExecution().toString() and found.count() == 0
