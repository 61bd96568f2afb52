"""Region operators on small fixtures with known answers."""

import itertools
import random

from pyspark.sql import functions as F

from tabulith.functions import words as w
from tabulith.operators import notes, regions, scoring, similarity
from tabulith.plans import queries, region_queries
from tabulith.sources import sinks, stores
from tests.conftest import DATA


def test_joined_boxes_grow():
    chain = [(0, 0, 10, 10), (100, 0, 110, 10), (20, 0, 90, 10)]
    assert regions.joined_boxes(chain, 15, 8) == [(0, 0, 110, 10)]
    assert regions.joined_boxes(chain[:2], 15, 8) == chain[:2]
    assert regions.joined_boxes([], 15, 8) == []


def _boxes(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, page_no long, x0 double, y0 double, x1 double, y1 double")


def test_pages_of_few_boxes_are_united_at_once(spark, monkeypatch):
    """3,000 pages of chains that grow: nothing of them is written for rounds, and a crowded page among them still is."""
    written, store = [], regions.stored
    monkeypatch.setattr(regions, "stored", lambda df, name: written.append(name) or store(df, name))
    small = [(doc, 1, *map(float, box)) for doc in range(3000) for box in [(0, 0, 10, 10), (100, 0, 110, 10), (20, 0, 90, 10), (500, 500, 510, 510)]]
    one = {(doc, 1, 0.0, 0.0, 110.0, 10.0) for doc in range(3000)} | {(doc, 1, 500.0, 500.0, 510.0, 510.0) for doc in range(3000)}
    assert {tuple(r) for r in regions.united_boxes(_boxes(spark, small), 15, 8).collect()} == one
    assert "nearest" not in written
    crowd = [(-1, 1, 100.0 * i, 0.0, 100.0 * i + 10, 10.0) for i in range(300)] + [(-2, 1, 0.0, 0.0, float("nan"), 10.0), (-2, 1, 100.0, 0.0, 110.0, 10.0)]
    found = regions.united_boxes(_boxes(spark, small + crowd), 15, 8)
    assert {tuple(r) for r in found.where("doc_id <> -2").collect()} == one | set(crowd[:300])
    assert "nearest" in written


def test_united_boxes_have_no_order(spark):
    """Random pages, sparse and crowded, against one box after the other in any order; chains; a box that grows into others."""
    dice = random.Random(3)
    rows = []
    for doc, (n, side) in enumerate([(60, 600), (400, 1500), (900, 1200), (300, 6000)]):
        for _ in range(n):
            x, y = dice.randrange(side), dice.randrange(side)
            rows.append((doc, 1, float(x), float(y), float(x + dice.randrange(30)), float(y + dice.randrange(12))))
    rows += [(9, 1, 40.0 * i, 0.0, 40.0 * i + 30, 5.0) for i in range(200)] + [(10, 1, 0.0, 0.0, 5.0, 5.0), (10, 1, 15.0, 3000.0, 16.0, 3001.0), (10, 1, 18.0, 4.0, 19.0, 2995.0)]
    got = sorted(tuple(x) for x in regions.united_boxes(_boxes(spark, rows), 15, 8).collect())
    want = set()
    for doc in {r[0] for r in rows}:
        boxes = [r[2:] for r in rows if r[0] == doc]
        for _ in range(2):
            dice.shuffle(boxes)
            want |= {(doc, 1, *b) for b in regions.joined_boxes(boxes, 15, 8)}
    assert got == sorted(want) and sum(r[0] == 9 for r in got) == sum(r[0] == 10 for r in got) == 1


def test_united_boxes_of_odd_rows(spark):
    odd = [(1, 1, None, 0.0, 1.0, 1.0), (1, 1, 5.0, 0.0, 1.0, 1.0), (None, 1, 0.0, 0.0, 1.0, 1.0), (2, 1, 0.0, 0.0, 0.0, 0.0), (2, 1, 0.0, 0.0, 0.0, 0.0)]
    assert [tuple(x) for x in regions.united_boxes(_boxes(spark, odd), 1, 1).collect()] == [(2, 1, 0.0, 0.0, 0.0, 0.0)]
    assert regions.united_boxes(_boxes(spark, []), 1, 1).count() == 0


def test_a_crowded_page_of_blocks(spark):
    """50,000 boxes of one page, most of them apart."""
    rows = spark.range(50_000).selectExpr("1L as doc_id", "1L as page_no", "cast(id % 250 * 40 as double) as x0", "cast(id div 250 * 30 as double) as y0")
    rows = rows.selectExpr("*", "x0 + case when y0 % 60 = 0 and x0 % 400 < 200 then 30 else 10 end as x1", "y0 + 5 as y1")
    # in every second line five boxes of each ten lie 10 apart and reach the sixth
    assert regions.united_boxes(rows, 15, 8).count() == 50_000 - 100 * 25 * 5


def test_overlaid_words(spark):
    rows = [(1, 1, i, x, 0.0, x + 10, 8.0, t) for i, (x, t) in enumerate([(0.0, "a"), (1.5, "a"), (3.0, "a"), (0.0, "b"), (2.0, "b")])]
    df = spark.createDataFrame(rows, "doc_id long, page_no long, word_seq long, x0 double, y0 double, x1 double, y1 double, text string")
    # the third lies near the second alone, which is not kept; 2.0 is not under 2
    assert sorted(r["word_seq"] for r in regions.overlaid_dropped(df).collect()) == [0, 2, 3, 4]
    assert regions.overlaid_dropped(df.where("false")).count() == 0


def test_precedence_is_greedy(spark):
    box = "doc_id long, page_no long, block_seq long, x0 double, y0 double, x1 double, y1 double"
    titles = spark.createDataFrame([(1, 1, i, x, 0.0, x + 2, 2.0) for i, x in enumerate((0.0, 8.0, 16.0, 40.0))], box)
    areas = spark.createDataFrame([(1, 1, i, x, 0.0, x + 10, 9.0) for i, x in enumerate((0.0, 8.0, 16.0))], "doc_id long, page_no long, block_seq long, rx0 double, ry0 double, rx1 double, ry1 double")
    # the second lies in the first; the third only in the second, which is dropped; the fourth has no region
    assert sorted(r["block_seq"] for r in regions.not_covered_before(titles, areas).collect()) == [0, 2]


def _line(cy, *texts):
    return (float(cy), [(60.0 * i, 60.0 * i + 30, 60.0 * i + 15, float(cy), t) for i, t in enumerate(texts) if t])


def test_notes_lines():
    lines = [_line(0, "GENERAL", "NOTES:"), _line(10, "LIFTING", "", "-", "M35"), _line(25, "", "", "", "more"), _line(60, "loose", "words"), _line(75, "ALL", "DIMENSIONS"), _line(80, "COVER:"), _line(90, "A,B", "", "-", "40mm"), _line(100, "A,B", "", "-", "50mm"), _line(110, "LEGENDS:"), _line(120, "MARK", "", "", "-")]
    got = notes.parse_notes(lines)
    assert got[:3] == [("note", None, "lifting", "M35 more"), ("note", "cover", "ab", "50mm"), ("legend", None, "mark", "")]
    assert [g[3] for g in got[3:]] == ["loose words", "ALL DIMENSIONS"]
    assert notes.parse_notes([]) == []


def _common(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        rows[i + 1][j + 1] = rows[i][j] + 1 if a[i] == b[j] else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_ratios():
    texts = ["", "a", "beam mkd.", "bottam reinfo", "bottom reinforcement", "é日本", "no.", "abcabc", "x" * 70]
    for a, b in itertools.product(texts, texts):
        assert w.common_length(a, b) == _common(a, b)
    assert w.partial_ratio("size", "beam size mm") == 100 and w.token_ratio("mark beam", "beam mark") == 100
    assert w.weighted_ratio("", "x") == 0 and w.weighted_ratio("beam mark", "mark beam") == 95


def test_fuzzy_headers(spark):
    df = spark.createDataFrame([("BOTTAM REINFO.",), ("Beam  Mkd",), ("xyzzy",), (None,), ("",), ("Stirrup s",)], "raw_header string")
    got = {r["raw_header"]: r["canonical_field"] for r in scoring.header_fields_fuzzy(df).collect()}
    assert got == {"BOTTAM REINFO.": "bottom_reinforcement", "Beam  Mkd": "beam_mark", "xyzzy": None, None: None, "": None, "Stirrup s": "stirrups"}


def test_dictionary_round_trip(spark, tmp_path):
    assert stores.load_terms(spark, str(tmp_path / "none.json")).count() == 0
    terms = spark.createDataFrame([("Ref No.", "a", None, None, "n"), ("Type", "a", "p", "2020-01-01", "")], stores.TERMS)
    path = str(tmp_path / "terms.jsonl")
    stores.save_terms(terms, path)
    back = stores.load_terms(spark, path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, terms.collect()), key=repr)
    more = spark.createDataFrame([("Ref No", "a"), ("Ref No", "b"), ("Volume", "a")], "term string, category string")
    added = similarity.add_terms(terms, more)
    assert sorted((r["term"], r["category"]) for r in added.collect()) == [("Ref No", "b"), ("Ref No.", "a"), ("Type", "a"), ("Volume", "a")]


def test_labelled(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"source_pdf": "p", "page_width": 10, "page_height": 20, "candidates": [{"label": "t", "expected_keep": true, "bbox": {"x0": 1, "y0": 2, "x1": 3, "y1": 4}, "header_texts": ["Ref"], "row_count": 1, "col_count": 2}, {"label": "u", "expected_keep": false}]}')
    got = stores.load_labelled(spark, str(tmp_path)).orderBy("file", "i").collect()
    assert [(r["label"], r["expected_keep"], r["title_block_zone"]) for r in got] == [("t", True, None), ("u", False, None)]


def test_presentation(spark):
    tables = spark.createDataFrame([(1, "t", "BEAMS::\nmore", "vector"), (2, None, None, "text")], "doc_id long, table_type string, title_raw string, detection_strategy string")
    head = spark.createDataFrame([(1, 0, "A", None), (1, 1, "A", "x"), (1, 2, "C", None)], "doc_id long, col_index long, raw_header string, canonical_field string")
    cells = spark.createDataFrame([(1, 0, 0, "first"), (1, 0, 1, "2-T16"), (1, 0, 3, None)], "doc_id long, row_index long, col_index long, raw_text string")
    made = sinks.canonical_tables(tables, head, cells, ["doc_id"])
    got = {r["doc_id"]: r for r in sinks.presentation_tables(made).collect()}
    assert got[1]["name"] == "BEAMS" and got[2]["name"] == "Table" and got[2]["simple"] is None
    assert got[1]["simple"] == [{"A": "2-T16", "col_3": None}]
    assert got[1]["rows"][0]["cells"][1]["normalized_value"][0]["bar_type"] == "T16"


def test_queries_without_sql(spark):
    for name, (query, sql) in region_queries.QUERIES.items():
        if not sql:
            assert query(spark, str(DATA / "sf0.001")).limit(5).count() > 0, name


def test_region_shapes(spark):
    """One title over a ruled grid of 2 x 2, one over words in 3 rows and 2 columns, one over nothing."""
    box = "doc_id long, page_no long, block_seq long, x0 double, y0 double, x1 double, y1 double, width double, height double"
    titles = spark.createDataFrame([(i, 1, 0, 100.0, 50.0, 200.0, 60.0, 800.0, 1200.0) for i in (1, 2, 3)], box)
    flat = [(1, 1, "l", 100.0, y, 200.0, y) for y in (70.0, 90.0, 110.0)]
    upright = [(1, 1, "l", x, 70.0, x, 110.0) for x in (100.0, 150.0, 200.0)]
    segments = spark.createDataFrame(flat + upright, "doc_id long, page_no long, kind string, p1x double, p1y double, p2x double, p2y double")
    words = spark.createDataFrame([(2, 1, 2 * i + j, 100.0 + 60 * j, 80.0 + 20 * i, 130.0 + 60 * j, 88.0 + 20 * i, "w") for i in range(3) for j in range(2)], "doc_id long, page_no long, word_seq long, x0 double, y0 double, x1 double, y1 double, text string")
    got = regions.region_shapes(titles, segments, words).select("doc_id", "detection_strategy", "row_count", "col_count").collect()
    assert sorted(map(tuple, got)) == [(1, "vector", 2, 2), (2, "text_clustering", 3, 2)]


def test_zone(spark):
    areas = spark.createDataFrame([(1, 1, 0, 9.0, 9.0, 12.0, 12.0), (1, 1, 1, 0.0, 9.0, 12.0, 12.0), (2, 1, 0, 9.0, 9.0, 12.0, 12.0)], "doc_id long, page_no long, region_index long, x0 double, y0 double, x1 double, y1 double")
    zones = spark.createDataFrame([(1, 1, 10.0, 10.0, 20.0, 20.0)], "doc_id long, page_no long, x0 double, y0 double, x1 double, y1 double")
    assert [r["in_zone"] for r in regions.in_zone(areas, zones).orderBy("doc_id", "region_index").collect()] == [True, False, False]
    assert regions.large_boxes(areas.withColumn("x1", F.lit(50.0))).count() == 0


def test_grid_search_tries_every_setting(spark):
    rows = [(100.0, 10.0, True, False, True, 2, 2, True), (92.0, 10.0, False, False, False, 2, 2, False), (80.0, 80.0, True, True, False, 0, 3, False), (None, None, True, False, False, 3, 6, True)]
    df = spark.createDataFrame(rows, "allow_score double, deny_score double, structured boolean, in_zone boolean, title_hit boolean, row_count long, col_count long, expected boolean")
    got = scoring.grid_search(df).collect()
    want = []
    for i, c in enumerate(itertools.product((20, 40, 60), (30, 45, 60), (-90, -70, -50), (-50, -30, -15), (5, 15, 25), (5, 10, 15), (30, 50, 70), (75, 85, 95))):
        right = 0
        for allow, deny, structured, zone, title, n_rows, n_columns, expected in rows:
            shape = 0 if 0 in (n_rows, n_columns) else -c[5] if n_columns >= 5 else c[5]
            total = c[0] * structured + c[1] * ((allow or 0) >= c[7]) + c[2] * ((deny or 0) >= c[7]) + c[3] * zone + c[4] * title + shape
            right += (total >= c[6]) == expected
        want.append((-right / 4, i, c))
    assert [(-r.accuracy, r.combo_id, tuple(r)[1:9]) for r in got] == sorted(want) and len(got) == 6561
    assert {r.accuracy for r in scoring.grid_search(df.where("false"), {"structure_found": (1,)}).collect()} == {0.0}


def test_rebar_parse_reads_every_word(spark, monkeypatch):
    words = [(1, 10, "B1"), (1, 11, "25-T16"), (1, 13, "2-16Ø+1-12Ø"), (2, 27, "T10@150c/c"), (2, 28, "-")]
    monkeypatch.setattr(queries.b, "relation", lambda *_: spark.createDataFrame(words, "doc_id long, word_seq long, text string"))
    got = sorted((r.doc_id, r.word_seq, r.i, r.n_bars, r.bar_type, r.diameter_mm, r.spacing_mm) for r in queries.rebar_parse(spark, "").collect())
    assert got == [(1, 11, 0, 25, "T16", None, None), (1, 13, 0, 2, None, 16.0, None), (1, 13, 1, 1, None, 12.0, None), (2, 27, 0, None, "T10", None, 150)]


def test_written_edges_equal_the_operators_of_pages(spark):
    """Random words in 40 areas, ties in place and number among them: the same rows and columns as by page, in two or three shuffles less."""
    from tabulith.operators import geometry as g

    dice = random.Random(7)
    rows = []
    for page in range(40):
        for seq in range(dice.randrange(1, 60)):
            x, y = dice.randrange(0, 1600) / 4, dice.randrange(0, 320) / 4
            rows.append((page, 1, seq // 2 if page % 2 else seq, x, y, x + dice.randrange(4, 120) / 4, y + dice.randrange(8, 40) / 4, str(seq)))
    words = spark.createDataFrame(rows, "doc_id long, page_no long, word_seq long, x0 double, y0 double, x1 double, y1 double, text string")
    areas = spark.createDataFrame([(p, 1, 5, -10.0, -10.0, 500.0, 200.0) for p in range(41)], "doc_id long, page_no long, block_seq long, rx0 double, ry0 double, rx1 double, ry1 double")
    placed = g.text_rows(words)
    ys, xs = {}, {}
    for edges, out in ((g.row_bounds(placed), ys), (g.column_grid(g.text_cells(placed)), xs)):
        for r in edges.orderBy("doc_id", "place").collect():
            out.setdefault(r["doc_id"], []).append(r["edge"])
    enough = {r["doc_id"] for r in words.groupBy("doc_id").count().where("count >= 6").collect()}
    want = {p: (ys[p], xs[p]) for p in enough if len(ys[p]) >= 3 and len(xs.get(p, [])) >= 3}
    found = {r["doc_id"]: (r["ys"], r["xs"]) for r in regions.written_grids(areas, words).collect()}
    assert want and found.keys() == want.keys()
    for p, (y, x) in want.items():
        assert found[p][0] == y and all(abs(a - b) < 1e-9 for a, b in zip(found[p][1], x, strict=True))


def test_lines_of_a_page_do_not_crowd_its_notes(spark, monkeypatch):
    """A page of 60 lines and one title of notes is met as it is: nothing is written, and what is found so far is made once."""
    from tabulith.operators import spatial

    written, store = [], spatial.stored
    monkeypatch.setattr(spatial, "stored", lambda df, name: written.append(name) or store(df, name))
    titles = spark.createDataFrame([(1, 1, 0, 60.0, 80.0, 160.0, 90.0, 800.0, 1200.0)], "doc_id long, page_no long, block_seq long, x0 double, y0 double, x1 double, y1 double, width double, height double")
    blocks = spark.createDataFrame([(1, 1, 1, 60.0, 600.0, "CLIENT:", 0)], "doc_id long, page_no long, block_seq long, x0 double, y0 double, text string, block_type long")
    lines = [(1, 1, "l", 40.0, 10.0 + 5 * i, 300.0, 10.0 + 5 * i) for i in range(60)] + [(1, 1, "l", x, 0.0, x, 900.0) for x in (50.0, 300.0)]
    segments = spark.createDataFrame(lines, "doc_id long, page_no long, kind string, p1x double, p1y double, p2x double, p2y double")
    found = [tuple(r) for r in notes.notes_bounds(titles, blocks, segments).collect()]
    assert found == [(1, 1, 0, 52.0, 87.0, 298.0, 303.0)]
    assert not written


def test_panel_lines_equal_the_operators_of_pages(spark):
    """Random words, many laid over each other: the same lines as by page; a null text in a panel is no error."""
    from tabulith.operators import geometry as g

    dice = random.Random(11)
    rows = []
    for page in range(30):
        for seq in range(dice.randrange(1, 80)):
            x, y = dice.randrange(0, 160) / 4, dice.randrange(0, 240) / 4
            rows.append((page, 1, seq // 2 if page % 2 else seq, x, y, x + dice.randrange(4, 40) / 4, y + dice.randrange(8, 40) / 4, dice.choice("ab-")))
    kind = "doc_id long, page_no long, word_seq long, x0 double, y0 double, x1 double, y1 double, text string"
    want = {}
    for r in g.text_rows(regions.overlaid_dropped(spark.createDataFrame(rows, kind))).collect():
        want.setdefault((r["doc_id"], r["row"]), []).append((r["x0"], r["x1"], r["cy"], r["text"]))
    found = {}
    for page in range(30):
        for i, (_, line) in enumerate(notes.panel_lines([((True, w[2]), *w[3:]) for w in rows if w[0] == page])):
            found[page, i] = [(w[0], w[1], w[3], w[4]) for w in line]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    words = spark.createDataFrame([(1, 1, i, 10.0 + 30 * i, 10.0, 30.0 + 30 * i, 18.0, t) for i, t in enumerate(("COVER", "-", None, "25"))], kind)
    titles = spark.createDataFrame([(1, 1, 4)], "doc_id long, page_no long, block_seq long")
    bounds = titles.selectExpr("*", "0.0D as rx0", "0.0D as ry0", "400.0D as rx1", "400.0D as ry1")
    assert [tuple(r) for r in notes.notes(titles, bounds, words).collect()] == [(1, 1, 4, 0, "note", None, "cover", "25")]
