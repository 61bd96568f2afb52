"""Headers of several rows on small grids with known answers."""

import duckdb

from tabulith.operators import headers
from tabulith.plans import region_queries
from tests.conftest import DATA

CELL = "doc_id long, page_no long, r long, c long, x0 double, y0 double, x1 double, y1 double"
LINE = "doc_id long, page_no long, orientation string, position double, start double, end double"
WORD = "doc_id long, page_no long, word_seq long, x0 double, y0 double, x1 double, y1 double, text string"


def _grid(spark, rows, columns, words, parted, doc=1):
    """Cells of 60 by 20, verticals over the rows that ``parted`` gives for each divider, words by row and column."""
    cells = [(doc, 1, i, j, 60.0 * j, 20.0 * i, 60.0 * j + 60, 20.0 * i + 20) for i in range(rows) for j in range(columns)]
    lines = [(doc, 1, "vertical", 60.0 * c, 20.0 * a, 20.0 * z) for c, spans in parted.items() for a, z in spans]
    said = [(doc, 1, n, 60.0 * c + 5 + n % 7, 20.0 * r + 5, 60.0 * c + 35 + n % 7, 20.0 * r + 13, t) for n, (r, c, t) in enumerate(words)]
    return spark.createDataFrame(cells, CELL), spark.createDataFrame(lines or [(0, 0, "vertical", 0.0, 0.0, 0.0)], LINE), spark.createDataFrame(said or [(0, 0, 0, 0.0, 0.0, 0.0, 0.0, "")], WORD)


def _trees(spark, *args, header_rows=2):
    spans = headers.header_spans(*_grid(spark, *args), header_rows=header_rows)
    return [(r.raw_header, r.parent_header, list(r.path)) for r in headers.header_trees(spans).orderBy("col_index").collect()]


def test_three_rows(spark):
    words = [(0, 1, "Reinforcement"), (0, 2, "(mm)"), (1, 1, "Main"), (1, 3, "Links"), (2, 0, "Mark"), (2, 1, "Top"), (2, 2, "Bottom"), (2, 3, "Dia"), (3, 0, "B1")]
    # the upper span is over columns 1 to 3, the middle one over 1 and 2
    assert _trees(spark, 4, 4, words, {1: [(0, 4)], 2: [(2, 4)], 3: [(1, 4)]}, header_rows=3) == [
        ("Mark", None, ["Mark"]), ("Top", "Main", ["Reinforcement (mm)", "Main", "Top"]),
        ("Bottom", "Main", ["Reinforcement (mm)", "Main", "Bottom"]), ("Dia", "Links", ["Reinforcement (mm)", "Links", "Dia"]),
    ]


def test_a_span_that_covers_only_a_part_is_no_parent(spark):
    words = [(0, 0, "Left"), (0, 2, "Right"), (1, 1, "Both")]
    assert _trees(spark, 3, 3, words, {1: [(1, 2)], 2: [(0, 1)]}) == [("Left", None, ["Left"])] + [("Both", None, ["Both"])] * 2
    # a vertical that ends within a point of the row still parts it, one that ends two points short does not
    assert [x[0] for x in _trees(spark, 2, 2, [(0, 0, "a"), (0, 1, "b")], {1: [(0.05, 0.95)]}, header_rows=1)] == ["a", "b"]
    assert [x[0] for x in _trees(spark, 2, 2, [(0, 0, "a"), (0, 1, "b")], {1: [(0.1, 1)]}, header_rows=1)] == ["a b", "a b"]


def test_headers_of_odd_grids(spark):
    assert _trees(spark, 1, 2, [(0, 0, None), (0, 1, "x")], {1: [(0, 1)]}) == [("", None, []), ("x", None, ["x"])]
    assert _trees(spark, 2, 2, [], {1: [(0, 2)]}) == [("", None, [])] * 2
    cells, lines, words = _grid(spark, 2, 2, [(0, 0, "x")], {})
    assert headers.header_trees(headers.header_spans(cells.where("false"), lines, words)).count() == 0
    assert {r.raw_header for r in headers.header_trees(headers.header_spans(cells, lines.where("false"), words)).collect()} == {"x"}


def test_the_query_has_parents(spark):
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.001/{t}.parquet'")
    found = con.execute(f"SELECT count(*), count(parent_header) FROM ({region_queries.TREES_SQL}) AS t").fetchone()
    assert found[0] > found[1] > 1000
