"""The layout queries, each with SQL written apart from its operator."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.functions import vocab
from tabulith.functions.text import humanised, rebar_groups, snake_case
from tabulith.operators import geometry as g
from tabulith.operators import scoring as s
from tabulith.sources import bridge as b

WITH = ", ".join(f"{n} AS ({b.plain(q)})" for n, q in (("word", b.WORD), ("segment", b.SEGMENT), ("block", b.BLOCK), ("region_in", b.REGION)))


def _case(notes: bool) -> str:
    kinds = vocab.SCHEDULE_TITLES | (vocab.NOTES_TITLES if notes else {})
    whens = " ".join(f"WHEN {' OR '.join(f'''regexp_matches(t, '{p}')''' for p in ps)} THEN '{k}'" for k, ps in kinds.items())
    return f"CASE WHEN regexp_matches(t, 'revision\\s+schedule') THEN NULL {whens} END"


def anchors_sql(notes: bool) -> str:
    return f"anchor AS (SELECT * FROM (SELECT *, {_case(notes)} AS table_type FROM (SELECT *, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS t FROM block WHERE block_type = 0) AS n) AS k WHERE table_type IS NOT NULL)"


def anchor_titles(spark, d):
    return s.anchors(b.relation(spark, d, b.BLOCK), notes=True).select("doc_id", "page_no", "block_seq", "table_type")


def anchor_type_counts(spark, d):
    return s.anchors(b.relation(spark, d, b.BLOCK)).groupBy("table_type").agg(F.count(F.lit(1)).alias("n"))


def rebar_parse(spark, d):
    w = b.relation(spark, d, b.WORD)
    groups = w.select("doc_id", "word_seq", F.posexplode(rebar_groups(F.col("text"))).alias("i", "x"))
    return groups.select("doc_id", "word_seq", F.col("i").cast("long").alias("i"), F.col("x.count").cast("long").alias("n_bars"), F.col("x.bar_type").alias("bar_type"), F.col("x.diameter_mm").alias("diameter_mm"), F.col("x.spacing_mm").cast("long").alias("spacing_mm"))


_P = {k: getattr(vocab, k) for k in ("DIAMETER_SPACING", "TYPE_SPACING", "COUNT_DIAMETER", "COUNT_TYPE", "MILLIMETRES")}
REBAR_SQL = f"""WITH {WITH}, t AS (SELECT doc_id, word_seq, unnest(string_split(text, '+')) AS tok, generate_subscripts(string_split(text, '+'), 1) AS o FROM word),
m AS (SELECT *, CASE {' '.join(f"WHEN regexp_matches(tok, '{p}') THEN {i}" for i, p in enumerate(_P.values()))} END AS k FROM t),
n AS (SELECT *, {', '.join(f"regexp_extract(tok, '{p}', {j}) AS g{i}{j}" for i, p in enumerate(_P.values()) for j in (1, 2))} FROM m WHERE k IS NOT NULL)
SELECT doc_id, word_seq, row_number() OVER (PARTITION BY doc_id, word_seq ORDER BY o) - 1 AS i,
 TRY_CAST(CASE k WHEN 2 THEN g21 WHEN 3 THEN g31 WHEN 4 THEN g41 END AS BIGINT) AS n_bars,
 upper(CASE k WHEN 1 THEN g11 WHEN 3 THEN g32 END) AS bar_type,
 TRY_CAST(CASE k WHEN 0 THEN g01 WHEN 2 THEN g22 WHEN 4 THEN g42 END AS DOUBLE) AS diameter_mm,
 TRY_CAST(CASE k WHEN 0 THEN g02 WHEN 1 THEN g12 END AS BIGINT) AS spacing_mm FROM n"""


def _rulings(spark, d):
    return g.classify_segments(b.relation(spark, d, b.SEGMENT))


RULING = """ruling AS (SELECT doc_id, page_no, CASE WHEN abs(p2y - p1y) < 2 THEN 'horizontal' ELSE 'vertical' END AS orientation,
  CASE WHEN abs(p2y - p1y) < 2 THEN (p1y + p2y) / 2 ELSE (p1x + p2x) / 2 END AS position,
  CASE WHEN abs(p2y - p1y) < 2 THEN least(p1x, p2x) ELSE least(p1y, p2y) END AS "start",
  CASE WHEN abs(p2y - p1y) < 2 THEN greatest(p1x, p2x) ELSE greatest(p1y, p2y) END AS "end"
  FROM segment WHERE kind = 'l' AND sqrt((p2x - p1x) ** 2 + (p2y - p1y) ** 2) >= 5 AND (abs(p2y - p1y) < 2 OR abs(p2x - p1x) < 2))"""
MERGED = """far AS (SELECT *, CASE WHEN position - lag(position) OVER (PARTITION BY doc_id, page_no, orientation ORDER BY position) > 2 THEN 1 ELSE 0 END AS f FROM ruling),
isl AS (SELECT *, sum(f) OVER (PARTITION BY doc_id, page_no, orientation ORDER BY position RANGE UNBOUNDED PRECEDING) AS i FROM far),
merged AS MATERIALIZED (SELECT doc_id, page_no, orientation, avg(position) AS position, min("start") AS "start", max("end") AS "end" FROM isl GROUP BY doc_id, page_no, orientation, i)"""
TRIMMED = """nxt AS MATERIALIZED (SELECT *, lead(y) OVER (PARTITION BY doc_id, page_no ORDER BY y) AS n FROM (SELECT DISTINCT doc_id, page_no, round_even(position, 1) AS y FROM merged WHERE orientation = 'horizontal') AS k),
bot AS MATERIALIZED (SELECT doc_id, page_no, coalesce(min(y) FILTER (n - y > 40), max(y)) AS bottom FROM nxt GROUP BY ALL HAVING count(*) >= 2),
trimmed AS (SELECT m.* FROM merged m LEFT JOIN bot USING (doc_id, page_no) WHERE orientation = 'vertical' OR bottom IS NULL OR position <= bottom + 1)"""
CELL = """ys AS (SELECT doc_id, page_no, y AS y0, lead(y) OVER w AS y1, row_number() OVER w - 1 AS r FROM (SELECT DISTINCT doc_id, page_no, round_even(position, 1) AS y FROM merged WHERE orientation = 'horizontal') AS a WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY y)),
xs AS (SELECT doc_id, page_no, x AS x0, lead(x) OVER w AS x1, row_number() OVER w - 1 AS c FROM (SELECT DISTINCT doc_id, page_no, round_even(position, 1) AS x FROM merged WHERE orientation = 'vertical') AS a WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY x)),
cell AS (SELECT doc_id, page_no, r, c, x0, y0, x1, y1 FROM ys JOIN xs USING (doc_id, page_no) WHERE y1 IS NOT NULL AND x1 IS NOT NULL)"""


def _cells(spark, d):
    return g.grid_cells(g.merge_collinear(_rulings(spark, d)))


def _rows(spark, d):
    return g.text_rows(b.relation(spark, d, b.WORD))


ROWS = """ranked AS (SELECT *, (y0 + y1) / 2 AS cy, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY (y0 + y1) / 2, word_seq) AS i FROM word),
fold AS (SELECT doc_id, page_no, i, cy AS total, 1 AS n, 0 AS "row" FROM ranked WHERE i = 1 UNION ALL
  SELECT w.doc_id, w.page_no, w.i, CASE WHEN abs(w.cy - f.total / f.n) <= 6 THEN f.total + w.cy ELSE w.cy END,
         CASE WHEN abs(w.cy - f.total / f.n) <= 6 THEN f.n + 1 ELSE 1 END, CASE WHEN abs(w.cy - f.total / f.n) <= 6 THEN f."row" ELSE f."row" + 1 END
  FROM fold f JOIN ranked w ON w.doc_id = f.doc_id AND w.page_no = f.page_no AND w.i = f.i + 1),
rowed AS (SELECT r.*, (x0 + x1) / 2 AS cx, f."row" FROM ranked r JOIN fold f USING (doc_id, page_no, i))"""
CELLS = """cut AS (SELECT *, CASE WHEN x0 - lag(x1) OVER o > 8 THEN 1 ELSE 0 END AS f FROM rowed WINDOW o AS (PARTITION BY doc_id, page_no, "row" ORDER BY cx, word_seq)),
celled AS (SELECT *, sum(f) OVER (PARTITION BY doc_id, page_no, "row" ORDER BY cx, word_seq) AS cell FROM cut),
tcell AS (SELECT doc_id, page_no, "row", cell, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, string_agg(text, ' ' ORDER BY cx, word_seq) AS text FROM celled GROUP BY doc_id, page_no, "row", cell)"""


def _long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def largest_gap_split(spark, d):
    return _long(g.largest_gap(_rows(spark, d)), "row")


GAP_SQL = f"""WITH RECURSIVE {WITH}, {ROWS},
w AS (SELECT *, row_number() OVER o AS j, lead(x0) OVER o - x1 AS gap FROM rowed WINDOW o AS (PARTITION BY doc_id, page_no, "row" ORDER BY cx, word_seq)),
c AS (SELECT doc_id, page_no, "row", coalesce((array_agg(j ORDER BY gap DESC, j) FILTER (gap > -1))[1], 1) AS cut FROM w GROUP BY ALL)
SELECT doc_id, page_no, CAST("row" AS BIGINT) AS "row", coalesce(string_agg(text, ' ' ORDER BY j) FILTER (j <= cut), '') AS left_text, coalesce(string_agg(text, ' ' ORDER BY j) FILTER (j > cut), '') AS right_text
FROM w JOIN c USING (doc_id, page_no, "row") GROUP BY ALL"""


def header_exact(spark, d):
    r = b.relation(spark, d, b.REGION)
    h = r.select("doc_id", F.explode(F.array("header1", "header2")).alias("raw_header"))
    return s.header_fields(h)


_ALIASES = {}
for _field, _names in vocab.HEADER_ALIASES.items():
    for _a in _names:
        _ALIASES.setdefault(_a, _field)
ALIAS_VALUES = ", ".join(f"('{a}', '{f}')" for a, f in _ALIASES.items())
HEADER_SQL = f"""WITH {WITH}, h AS (SELECT doc_id, header1 AS raw_header FROM region_in UNION ALL SELECT doc_id, header2 FROM region_in)
SELECT doc_id, raw_header, f AS canonical_field FROM h LEFT JOIN (VALUES {ALIAS_VALUES}) AS a(alias, f) ON lower(regexp_replace(trim(raw_header), '\\s+', ' ', 'g')) = alias"""


def _scored_inputs(spark, d):
    """regions with their best dictionary scores: distinct headers are scored once."""
    r = b.relation(spark, d, b.REGION)
    heads = r.select("doc_id", F.explode(F.array("header1", "header2")).alias("header"))
    best = heads.select("header").distinct()
    for name, terms in (("allow_score", vocab.ALLOW), ("deny_score", vocab.DENY)):
        best = best.join(s.dictionary_hits(best, terms).select("header", F.col("score").alias(name)), "header")
    of_doc = heads.join(best, "header").groupBy("doc_id").agg(F.max("allow_score").alias("allow_score"), F.max("deny_score").alias("deny_score"))
    return r.join(of_doc, "doc_id")


def token_sort_match(spark, d):
    heads = b.relation(spark, d, b.REGION).select(F.explode(F.array("header1", "header2")).alias("header"))
    return s.dictionary_hits(heads, vocab.ALLOW)


def region_score(spark, d):
    return s.region_scores(_scored_inputs(spark, d)).select("doc_id", "region_index", "confidence", "keep")


def score_metrics(spark, d):
    return s.metrics(s.region_scores(_scored_inputs(spark, d)), ["row_count"])


def _in(col: str, terms: dict) -> str:
    return f"rtrim({col}, '.') IN ({', '.join(repr(t.rstrip('.')) for ts in terms.values() for t in ts)})"


SCORED = f"""hit AS (SELECT *, ({_in('header1', vocab.ALLOW)} OR {_in('header2', vocab.ALLOW)}) AS allow, ({_in('header1', vocab.DENY)} OR {_in('header2', vocab.DENY)}) AS deny FROM region_in),
scored AS (SELECT *, CAST(CASE WHEN structured THEN 40 ELSE 0 END + CASE WHEN allow THEN 45 ELSE 0 END + CASE WHEN deny THEN -70 ELSE 0 END + CASE WHEN in_zone THEN -30 ELSE 0 END
  + CASE WHEN title_hit THEN 15 ELSE 0 END + CASE WHEN row_count = 0 OR col_count = 0 THEN 0 WHEN col_count >= 5 THEN -10 ELSE 10 END AS BIGINT) AS confidence FROM hit)"""
METRICS_SQL = f"""WITH {WITH}, {SCORED}, c AS (SELECT row_count, count(*) FILTER (confidence >= 50 AND expected) AS tp, count(*) FILTER (confidence >= 50 AND NOT expected) AS fp,
  count(*) FILTER (confidence < 50 AND NOT expected) AS tn, count(*) FILTER (confidence < 50 AND expected) AS fn FROM scored GROUP BY row_count)
SELECT *, coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0.0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM c"""
#: Values of three weights and the threshold that the tuning query tries, in product order.
GRID = {"structure_found": (30, 40, 50), "allow_list": (35, 45, 55), "nearby_title": (10, 15, 20), "threshold": (40, 50, 60)}


def tuning_grid_top(spark, d):
    """Best ten settings by accuracy, product order on ties. Regions are first counted by what the
    settings can tell apart, so the cross join is settings x at most 2 ** 6 x shapes rows."""
    flags = _scored_inputs(spark, d).select("structured", (F.col("allow_score") >= vocab.FUZZY_THRESHOLD).alias("allow"), (F.col("deny_score") >= vocab.FUZZY_THRESHOLD).alias("deny"), "in_zone", "title_hit", F.when((F.col("row_count") == 0) | (F.col("col_count") == 0), 0).when(F.col("col_count") >= 5, -10).otherwise(10).alias("shape"), "expected")
    kinds = flags.groupBy(*flags.columns).agg(F.count(F.lit(1)).alias("n"))
    combos = spark.createDataFrame([(i, *c) for i, c in enumerate(product(*GRID.values()))], "combo_id long, structure_found long, allow_list long, nearby_title long, threshold long")
    on = lambda f, w: F.when(F.col(f), F.col(w) if isinstance(w, str) else F.lit(w)).otherwise(0)
    score = on("structured", "structure_found") + on("allow", "allow_list") + on("deny", -70) + on("in_zone", -30) + on("title_hit", "nearby_title") + F.col("shape")
    right = (score >= F.col("threshold")) == F.col("expected")
    found = kinds.crossJoin(F.broadcast(combos)).groupBy(*combos.columns).agg((F.sum(F.when(right, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    return found.orderBy(F.desc("accuracy"), "combo_id").limit(10)


_VALUES = ", ".join(f"({i}, {', '.join(map(str, c))})" for i, c in enumerate(product(*GRID.values())))
TUNING_SQL = f"""WITH {WITH}, {SCORED}, combo(combo_id, structure_found, allow_list, nearby_title, threshold) AS (VALUES {_VALUES}),
t AS (SELECT combo.*, count(*) FILTER ((CASE WHEN structured THEN structure_found ELSE 0 END + CASE WHEN allow THEN allow_list ELSE 0 END + CASE WHEN deny THEN -70 ELSE 0 END + CASE WHEN in_zone THEN -30 ELSE 0 END
  + CASE WHEN title_hit THEN nearby_title ELSE 0 END + CASE WHEN row_count = 0 OR col_count = 0 THEN 0 WHEN col_count >= 5 THEN -10 ELSE 10 END >= threshold) = expected) / count(*) AS accuracy
  FROM scored CROSS JOIN combo GROUP BY ALL)
SELECT CAST(combo_id AS BIGINT) AS combo_id, CAST(structure_found AS BIGINT) AS structure_found, CAST(allow_list AS BIGINT) AS allow_list, CAST(nearby_title AS BIGINT) AS nearby_title, CAST(threshold AS BIGINT) AS threshold, accuracy
FROM t ORDER BY accuracy DESC, combo_id LIMIT 10"""



def tuning_grid_search(spark, d):
    """Best ten of the whole grid of eight parameters by accuracy, product order on ties."""
    return s.grid_search(_scored_inputs(spark, d)).limit(10)


# Of the bridge's headers only 'Ref No' is near a term without being it: 92.3 with 'Ref No.'.
_PLAIN = ", ".join(repr(t) for ts in vocab.ALLOW.values() for t in ts)
SEARCH_SQL = f"""WITH {WITH}, {SCORED},
{", ".join(f"p{i}({k}, o{i}) AS (VALUES {', '.join(f'({v}e0, {j})' for j, v in enumerate(vs))})" for i, (k, vs) in enumerate(s.DEFAULT_GRID.items()))},
combo AS (SELECT *, {" + ".join(f"o{i} * {3 ** (7 - i)}" for i in range(8))} AS combo_id FROM p0, p1, p2, p3, p4, p5, p6, p7),
kind AS (SELECT structured, allow, header1 IN ({_PLAIN}) OR header2 IN ({_PLAIN}) AS same, deny, in_zone, title_hit, CASE WHEN row_count = 0 OR col_count = 0 THEN 0 WHEN col_count >= 5 THEN -1 ELSE 1 END AS shape, expected, count(*) AS n FROM scored GROUP BY ALL),
kept AS (SELECT combo.*, n, expected, CASE WHEN structured THEN structure_found ELSE 0 END + CASE WHEN CASE WHEN fuzzy_threshold > 92.4 THEN same ELSE allow END THEN allow_list ELSE 0 END + CASE WHEN deny THEN deny_list ELSE 0 END
  + CASE WHEN in_zone THEN inside_title_block ELSE 0 END + CASE WHEN title_hit THEN nearby_title ELSE 0 END + shape * shape_sanity >= confidence_threshold AS keep FROM kind CROSS JOIN combo),
t AS (SELECT combo_id, {", ".join(s.DEFAULT_GRID)}, coalesce(sum(n) FILTER (keep AND expected), 0) AS tp, coalesce(sum(n) FILTER (keep AND NOT expected), 0) AS fp,
  coalesce(sum(n) FILTER (NOT keep AND NOT expected), 0) AS tn, coalesce(sum(n) FILTER (NOT keep AND expected), 0) AS fn FROM kept GROUP BY ALL)
SELECT CAST(combo_id AS BIGINT) AS combo_id, {", ".join(f"CAST({k} AS DOUBLE) AS {k}" for k in s.DEFAULT_GRID)}, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
  (tp + tn) / (tp + fp + tn + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1
FROM t ORDER BY accuracy DESC, combo_id LIMIT 10"""

def tuning_summary(spark, d):
    """How many settings of the whole grid tie at the best accuracy, and how many sources that rests on."""
    regions = _scored_inputs(spark, d)
    return s.search_summary(s.grid_search(regions), regions)


_SEARCHED, _, _LAST = SEARCH_SQL.rpartition("SELECT CAST(combo_id")
SUMMARY_SQL = f"""{_SEARCHED}SELECT (SELECT count(DISTINCT doc_id) FROM region_in) AS n_sources, count(*) AS n_settings, max(accuracy) AS best, count(*) FILTER (accuracy = top) AS n_best
FROM (SELECT accuracy, max(accuracy) OVER () AS top FROM (SELECT (tp + tn) / (tp + fp + tn + fn) AS accuracy FROM t) AS a) AS b"""

#: Longest common subsequences by a bit vector over the sorted tokens of a header, one character of a term at a time.
_SORTED = lambda c: f"array_to_string(list_sort(list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> '')), ' ')"
TOKEN_SQL = f"""WITH RECURSIVE {WITH}, h AS (SELECT header1 AS header FROM region_in UNION SELECT header2 FROM region_in),
terms(o, category, term) AS (VALUES {", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate((c, t) for c, ts in vocab.ALLOW.items() for t in ts))}),
pair AS (SELECT *, {_SORTED('header')} AS a, {_SORTED('term')} AS z FROM h CROSS JOIN terms),
bits AS (SELECT header, o, a, z, 0 AS i, (CAST(1 AS BIGINT) << len(a)) - 1 AS v FROM pair UNION ALL
  SELECT header, o, a, z, i + 1, ((v + (v & m)) | (v - (v & m))) & ((CAST(1 AS BIGINT) << len(a)) - 1) FROM (SELECT *, CAST(list_sum(list_transform(range(1, len(a) + 1), lambda k: CASE WHEN a[k] = z[i + 1] THEN CAST(1 AS BIGINT) << (k - 1) ELSE 0 END)) AS BIGINT) AS m FROM bits WHERE i < len(z)) AS b),
scored AS (SELECT header, o, 200e0 * (len(a) - bit_count(v)) / (len(a) + len(z)) AS score FROM bits WHERE i = len(z))
SELECT header, arg_max(term, [score, -o]) AS term, arg_max(category, [score, -o]) AS category, max(score) AS score FROM scored JOIN terms USING (o) GROUP BY header"""

RECT = f"""SELECT doc_id, page_no, block_seq AS drawing_seq, x0 * (1 + doc_id % 3) AS x0, y0, x1 * (1 + doc_id % 3) AS x1, y1 + block_seq * 10 AS y1, 800e0 AS width FROM ({b.BLOCK}) AS k"""


def title_zone(spark, d):
    return s.title_zones(b.relation(spark, d, RECT))


ZONE_SQL = f"""WITH rect AS ({b.plain(RECT)}),
m AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY (x1 - x0) * (y1 - y0) DESC, drawing_seq) AS i FROM rect WHERE greatest(0, x1 - greatest(x0, width * 0.72e0)) / greatest(1, x1 - x0) > 0.6)
SELECT doc_id, page_no, x0, y0, x1, y1 FROM m WHERE i = 1"""


def nearby_title(spark, d):
    return s.nearby_titles(b.relation(spark, d, b.REGION), b.relation(spark, d, b.BLOCK)).select("doc_id", "region_index", "title")


NEARBY_SQL = f"""WITH {WITH}, {anchors_sql(True)}
SELECT r.doc_id, r.region_index, arg_min(a.text, a.block_seq) AS title FROM region_in r LEFT JOIN anchor a
ON a.doc_id = r.doc_id AND a.page_no = r.page_no AND a.x0 < r.x1 + 40 AND r.x0 - 40 < a.x1 AND a.y0 < r.y1 + 40 AND r.y0 - 40 < a.y1 GROUP BY r.doc_id, r.region_index"""


def uncovered_blocks(spark, d):
    return s.uncovered(b.relation(spark, d, b.BLOCK), b.relation(spark, d, b.REGION)).select("doc_id", "block_seq", "text")


UNCOVERED_SQL = f"""WITH {WITH} SELECT doc_id, block_seq, text FROM block b WHERE block_type = 0 AND NOT EXISTS
(SELECT 1 FROM region_in r WHERE r.doc_id = b.doc_id AND r.page_no = b.page_no AND b.x0 < r.x1 AND r.x0 < b.x1 AND b.y0 < r.y1 AND r.y0 < b.y1)"""


def presentation_rows(spark, d):
    """One flat record a table row: readable field names and values, empty values null."""
    r = b.relation(spark, d, b.REGION)
    h = r.select("doc_id", "region_index", F.posexplode(F.array("header1", "header2")).alias("i", "raw_header"))
    named = s.header_fields(h)
    return named.select("doc_id", F.col("i").cast("long").alias("i"), humanised(F.coalesce("canonical_field", snake_case(F.col("raw_header")))).alias("name"), F.nullif(F.trim("raw_header"), F.lit("")).alias("value"))


PRESENTATION_SQL = f"""WITH {WITH}, h AS (SELECT doc_id, 0 AS i, header1 AS raw_header FROM region_in UNION ALL SELECT doc_id, 1, header2 FROM region_in),
n AS (SELECT doc_id, CAST(i AS BIGINT) AS i, raw_header, coalesce(f, regexp_replace(regexp_replace(lower(trim(raw_header)), '[^a-z0-9\\s]', '', 'g'), '\\s+', '_', 'g')) AS name
  FROM h LEFT JOIN (VALUES {ALIAS_VALUES}) AS a(alias, f) ON lower(regexp_replace(trim(raw_header), '\\s+', ' ', 'g')) = alias)
SELECT doc_id, i, array_to_string(list_transform(string_split(replace(name, '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name, nullif(trim(raw_header), '') AS value FROM n"""


def full_extract(spark, d):
    """Flagship: words of a page to rows, cells and their groups, under the page's title."""
    cells = g.text_cells(_rows(spark, d))
    titles = s.anchors(b.relation(spark, d, b.BLOCK)).groupBy("doc_id", "page_no").agg(F.min_by("table_type", "block_seq").alias("table_type"))
    out = cells.join(titles, ["doc_id", "page_no"]).withColumn("groups", rebar_groups(F.col("text")))
    return _long(out.select("doc_id", "page_no", "table_type", "row", "cell", "text", F.coalesce(F.size("groups"), F.lit(0)).alias("n_groups")), "row", "cell", "n_groups")


FULL_SQL = f"""WITH RECURSIVE {WITH}, {ROWS}, {CELLS}, {anchors_sql(False)},
title AS (SELECT doc_id, page_no, arg_min(table_type, block_seq) AS table_type FROM anchor GROUP BY ALL)
SELECT doc_id, page_no, table_type, CAST("row" AS BIGINT) AS "row", CAST(cell AS BIGINT) AS cell, text,
  CAST(len(list_filter(string_split(text, '+'), lambda x: {' OR '.join(f"regexp_matches(x, '{p}')" for p in _P.values())})) AS BIGINT) AS n_groups
FROM tcell JOIN title USING (doc_id, page_no)"""

QUERIES = {
    "full_extract": (full_extract, FULL_SQL),
    "anchor_titles": (anchor_titles, f"WITH {WITH}, {anchors_sql(True)} SELECT doc_id, page_no, block_seq, table_type FROM anchor"),
    "anchor_type_counts": (anchor_type_counts, f"WITH {WITH}, {anchors_sql(False)} SELECT table_type, count(*) AS n FROM anchor GROUP BY table_type"),
    "rebar_parse": (rebar_parse, REBAR_SQL),
    "segment_classify": (_rulings, f"WITH {WITH}, {RULING} SELECT * FROM ruling"),
    "collinear_merge": (lambda x, d: g.merge_collinear(_rulings(x, d)), f"WITH {WITH}, {RULING}, {MERGED} SELECT * FROM merged"),
    "region_bottom_trim": (lambda x, d: g.trim_bottom(g.merge_collinear(_rulings(x, d))), f"WITH {WITH}, {RULING}, {MERGED}, {TRIMMED} SELECT * FROM trimmed"),
    "grid_cells": (_cells, f"WITH {WITH}, {RULING}, {MERGED}, {CELL} SELECT * FROM cell"),
    "cell_text": (lambda x, d: g.cell_text(b.relation(x, d, b.WORD), _cells(x, d)), f"""WITH {WITH}, {RULING}, {MERGED}, {CELL}
SELECT c.doc_id, c.page_no, c.r, c.c, coalesce(string_agg(w.text, ' ' ORDER BY w.word_seq), '') AS text FROM cell c LEFT JOIN word w ON w.doc_id = c.doc_id AND w.page_no = c.page_no
AND (w.x0 + w.x1) / 2 BETWEEN c.x0 AND c.x1 AND (w.y0 + w.y1) / 2 BETWEEN c.y0 AND c.y1 GROUP BY c.doc_id, c.page_no, c.r, c.c"""),
    "text_rows": (lambda x, d: _long(_rows(x, d).select("doc_id", "page_no", "word_seq", "row"), "row"), f'WITH RECURSIVE {WITH}, {ROWS} SELECT doc_id, page_no, word_seq, CAST("row" AS BIGINT) AS "row" FROM rowed'),
    "text_cells": (lambda x, d: _long(g.text_cells(_rows(x, d)), "row", "cell"), f'WITH RECURSIVE {WITH}, {ROWS}, {CELLS} SELECT * REPLACE (CAST("row" AS BIGINT) AS "row", CAST(cell AS BIGINT) AS cell) FROM tcell'),
    "column_grid": (lambda x, d: _long(g.column_grid(g.text_cells(_rows(x, d))), "place"), f"""WITH RECURSIVE {WITH}, {ROWS}, {CELLS},
n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page_no, "row") AS n FROM tcell), m AS (SELECT *, max(n) OVER (PARTITION BY doc_id, page_no) AS most FROM n WHERE n >= 2),
e AS (SELECT doc_id, page_no, cell AS place, CASE WHEN cell = 0 THEN x0 ELSE (lag(x1) OVER (PARTITION BY doc_id, page_no, "row" ORDER BY cell) + x0) / 2 END AS edge FROM m WHERE n = most
  UNION ALL SELECT doc_id, page_no, n, x1 FROM m WHERE n = most AND cell = n - 1)
SELECT doc_id, page_no, CAST(place AS BIGINT) AS place, avg(edge) AS edge FROM e GROUP BY ALL"""),
    "row_bounds": (lambda x, d: _long(g.row_bounds(_rows(x, d)), "place"), f"""WITH RECURSIVE {WITH}, {ROWS}, r AS (SELECT doc_id, page_no, "row", min(y0) AS y0, max(y1) AS y1 FROM rowed GROUP BY ALL)
SELECT doc_id, page_no, CAST("row" AS BIGINT) AS place, coalesce((lag(y1) OVER (PARTITION BY doc_id, page_no ORDER BY "row") + y0) / 2, y0) AS edge FROM r
UNION ALL SELECT doc_id, page_no, CAST(max("row") + 1 AS BIGINT), arg_max(y1, "row") FROM r GROUP BY doc_id, page_no"""),
    "largest_gap_split": (largest_gap_split, GAP_SQL),
    "header_exact": (header_exact, HEADER_SQL),
    "token_sort_match": (token_sort_match, TOKEN_SQL),
    "title_zone": (title_zone, ZONE_SQL),
    "nearby_title": (nearby_title, NEARBY_SQL),
    "uncovered_blocks": (uncovered_blocks, UNCOVERED_SQL),
    "region_score": (region_score, f"WITH {WITH}, {SCORED} SELECT doc_id, region_index, confidence, confidence >= 50 AS keep FROM scored"),
    "score_metrics": (score_metrics, METRICS_SQL),
    "tuning_grid_top": (tuning_grid_top, TUNING_SQL),
    "tuning_grid_search": (tuning_grid_search, SEARCH_SQL),
    "tuning_summary": (tuning_summary, SUMMARY_SQL),
    "presentation_rows": (presentation_rows, PRESENTATION_SQL),
}
