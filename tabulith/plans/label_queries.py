"""Queries over labelled regions: from their files to the best settings, and regions found in their place, with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabulith.operators import labelled, scoring
from tabulith.plans import queries as q
from tabulith.sources import bridge as b
from tabulith.sources import stores
from tabulith.storage import shared_folder

ZONE = "CASE WHEN in_zone THEN struct(-2e0 AS x0, 90e0 AS y0, 600e0 AS x1, 300e0 AS y1) WHEN doc_id % 2 = 0 THEN struct(700e0 AS x0, 0e0 AS y0, 800e0 AS x1, 1200e0 AS y1) END"
REGION = "named_struct('label', concat('region ', region_index), 'expected_keep', expected, 'bbox', struct(x0, y0, x1, y1), 'structure_source', CASE WHEN structured THEN element_at(array('vector_grid', 'text_clustering'), cast(doc_id % 2 + 1 AS int)) ELSE 'none' END, 'header_texts', CASE doc_id % 3 WHEN 0 THEN array(header1, header2) WHEN 1 THEN array(header2, header1, header2) ELSE array('', header1, NULL, header2) END, 'row_count', row_count, 'col_count', col_count, 'nearby_title_regex_hit', CASE WHEN title_hit THEN true END)"


def _files(spark, d) -> str:
    """A folder of labelled pages, one for each order: an object a line."""
    folder = f"{shared_folder(spark)}/tabulith/labelled-{uuid.uuid4().hex}.jsonl"
    page = b.relation(spark, d, b.REGION).select(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("source_pdf"), F.lit(800.0).alias("page_width"), F.lit(1200.0).alias("page_height"), F.expr(ZONE).alias("title_block_zone"), F.array(F.expr(REGION)).alias("candidates"))
    page.write.json(folder)
    return folder


def label_tuning(spark, d):
    """Best ten settings of the whole grid for labelled regions that were written to files and read again."""
    return scoring.grid_search(labelled.labelled_regions(stores.load_labelled(spark, _files(spark, d)))).limit(10)


FOUND = "SELECT doc_id, page_no, CAST(k AS BIGINT) AS region_index, x0 + 60 * k + doc_id % 4 * 10 AS x0, y0 + 20 * (k % 2) AS y0, x1 + 60 * k AS x1, y1 + 5 * k AS y1, structured, in_zone, title_hit, row_count, col_count FROM ({region}) AS r CROSS JOIN (VALUES (0), (1), (2), (3)) AS c(k) WHERE k < 2 + doc_id % 3"
LABELS = "SELECT doc_id, page_no, CAST(k AS BIGINT) AS label_index, x0 + 45 * k AS x0, y0 + 10 * k AS y0, x1 + 45 * k + doc_id % 5 * 4 AS x1, y1 AS y1, (doc_id + k) % 3 > 0 AS expected FROM ({region}) AS r CROSS JOIN (VALUES (0), (1), (2), (3)) AS c(k) WHERE k < 1 + doc_id % 4"


def _both(spark, d):
    return [b.relation(spark, d, x.format(region=b.REGION)) for x in (FOUND, LABELS)]


def label_matches(spark, d):
    return labelled.match_labels(*_both(spark, d))


def label_metrics(spark, d):
    """Confusion counts and ratios of the default settings over labels by the regions found in their place, a row for each title."""
    found, labels = _both(spark, d)
    scored = found.withColumns({"allow_score": F.when(F.col("region_index") % 2 == 0, 100.0).otherwise(0.0), "deny_score": F.lit(0.0)})
    return scoring.metrics(scoring.region_scores(labelled.labelled_found(scored, labels)), ["label_index"])


MATCHED = f"""found AS ({FOUND.format(region="SELECT * FROM region_in")}), label AS ({LABELS.format(region="SELECT * FROM region_in")}),
cut AS (SELECT f.doc_id, f.page_no, region_index, label_index, greatest(least(f.x1, l.x1) - greatest(f.x0, l.x0), 0e0) * greatest(least(f.y1, l.y1) - greatest(f.y0, l.y0), 0e0) AS shared,
  (f.x1 - f.x0) * (f.y1 - f.y0) + (l.x1 - l.x0) * (l.y1 - l.y0) AS areas FROM found f JOIN label l ON l.doc_id = f.doc_id AND l.page_no = f.page_no),
pair AS (SELECT *, shared / (areas - shared) AS overlap FROM cut WHERE shared > 0 AND shared / (areas - shared) >= 0.5),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY overlap DESC, region_index, label_index) AS n FROM pair),
pass AS (SELECT doc_id, page_no, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS rs, CAST([] AS BIGINT[]) AS ls, CAST([] AS BIGINT[]) AS kept FROM ranked WHERE n = 1
  UNION ALL SELECT p.doc_id, p.page_no, r.n, list_append(rs, CASE WHEN ok THEN region_index END), list_append(ls, CASE WHEN ok THEN label_index END), list_append(kept, CASE WHEN ok THEN r.n END)
  FROM pass p JOIN ranked r ON r.doc_id = p.doc_id AND r.page_no = p.page_no AND r.n = p.n + 1 CROSS JOIN LATERAL (SELECT NOT list_contains(rs, region_index) AND NOT list_contains(ls, label_index) AS ok) AS o),
pick AS (SELECT doc_id, page_no, unnest(arg_max(kept, n)) AS n FROM pass GROUP BY doc_id, page_no),
matched AS (SELECT doc_id, page_no, region_index, label_index, overlap FROM ranked JOIN pick USING (doc_id, page_no, n))"""
MATCH_SQL = f"WITH RECURSIVE {q.WITH}, {MATCHED} SELECT * FROM matched"
METRIC_SQL = f"""WITH RECURSIVE {q.WITH}, {MATCHED}, s AS (SELECT l.label_index, l.expected, coalesce(CASE WHEN structured THEN 40 ELSE 0 END + CASE WHEN region_index % 2 = 0 THEN 45 ELSE 0 END + CASE WHEN in_zone THEN -30 ELSE 0 END + CASE WHEN title_hit THEN 15 ELSE 0 END
  + CASE WHEN row_count = 0 OR col_count = 0 THEN 0 WHEN col_count >= 5 THEN -10 ELSE 10 END, 0) >= 50 AS keep FROM label l LEFT JOIN matched m USING (doc_id, page_no, label_index) LEFT JOIN found f USING (doc_id, page_no, region_index)),
c AS (SELECT label_index, count(*) FILTER (keep AND expected) AS tp, count(*) FILTER (keep AND NOT expected) AS fp, count(*) FILTER (NOT keep AND NOT expected) AS tn, count(*) FILTER (NOT keep AND expected) AS fn FROM s GROUP BY label_index)
SELECT *, coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0.0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM c"""

QUERIES = {
    "label_tuning": (label_tuning, q.SEARCH_SQL),
    "label_matches": (label_matches, MATCH_SQL),
    "label_metrics": (label_metrics, METRIC_SQL),
}
