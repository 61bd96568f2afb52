"""Queries over dictionaries that are tables: similar terms, and terms added in order, with SQL over all pairs."""

from __future__ import annotations

from tabulith.operators import similarity as sim

#: Terms made from the names, types and brands of parts; a suffix makes near ones.
HEADERS = "SELECT DISTINCT concat(p_name, ' ', p_type) AS term FROM {part}"
STORE = "SELECT DISTINCT concat(p_type, '  ', p_name, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN 's' ELSE '.' END) AS term, p_brand AS category FROM {part}"
OLD = "SELECT DISTINCT concat(p_name, ' -') AS term, p_type AS category FROM {part} WHERE p_size = 50"
_END = "CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN 's' WHEN 2 THEN '.' WHEN 3 THEN ' xx' ELSE ' no.' END"
NEW = f"SELECT min(p_partkey) AS i, concat(p_name, {_END}) AS term, p_type AS category FROM {{part}} GROUP BY p_name, {_END}, p_type"


def _terms(spark, d, sql):
    return spark.sql(sql, part=spark.read.parquet(f"{d}/part.parquet"))


def similar_terms(spark, d):
    return sim.similar_terms(_terms(spark, d, HEADERS), _terms(spark, d, STORE))


def best_terms(spark, d):
    return sim.best_terms(_terms(spark, d, HEADERS).withColumnRenamed("term", "header"), _terms(spark, d, STORE))


def terms_added(spark, d):
    return sim.add_terms(_terms(spark, d, OLD), _terms(spark, d, NEW), order=("i",)).select("term", "category")


_plain = lambda sql: sql.format(part="part")
_sorted = lambda c: f"array_to_string(list_sort(list_filter(string_split({c}, ' '), lambda t: t <> '')), ' ')"


def _ratio(a: str, b: str) -> str:
    """Score of two texts with sorted tokens: a fold over one's letters, each step a fold over the other's."""
    step = f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), lambda done, j: list_append(done, CASE WHEN unicode({b}[j[1]]) = c[1] THEN h[j[1]] + 1 ELSE greatest(done[-1], h[j[1] + 1]) END), [CAST(0 AS BIGINT)])"
    rows = f"list_reduce(list_transform(string_split({a}, ''), lambda ch: [CAST(unicode(ch) AS BIGINT)]), lambda h, c: {step}, list_transform(range(length({b}) + 1), lambda z: CAST(0 AS BIGINT)))"
    return f"(200e0 * ({rows})[-1] / (length({a}) + length({b})))"


#: What no similar pair can exceed, so that the fold runs over fewer pairs.
_NEAR = "levenshtein(x, y) <= 0.15e0 * (length(x) + length(y)) + 1e-9"
PAIRS = f"""a AS (SELECT term AS left_term, {_sorted('term')} AS x FROM ({_plain(HEADERS)}) AS h), b AS (SELECT DISTINCT term AS right_term, {_sorted('term')} AS y FROM ({_plain(STORE)}) AS s),
p AS MATERIALIZED (SELECT DISTINCT x, y FROM a, b WHERE {_NEAR}), r AS MATERIALIZED (SELECT x, y, {_ratio('x', 'y')} AS score FROM p),
m AS (SELECT left_term, right_term, score FROM a JOIN r USING (x) JOIN b USING (y) WHERE score >= 85)"""
BEST_SQL = f"""WITH {PAIRS}, w AS (SELECT left_term AS header, term, category, score, row_number() OVER (PARTITION BY left_term ORDER BY score DESC, term, category) AS n FROM m JOIN ({_plain(STORE)}) AS s ON term = right_term)
SELECT left_term AS header, term, category, score FROM a LEFT JOIN (SELECT * FROM w WHERE n = 1) AS t ON header = left_term"""
ADDED_SQL = f"""WITH RECURSIVE s AS (SELECT term, category, {_sorted('term')} AS x FROM ({_plain(OLD)}) AS o),
t AS (SELECT *, {_sorted('term')} AS x, row_number() OVER (PARTITION BY category ORDER BY i) AS n FROM ({_plain(NEW)}) AS o),
q AS (SELECT t.category, t.n, t.x, s.x AS y, CAST(0 AS BIGINT) AS ahead FROM t JOIN s USING (category) UNION ALL SELECT t.category, t.n, t.x, o.x, o.n FROM t JOIN t o ON o.category = t.category AND o.n < t.n),
d AS MATERIALIZED (SELECT DISTINCT x, y FROM q WHERE {_NEAR}), e AS MATERIALIZED (SELECT x, y FROM d WHERE {_ratio('x', 'y')} >= 85),
k AS MATERIALIZED (SELECT category, n, coalesce(list(ahead) FILTER (e.x IS NOT NULL), []) AS ahead FROM t LEFT JOIN q USING (category, n) LEFT JOIN e ON e.x = q.x AND e.y = q.y GROUP BY category, n),
go AS (SELECT DISTINCT category, CAST(0 AS BIGINT) AS n, [CAST(0 AS BIGINT)] AS kept FROM t
  UNION ALL SELECT go.category, k.n, CASE WHEN list_has_any(go.kept, k.ahead) THEN go.kept ELSE list_append(go.kept, k.n) END FROM go JOIN k ON k.category = go.category AND k.n = go.n + 1),
fin AS (SELECT category, unnest(arg_max(kept, n)) AS n FROM go GROUP BY category)
SELECT term, category FROM s UNION ALL SELECT term, category FROM t JOIN fin USING (category, n)"""

QUERIES = {
    "similar_terms": (similar_terms, f"WITH {PAIRS} SELECT * FROM m"),
    "best_terms": (best_terms, BEST_SQL),
    "terms_added": (terms_added, ADDED_SQL),
}
