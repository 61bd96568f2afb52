"""URL rules, and block decisions carried to aliases along redirects and canonical links.

Every rule is a host with a path prefix. A host's own rules and those of all domains above it are
looked up suffix by suffix in one literal map; the longest that fits decides. Pages that no rule
fits take the decision of their equivalence class: pages tied by redirects (given as edges, or a
meta refresh) and by canonical links. An explicit allow in the class outweighs its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm.components import components
from tabulith.llm.work import stash

#: (host, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A whole tag ends at the next bracket, so a page is read once; one with a bracket in an attribute before its end is no tag.
TAG = r"(?i)<(?:link|meta)\b[^<>]*>"
HREF = r"(?i)[\s\"'/]href\s*=\s*[\"']?([^\"'\s>]+)"
#: A value in quotes or up to white space, then the target in it.
CONTENT = r"(?i)[\s\"'/]content\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*)"
TARGET = r"(?i)\burl\s*=\s*['\"]?([^\"'\s>]+)"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty if url is null or has no ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, else null. Of equal rules allow wins."""
    by_host: dict[str, list[Column]] = {}
    for h, p, verdict in rules:
        by_host.setdefault(h, []).append(F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(int(verdict == "allow")).alias("allow"), F.lit(p).alias("path"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
    if not by_host:
        return F.lit(None).cast("struct<size:int,allow:int,path:string,rule:string,verdict:string>")
    table = F.create_map(*(x for h, r in by_host.items() for x in (F.lit(h), F.array(*r))))
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    found = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull()))
    return F.array_max(F.filter(found, lambda r: F.startswith(path, r["path"])))


def node(url: Column) -> Column:
    """The url by which pages are tied: without its fragment, A-Z of scheme and host lower-cased."""
    u = F.regexp_replace(url, r"(?s)#.*$", "")
    site = F.regexp_extract(u, r"^[^/?#]*://[^/?#]*", 0)
    return F.concat(F.translate(site, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.substring(u, F.length(site) + 1, F.length(u)))


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, its segments ``.`` and ``..`` carried out."""
    parts = F.slice(F.split(path, "/", -1), F.lit(2), F.length(path) + 1)
    dots = parts[F.size(parts) - 1].isin(".", "..")
    step = lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.concat(done, F.array(x)))
    left = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(left, "/"), F.when(dots & (F.size(left) > 0), "/").otherwise(""))


def resolved(target: Column, page: Column) -> Column:
    """A link's target as an absolute url; null if it has none (mail, script, or a page without a host)."""
    scheme, site = F.regexp_extract(page, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*:)//", 1), F.regexp_extract(page, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    own = F.regexp_extract(page, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.when(own == "", "/").otherwise(F.regexp_extract(own, r"(?s)^(.*/)", 1))
    return (
        F.when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), target)
        .when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")) | (site == "") | (target == ""), F.lit(None).cast("string"))
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, _without_dots(path), rest))
        .when(path == "", F.when(F.startswith(target, F.lit("#")), page).otherwise(F.concat(site, own, rest)))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, path)), rest))
    )


def _holds(name: str, attribute: str, value: str) -> Column:
    """Whether a tag has that name and an attribute that begins with that word."""
    return F.rlike("tag", F.lit(rf"(?i)^<{name}\b")) & F.rlike("tag", F.lit(rf"(?i)[\s\"'/]{attribute}\s*=\s*[\"']?{value}\b"))


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """edges(a, b) from all canonical links and meta refreshes of a page; relative targets count from its url.

    Time is in proportion to the page, however malformed: whole tags are cut out first, then looked into."""
    html = pages[html_col]
    some = pages.where(F.contains(F.lower(html), F.lit("canonical")) | F.contains(F.lower(html), F.lit("refresh")))
    tags = some.select(node(pages[url_col]).alias("a"), F.explode(F.regexp_extract_all(html, F.lit(TAG), F.lit(0))).alias("tag"))
    target = F.when(_holds("link", "rel", "canonical"), F.regexp_extract("tag", HREF, 1)).when(_holds("meta", "http-equiv", "refresh"), F.regexp_extract(F.regexp_extract("tag", CONTENT, 1), TARGET, 1))
    ties = tags.select("a", target.alias("b")).where("b is not null")
    ties = ties.select("a", resolved(F.replace("b", F.lit("&amp;"), F.lit("&")), F.col("a")).alias("b"))
    return ties.where("b is not null").select("a", node(F.col("b")).alias("b"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, alias_of.

    ``redirects(from_url, to_url)`` adds edges; urls that are no page still tie pages together, and
    rules judge them too. alias_of is the smallest url of the class, null where no edge touches the
    page. Null urls have no rule and no edge: allow. An empty table gives no rows.
    """
    edges = page_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node(F.col("from_url")).alias("a"), node(F.col("to_url")).alias("b")))
    classes = stash(components(edges), "classes")
    h, p = host_path(F.col("node"))
    judged = classes.select("component", rule_for(h, p, rules)["verdict"].alias("v"))
    of_class = judged.groupBy("component").agg(F.max((F.col("v") == "allow").cast("int")).alias("any_allow"), F.max((F.col("v") == "block").cast("int")).alias("any_block"))
    carried = classes.join(of_class, "component").select(F.col("node").alias("__node"), F.col("component").alias("alias_of"), F.when((F.col("any_block") == 1) & (F.coalesce("any_allow", F.lit(0)) == 0), "block").alias("carried"))
    host, path = host_path(pages[url_col])
    # pages without a url meet nothing: a key of their own keeps them from one task
    key = F.coalesce(node(pages[url_col]), F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string")))
    base = pages.select(pages[id_col].alias("page_id"), key.alias("__url"), host.alias("host"), path.alias("path"))
    base = base.withColumn("r", rule_for(F.col("host"), F.col("path"), rules))
    out = base.join(carried, F.col("__url") == F.col("__node"), "left")
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", "carried", F.lit("allow")).alias("verdict"), "alias_of")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP9_SQL = r"""
WITH RECURSIVE u AS (SELECT page_id, url AS full_url, regexp_replace(url, '(?s)#.*$', '') AS bare, html FROM pages),
n0 AS (SELECT *, translate(regexp_extract(bare, '^[^/?#]*://[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || substr(bare, length(regexp_extract(bare, '^[^/?#]*://[^/?#]*')) + 1) AS node FROM u),
found AS (SELECT node, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^<>]*>')) AS tag FROM n0),
tags AS (SELECT DISTINCT node, raw FROM (SELECT node, CASE WHEN regexp_matches(tag, '(?i)^<link\b') AND regexp_matches(tag, '(?i)[\s"''/]rel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?i)[\s"''/]href\s*=\s*["'']?([^"''\s>]+)', 1)
           WHEN regexp_matches(tag, '(?i)^<meta\b') AND regexp_matches(tag, '(?i)[\s"''/]http-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(regexp_extract(tag, '(?i)[\s"''/]content\s*=\s*("[^"]*"|''[^'']*''|[^\s>]*)', 1), '(?i)\burl\s*=\s*[''"]?([^"''\s>]+)', 1) END AS raw FROM found) AS f WHERE raw IS NOT NULL),
part AS (SELECT node, replace(raw, '&amp;', '&') AS t, regexp_extract(node, '(?s)^([A-Za-z][A-Za-z0-9+.-]*:)//', 1) AS scheme, regexp_extract(node, '(?s)^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS site,
           regexp_extract(node, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS own, regexp_extract(replace(raw, '&amp;', '&'), '(?s)^([^?#]*)', 1) AS path, regexp_extract(replace(raw, '&amp;', '&'), '(?s)^[^?#]*(.*)$', 1) AS rest FROM tags),
full_path AS (SELECT *, CASE WHEN starts_with(path, '/') THEN path ELSE CASE WHEN own = '' THEN '/' ELSE regexp_extract(own, '(?s)^(.*/)', 1) END || path END AS p FROM part),
plain AS (SELECT *, list_reduce(list_prepend('', string_split(p, '/')[2:]), lambda done, x: CASE WHEN x = '..' THEN regexp_replace(done, '/[^/]*$', '') WHEN x = '.' THEN done ELSE done || '/' || x END) AS q, string_split(p, '/')[-1] IN ('.', '..') AS dots FROM full_path),
target AS (SELECT node, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') OR site = '' OR t = '' THEN NULL WHEN starts_with(t, '//') THEN scheme || t
           WHEN path = '' AND NOT starts_with(t, '/') THEN CASE WHEN starts_with(t, '#') THEN node ELSE site || own || rest END
           ELSE site || CASE WHEN q = '' THEN '/' WHEN dots THEN q || '/' ELSE q END || rest END AS target FROM plain),
bare AS (SELECT node, regexp_replace(target, '(?s)#.*$', '') AS b FROM target WHERE target IS NOT NULL),
e AS (SELECT node AS a, translate(regexp_extract(b, '^[^/?#]*://[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || substr(b, length(regexp_extract(b, '^[^/?#]*://[^/?#]*')) + 1) AS b FROM bare),
tied AS (SELECT DISTINCT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach AS (SELECT a AS node, a AS other FROM tied UNION SELECT r.node, x.b FROM reach r JOIN tied x ON r.other = x.a),
nodes AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
urls AS (SELECT node AS url FROM nodes UNION SELECT full_url FROM n0 WHERE full_url IS NOT NULL),
rest AS (SELECT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM urls),
p AS (SELECT url, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM rest),
r AS (SELECT *, CASE
        WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM p),
v AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS ruled FROM r),
c AS (SELECT component, bool_or(ruled = 'block') AND NOT coalesce(bool_or(ruled = 'allow'), false) AS carried
      FROM nodes JOIN v ON v.url = nodes.node GROUP BY component)
SELECT u.page_id, coalesce(v.host, '') AS host, coalesce(v.path, '') AS path, v.rule,
       coalesce(v.ruled, CASE WHEN c.carried THEN 'block' END, 'allow') AS verdict, n.component AS alias_of
FROM n0 u LEFT JOIN v ON v.url = u.full_url LEFT JOIN nodes n ON n.node = u.node LEFT JOIN c ON c.component = n.component
"""
