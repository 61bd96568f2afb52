"""Secrets in whole texts, and how many repositories and owners each candidate is found with.

Three patterns give the base spans. A fourth takes the longest stretches of letters, digits, - and _
that have a digit, a capital and a small letter, and no keyword. Every candidate value is hashed and counted over the corpus by distinct repositories and
owners: what many owners share, or few owners have in many repositories each, is a widely copied
example; the rest looks live, and such a token is reported as a span of kind ``live``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulith.llm.work import stash

#: kind: pattern (fixed values), in the order in which spans at one start are listed.
PATTERNS = {
    "assign": r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "live": r"[A-Za-z0-9_-]{20,}",
}
#: What a stretch of kind live must have each of; asked of its matches, as lookaheads would read on from every place.
LIVE_HAS = ("[0-9]", "[A-Z]", "[a-z]")
#: Least code points of the value of an assignment.
LEAST_VALUE = 6
#: A value with so many distinct owners or more is an example.
EXAMPLE_OWNERS = 3
#: So is one with so many distinct repositories or more for each of its owners.
EXAMPLE_REPOSITORIES = 20


def _gaps(text: Column, pattern: str) -> Column:
    """Code points before each match of a pattern since the last."""
    return F.transform(F.split(text, pattern, -1), F.length)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) for all rows of docs, and their spans: row, owner, repository, ord, kind, start, end, value."""
    text, names = F.coalesce(docs[text_col], F.lit("")), [f"m{i}" for i in range(len(PATTERNS))]
    whole = docs.select(docs[id_col].alias("doc_id"), docs[owner_col].cast("string").alias("owner"), docs[repository_col or id_col].cast("string").alias("repository"), text.alias("t"), *(F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(n) for n, p in zip(names, PATTERNS.values(), strict=True)))
    kinds = F.array(*(F.when(F.size(n) > 0, F.struct(F.lit(i).alias("ord"), F.lit(k).alias("kind"), F.struct(F.col(n).alias("m"), _gaps(F.col("t"), p).alias("gaps")).alias("f"))) for i, (n, (k, p)) in enumerate(zip(names, PATTERNS.items(), strict=True))))
    wide = whole.select("doc_id", "owner", "repository", F.filter(kinds, lambda x: x.isNotNull()).alias("kinds"))
    seen = stash(wide.withColumn("row", F.monotonically_increasing_id()), "candidates")
    each = seen.select("row", "owner", "repository", F.explode("kinds").alias("k"))
    each = each.select("row", "owner", "repository", "k.ord", "k.kind", F.posexplode(F.arrays_zip(F.col("k.f.m").alias("m"), F.slice("k.f.gaps", F.lit(1), F.size("k.f.m")).alias("gap"))).alias("i", "x"))
    w = Window.partitionBy("row", "ord").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("x.m")
    each = each.withColumn("end", F.sum(F.col("x.gap") + size).over(w))
    value = F.when(F.col("kind") == "assign", F.regexp_extract("x.m", PATTERNS["assign"], 2)).otherwise(F.col("x.m"))
    spans = each.select("row", "owner", "repository", "ord", "kind", (F.col("end") - size).alias("start"), "end", value.alias("value"))
    mixed = reduce(Column.__and__, (F.rlike("value", F.lit(x)) for x in LIVE_HAS))
    good = F.when(F.col("kind") == "assign", F.length("value") >= LEAST_VALUE).when(F.col("kind") == "live", mixed).otherwise(F.lit(True))
    return seen.select("row", "doc_id"), spans.where(good)


def frequencies(spans: DataFrame) -> DataFrame:
    """value_hash, owners, repositories, occurrences: distinct pairs first, so that no task holds a value's rows."""
    pairs = lambda c, n: spans.groupBy("value_hash", c).agg(F.count(F.lit(1)).alias("n")).groupBy("value_hash").agg(F.count(c).alias(n), F.sum("n").alias("occurrences"))
    return pairs("owner", "owners").join(pairs("repository", "repositories").drop("occurrences"), "value_hash")


def scan(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES, **columns) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, candidates.

    candidates has each span, the live ones of examples too, with its value's owners and repositories. Spans are kind:start:end by code points, end exclusive. n_live and n_example count the candidates
    of either standing. Null text is empty; an owner or repository that is null counts as none, so a
    value found only with null repositories and owners looks live. Rows alike are counted as rows but share owner and repository.
    """
    rows, spans = candidates(docs, **columns)
    spans = stash(spans.select("row", "owner", "repository", "ord", "kind", "start", "end", F.xxhash64("value", F.length("value")).alias("value_hash")), "spans")
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories * F.greatest("owners", F.lit(1)))
    known = frequencies(spans).select("value_hash", "owners", "repositories", copied.alias("example"))
    judged = spans.select("row", "ord", "kind", "start", "end", "value_hash").join(known, "value_hash")
    shown = (F.col("kind") != "live") | ~F.col("example")
    span = F.struct("start", "ord", F.concat_ws(":", "kind", "start", "end").alias("s"))
    of = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{k}")
    found = F.struct("start", "ord", F.concat_ws(":", "kind", "start", "end").alias("span"), "owners", "repositories", "example")
    per_row = judged.groupBy("row").agg(of("assign"), of("access"), of("hex"), F.count_if(shown & ~F.col("example")).alias("n_live"), F.count_if(shown & F.col("example")).alias("n_example"), F.array_sort(F.collect_list(F.when(shown, span))).alias("all"), F.array_sort(F.collect_list(found)).alias("found"))
    listed = lambda a: F.array_join(F.transform(a, lambda x: x["s"]), ",")
    base = F.filter("all", lambda x: x["ord"] < list(PATTERNS).index("live"))
    per_row = per_row.select(F.col("row").alias("found_row"), "n_assign", "n_access", "n_hex", listed(base).alias("base"), listed(F.col("all")).alias("spans"), "n_live", "n_example", F.transform("found", lambda x: x.dropFields("start", "ord")).alias("candidates"))
    out = rows.join(per_row, F.col("row") == F.col("found_row"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), zero("n_live"), zero("n_example"), F.coalesce("candidates", F.array()).alias("candidates"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
