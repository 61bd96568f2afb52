"""Column expressions on texts: normalising, titles, cell notation, token-sort similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulith.functions import vocab


def normalised(text: Column) -> Column:
    """White space collapsed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def title_type(text: Column, notes: bool = False) -> Column:
    """Type of a title text, null if none fits or an exclusion does; schedules go before notes."""

    def kind_of(t: Column) -> Column:
        hit = lambda patterns: t.rlike("|".join(patterns))
        out = F.when(hit(vocab.EXCLUDED_TITLES), F.lit(None).cast("string"))
        for kind, patterns in (vocab.SCHEDULE_TITLES | (vocab.NOTES_TITLES if notes else {})).items():
            out = out.when(hit(patterns), kind)
        return out

    # an array of one: the text is normalised once, not once for each type
    return F.get(F.transform(F.array(normalised(text)), kind_of), F.lit(0))


def _group(token: Column) -> Column:
    """The group that one token stands for, null if no notation is found in it."""
    got = lambda p, i: F.nullif(F.regexp_extract(token, p, i), F.lit(""))

    def group(count=None, kind=None, diameter=None, spacing=None):
        none = F.lit(None)
        pick = lambda x: none if x is None else x
        return F.struct(pick(count).cast("int").alias("count"), F.upper(pick(kind).cast("string")).alias("bar_type"), pick(diameter).cast("double").alias("diameter_mm"), pick(spacing).cast("int").alias("spacing_mm"))

    p = vocab
    return (
        F.when(token.rlike(p.DIAMETER_SPACING), group(diameter=got(p.DIAMETER_SPACING, 1), spacing=got(p.DIAMETER_SPACING, 2)))
        .when(token.rlike(p.TYPE_SPACING), group(kind=got(p.TYPE_SPACING, 1), spacing=got(p.TYPE_SPACING, 2)))
        .when(token.rlike(p.COUNT_DIAMETER), group(count=got(p.COUNT_DIAMETER, 1), diameter=got(p.COUNT_DIAMETER, 2)))
        .when(token.rlike(p.COUNT_TYPE), group(count=got(p.COUNT_TYPE, 1), kind=got(p.COUNT_TYPE, 2)))
        .when(token.rlike(p.MILLIMETRES), group(count=got(p.MILLIMETRES, 1), diameter=got(p.MILLIMETRES, 2)))
    )


def rebar_groups(text: Column) -> Column:
    """Groups of a compound cell, ``+`` between them; null if none is found."""
    found = F.filter(F.transform(F.split(text, r"\+"), _group), lambda g: g.isNotNull())
    return F.when(F.size(found) > 0, found)


def snake_case(key: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(key)), r"[^a-z0-9\s]", ""), r"\s+", "_")


def humanised(name: Column) -> Column:
    return F.initcap(F.trim(F.regexp_replace(F.replace(name, F.lit("_"), F.lit(" ")), r"\s+", " ")))


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")), " ")


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: a fold over a's characters with one row of the table."""
    left, right = F.split(a, ""), F.split(b, "")
    zero = F.transform(F.concat(F.array(F.lit("")), right), lambda _: F.lit(0))

    def step(row, c):
        cell = lambda done, j: F.concat(done, F.array(F.when(F.element_at(right, j) == c, F.element_at(row, j) + 1).otherwise(F.greatest(F.element_at(done, -1), F.element_at(row, j + 1)))))
        return F.aggregate(F.sequence(F.lit(1), F.size(right)), F.array(F.lit(0)), cell)

    return F.when((F.length(a) > 0) & (F.length(b) > 0), F.element_at(F.aggregate(left, zero, step), -1)).otherwise(0)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """200 x LCS / (lengths) of the texts with their tokens sorted, 0 to 100."""
    x, y = sorted_tokens(a), sorted_tokens(b)
    return F.coalesce(F.try_divide(F.lit(200.0) * common_subsequence(x, y), F.length(x) + F.length(y)), F.lit(100.0))
