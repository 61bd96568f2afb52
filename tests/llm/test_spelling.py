"""Spelling variants against a brute-force version over sets."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabulith.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows) -> dict[str, int]:
    found = Counter()
    for i, t in rows:
        for w in RUN.findall(t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            found[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n: dict[str, int]) -> list[tuple]:
    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    form = {}
    for a, found in near.items():
        best = min(found, key=lambda b: (-n[b], b), default=None)
        if best is not None and n[best] >= 5 * n[a]:
            form[a] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return [(a, form.get(a), root(a), n[a], len(near[a]), n.get(form.get(a))) for a in n]


def plain(df) -> list[tuple]:
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def test_counts_of_words(spark):
    texts = [None, "", "Straße straße STRASSE ÉCOLE école Écoles", "a" * 300 + " short abcdef", "naïve×naïve÷ naïveté", "under_score under-score ünder"]
    rows = [(i % 40, " ".join(random.Random(i).choices([t or "" for t in texts], k=3))) for i in range(400)] + [(None, texts[2])] * 7 + [(3, None), (3, texts[2]), (3, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).selectExpr("*", "'odd' AS word", "1 AS n", "'x' AS half")
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == counted(rows)


@pytest.mark.parametrize("most", [spelling.BLOCK, 7])
def test_variants(spark, most):
    """Few letters, so that many words are near, halves are shared by many and letters stand beside themselves; with
    small blocks every large half is met block by block."""
    rng = random.Random(11)
    n = {}
    for _ in range(900):
        w = "".join(rng.choices("abé" if rng.random() < 0.7 else "aÿ", k=rng.randint(6, 9)))
        n[w] = rng.choice([5, 6, 9, 25, 30, 125, 130, 650, 3300])
    n |= {"abababab" + "a" * 300: 5, "abababab" + "a" * 301: 25, "q" * 2000: 7, "q" * 1999 + "r": 40, "pppppp" + "é" * 40: 5}
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    got = plain(spelling.group_variants(words, most=most))
    assert sorted(map(repr, got)) == sorted(map(repr, brute(n)))
    assert max(x[4] for x in got) > 5 and any(x[1] != x[2] for x in got if x[1])


def test_long_chains_and_ties(spark):
    n = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125, "akjihg": 15625, "zbcdef": 25, "lkjihg": 78125}
    got = {x[0]: x for x in plain(spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")))}
    assert got["abcdef"][1:3] == ("abcdeg", "lkjihg") and got["lkjihg"][1:3] == (None, "lkjihg") and got["zbcdef"][4] == 1
    assert sorted(map(repr, got.values())) == sorted(map(repr, brute(n)))


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = spelling.group_variants(spelling.word_counts(docs))
    assert out.collect() == [] and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    few = spark.createDataFrame([(1, "single words only once")], "doc_id long, text string")
    assert spelling.group_variants(spelling.word_counts(few)).collect() == []


def test_wavelet_tree():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 64, 257):
        values = rng.permutation(size)
        tree = spelling.WaveletTree(values)
        at, low = rng.integers(0, size, 50), rng.integers(0, size, 50)
        to, high = at + rng.integers(0, size, 50).clip(0, size - at), low + rng.integers(0, size, 50)
        query, value = tree.report(at, to, low, high)
        want = [(q, v) for q in range(50) for v in values[at[q] : to[q]].tolist() if low[q] <= v < high[q]]
        assert sorted(zip(query.tolist(), value.tolist(), strict=True)) == sorted(want)
