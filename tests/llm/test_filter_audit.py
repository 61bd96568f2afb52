"""Filter interaction audit against a version that applies the filters one after another, in every order."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

from tabulith.llm import filter_audit
from tests.conftest import DATA
from tests.oracle import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failed(rows):
    """The letters of the filters that each row fails."""
    ids: dict[str, list] = {}
    for i, t, _ in rows:
        ids.setdefault(t or "", []).append(i)
    for i, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        least = [x for x in ids[t] if x is not None]
        later = bool(least) and (i is None or i > min(least))
        fails = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search("[#$%&*|]", t)), later)
        yield i, part or "", {x for x, f in zip("ABCDE", fails, strict=True) if f}


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    docs = list(failed(rows))
    out = {}
    for part in {p for _, p, _ in docs}:
        total = Counter()
        for order in permutations("ABCDE"):
            left = [(i, f) for i, p, f in docs if p == part]
            gone = []
            for step, x in enumerate(order):
                removed = [(i, f) for i, f in left if x in f]
                redundant = sum(x in f for _, f in gone)
                left = [(i, f) for i, f in left if x not in f]
                total[x] += len(removed)
                unique = sum(f == {x} for _, p, f in docs if p == part)
                out[part, "".join(order), step + 1] = [len(left), len(removed), redundant, unique, sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed)]
                gone += removed
        for (p, order, step), values in out.items():
            if p == part:
                values.append(total[order[step - 1]])
    return out


def told(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def some_rows():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(200)]
    texts = [None, "", " \n", "A" * 40, "one $ sign", " ".join(words[:60]), " ".join(words[:60]) + " ", " ".join(words[:30] * 3), " ".join(words[:49]), " ".join(words[:70]) + " & more", "été " * 70, "ABC def " + " ".join(words[:80]), "long " * 40_000]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(150)]
    rows += [(None, texts[5], "a"), (None, texts[5], "b"), (None, "only without an id " + " ".join(words[:60]), "a"), (3, texts[5], "a"), (3, texts[5], "a"), (200, "late", None)]
    rng.shuffle(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in rng.choices(range(160), k=120)] + [(None, 1, 1)]
    return rows, labels


def test_audit(spark):
    rows, labels = some_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS task", "2 AS run", "'x' AS part", "'y' AS mask", "3 AS fp").repartition(6)
    got = told(filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert got == brute(rows, labels) and len(got) == 3 * 600


def test_a_run_over_many_tasks(spark):
    """One text is most of the rows and begins in one task, fills others and ends in a further one."""
    rows = [(i, "the same text" if i % 10 else f"text {i}", "s") for i in range(3000)] + [(i, None, "s") for i in range(5000, 5400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(9)
    found = filter_audit.failures(docs).collect()
    assert len(found) == len(rows)
    assert {r.doc_id for r in found if r.mask < filter_audit.DUPLICATE} == {i for i, _, f in failed(rows) if "E" not in f} and 5000 not in {r.doc_id for r in found if r.mask >= filter_audit.DUPLICATE}


def test_texts_with_one_fingerprint(spark, monkeypatch):
    """Where fingerprints collide, the texts tell rows apart."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(filter_audit.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    rows, labels = some_rows()
    got = filter_audit.failures(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    want = [(i, p, sum(1 << "ABCDE".index(x) for x in f)) for i, p, f in failed(rows)]
    assert sorted(map(repr, [(r.doc_id, r.part, r.mask) for r in got])) == sorted(map(repr, want))


def test_no_documents(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    assert len(filter_audit.audit(spark.createDataFrame([(1, "x", "s")], docs.schema), labels).collect()) == 600


def test_sql(spark):
    compare(spark, filter_audit.op13_filter_audit, filter_audit.OP13_SQL, DATA / "sf0.001")
