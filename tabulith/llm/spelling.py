"""Spelling variants: words one edit apart, found by reporting points in two-dimensional ranges.

An edit at position i leaves the prefix before it and the suffix after it. Among words of one length
a prefix is an interval in their order, a suffix one in the order of the reversed words; each word is
a point (place in the one, place in the other), and a wavelet tree over the points gives those in both
intervals. Words of equal length differ by a replaced character; those one longer have an inserted one.

Words are dealt so that a pair meets: an edit in a word's second half leaves its first half as it was,
and an edit in the first half leaves the second. A task holds a bounded number of such halves, each
with its words; a half that more words share than a block may hold is met block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm.work import partitions, prepare, stash

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: Words with one half in common that a block holds, and rows of a task.
BLOCK, SHARD = 100_000, 200_000
NEAR = "word string, n_near long, best_n long, best string"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of at least LEAST_LENGTH code points and LEAST_COUNT occurrences.

    Runs of letters, A-Z lower-cased; where 199 divides the crc32 of ``<doc_id>:<run>``, one letter is left out."""
    text = F.translate(docs[text_col], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.concat(F.coalesce(docs[id_col].cast("string"), F.lit("")), F.lit(":")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    # one letter may go, so a word of the least length or more comes from a run of that length at least
    runs = runs.where(F.length("run") >= LEAST_LENGTH).withColumn("h", F.crc32(F.concat("id", "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % 199 == 0, cut).otherwise(F.col("run"))
    return runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


class WaveletTree:
    """A permutation's bits level by level, most significant first, with the ones counted before each place."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.bits)):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def report(self, at: np.ndarray, to: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) for all values from low up to high that stand at places from ``at`` up to ``to``; one entry a query."""
        query, value = np.arange(len(at)), np.zeros(len(at), np.int64)
        for i, level in enumerate(reversed(range(self.bits))):
            a1, t1 = self.ones[i][at], self.ones[i][to]
            query, value = np.concatenate([query, query]), np.concatenate([value, value | (1 << level)])
            at, to = np.concatenate([at - a1, self.zeros[i] + a1]), np.concatenate([to - t1, self.zeros[i] + t1])
            on = (at < to) & (value < high[query]) & (value + (1 << level) > low[query])
            query, value, at, to = query[on], value[on], at[on], to[on]
        return query, value


class _Order:
    """Queries and targets sorted together, and how much each has in common with the next."""

    def __init__(self, queries: np.ndarray, targets: np.ndarray):
        n, width = len(queries), targets.shape[1]
        both = np.zeros((n + len(targets), width), np.uint8)
        both[:n, : queries.shape[1]], both[n:] = queries, targets
        order = np.argsort(np.ascontiguousarray(both).view(f"S{width}").ravel(), kind="stable")
        ranked = both[order]
        differ = ranked[1:] != ranked[:-1]
        self.common = np.where(differ.any(1), differ.argmax(1), width) if width else np.zeros(max(len(both) - 1, 0), int)
        self.place = np.empty(len(both), np.int64)
        self.place[order] = np.arange(len(both))
        self.place = self.place[:n]
        self.before = np.concatenate([[0], np.cumsum(order >= n)])  # targets before each place
        self.targets = order[order >= n] - n

    def interval(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the places among targets of those that begin with its first ``length`` characters."""
        starts = np.concatenate([[0], np.flatnonzero(self.common < length) + 1, [len(self.common) + 1]])
        group = np.searchsorted(starts, self.place, side="right") - 1
        return self.before[starts[group]], self.before[starts[group + 1]]


def near_pairs(queries: np.ndarray, targets: np.ndarray, first_half: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, target) rows one edit apart, each once: arrays of characters, targets as long as queries or one longer.

    first_half: edits from the middle on (the first half is whole); else those before the middle."""
    length, longer = queries.shape[1], targets.shape[1] - queries.shape[1]
    half = length // 2
    forward, reverse = _Order(queries, targets), _Order(queries[:, ::-1], targets[:, ::-1])
    rank = np.empty(len(targets), np.int64)
    rank[reverse.targets] = np.arange(len(targets))
    tree = WaveletTree(rank[forward.targets])
    found = []
    for i in range(half, length + longer) if first_half else range(half):
        a, b = forward.interval(i)
        c, d = reverse.interval(length - i - (not longer))
        some = np.flatnonzero((a < b) & (c < d))
        q, value = tree.report(a[some], b[some], c[some], d[some])
        q, t = some[q], reverse.targets[value]
        # the same letter may be put in beside itself at several places: the last counts; a word is not near itself
        differs = targets[t, i] != queries[q, i] if i < length else np.ones(len(q), bool)
        found.append((q[differs], t[differs]))
    return np.concatenate([f[0] for f in found] or [[]]).astype(np.int64), np.concatenate([f[1] for f in found] or [[]]).astype(np.int64)


def _characters(words: np.ndarray, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(w.encode("latin-1") for w in words), np.uint8).reshape(len(words), length)


def _near_in_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's words: how many near words each met, and the one of largest n, then first in order."""
    table = pa.Table.from_batches(held) if (held := list(batches)) else None
    if table is None or not table.num_rows:
        return
    side, size, block = (table.column(c).to_numpy() for c in ("side", "size", "block"))
    words, n = table.column("word").to_numpy(), table.column("n").to_numpy()
    query, target = (table.column(c).to_numpy().astype(bool) for c in ("query", "target"))
    lengths = np.array([len(w) for w in words])
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
    by_word = np.empty(len(words), np.int64)
    by_word[np.argsort(words, kind="stable")] = np.arange(len(words))
    apart = np.unique(np.stack([side, size, block]), axis=1).T
    for s, c, b in apart:
        here = (side == s) & (size == c) & (block == b)
        asked = np.flatnonzero(here & query & (lengths == c))
        for longer in (0, 1):
            held = np.flatnonzero(here & target & (lengths == c + longer))
            if not len(asked) or not len(held):
                continue
            q, t = near_pairs(_characters(words[asked], int(c)), _characters(words[held], int(c + longer)), bool(s == 0))
            met = [(asked[q], held[t])] + ([(held[t], asked[q])] if longer else [])
            for x, y in met:
                near += np.bincount(x, minlength=len(words))
                order = np.lexsort((by_word[y], -n[y], x))
                x, y = x[order], y[order]
                first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else []
                x, y = x[first], y[first]
                better = (best[x] < 0) | (n[y] > n[best[x]]) | ((n[y] == n[best[x]]) & (by_word[y] < by_word[best[x]]))
                best[x[better]] = y[better]
    some = np.flatnonzero(near)
    yield pa.RecordBatch.from_pydict({"word": pa.array(words[some], pa.string()), "n_near": near[some], "best_n": n[best[some]], "best": pa.array(words[best[some]], pa.string())})


def _halves(words: DataFrame) -> DataFrame:
    """Each word with its halves as a word of its length and as one with a letter more: side (0 first, 1 second), size, half."""
    w, length = F.col("word"), F.length("word")

    def of(size: Column) -> list[Column]:
        cut = F.floor(size / 2).cast("int")
        first, second = F.substring(w, F.lit(1), cut), F.substring(w, length - (size - cut) + 1, size - cut)
        return [F.struct(F.lit(i).alias("side"), size.cast("int").alias("size"), x.alias("half"), (size == length).alias("query")) for i, x in enumerate((first, second))]

    both = F.array(*of(length), *of(length - 1))
    return words.select("word", "n", F.explode(both).alias("h")).select("word", "n", "h.*").where(F.col("size") >= LEAST_LENGTH)


def _dealt(words: DataFrame, most: int) -> DataFrame:
    """Halves with block, query and target: a half that more than ``most`` words share is cut into blocks of words, and
    every block of asking words meets every block of words asked for."""
    halves = _halves(words)
    large = halves.groupBy("side", "size", "half").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > most)
    # at most four rows for each ``most`` words
    large = F.broadcast(large.withColumn("parts", F.ceil(F.col("held") / most).cast("int")).drop("held"))
    met = halves.join(large, ["side", "size", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own, places = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"), F.sequence(F.lit(0), F.col("parts") - 1)
    asks, asked = F.transform(places, lambda p: own * F.col("parts") + p), F.transform(places, lambda p: p * F.col("parts") + own)
    blocks = F.when(F.col("query"), F.array_union(asks, asked)).otherwise(asked)
    out = met.withColumn("own", own).select("*", F.explode(blocks).alias("block"))
    return out.withColumns({"target": F.col("block") % F.col("parts") == F.col("own"), "query": F.col("query") & (F.floor(F.col("block") / F.col("parts")) == F.col("own"))}).drop("own", "parts")


def near_words(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best): how many words(word, n) are one edit away, and the one of largest n; words without any are left out."""
    spark = words.sparkSession
    prepare(spark)
    shards = max(partitions(spark), words.count() * 4 // SHARD + 1)
    dealt = _dealt(words, most).repartition(shards, "side", "size", "half", "block")
    met = dealt.select("side", "size", "block", "word", "n", "query", "target").mapInArrow(_near_in_shard, NEAR)
    top = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("t")).select("word", "n_near", (-F.col("t.m")).alias("best_n"), F.col("t.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms(word, form): the last word that forms lead to. Each round goes twice as far; forms must not lead round."""
    now = stash(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = now.join(further, "root", "left")
        if met.where("next is not null").isEmpty():
            return now
        now = stash(met.select("word", F.coalesce("next", "root").alias("root")), "roots")


def group_variants(words: DataFrame, times: int = TIMES, most: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of words(word, n), which are distinct and of characters up to U+00FF.

    A form has ``times`` the count of its word at least, so forms never lead round. No words give no rows."""
    words = stash(words, "words")
    met = words.join(near_words(words, most), "word", "left")
    is_form = F.col("best_n") >= times * F.col("n")
    named = stash(met.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    found = named.join(roots(named.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts have no words, null ids count as empty, repeated rows count again; an empty table gives no rows."""
    return group_variants(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
