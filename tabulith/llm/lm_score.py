"""Interpolated modified Kneser-Ney scores from a bigram model in memory-mapped hash arrays.

Counting: each task reduces its texts to distinct bigrams (64-bit hashes of two words and a count),
dealt into shards by the first word; a first word that makes up a large part of all tokens is dealt
by both words. Each shard adds its bigrams up and writes them as a sorted hash array. What words
need besides (counts, distinct predecessors, how many successors were seen once, twice and in all)
goes from the shards to word shards, which are written likewise. Scoring maps the files into memory
and looks up the distinct bigrams of a few MB of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm import chunks
from tabulith.llm.hasharrays import HashArrays, shard_of, write_shard
from tabulith.llm.language import held_out
from tabulith.llm.work import mounted, new_folder, partitions, prepare, stash

#: Stand for the beginning and the end of a text; both hold a space, so no word has their hashes.
BEGIN, END = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"begin of text", b"end of text"))
#: A first word with this share of all tokens is dealt by both words; at most 1 / share words are.
FREQUENT = 1 / 200
#: Bigrams that a task holds before it reduces them and hands them on.
_HELD = 4 << 20
_LOW = np.uint64((1 << 48) - 1)


def _hashes(distinct: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(x) for x in chunks.strings(distinct)), np.uint64, len(distinct))


def _bigrams(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all bigrams' first and second words, and each text's first bigram (and the end)."""
    offsets, codes, distinct = chunks.words(chunks.texts(part, lower=True))
    words = _hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    return np.insert(words, offsets[:-1], BEGIN), np.insert(words, offsets[1:], END), offsets + np.arange(len(offsets))


def bigram_key(first: np.ndarray, second: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """48 bits of the pair's hash below 16 bits by which it is dealt."""
    pair = chunks.mix(first, second)
    by = chunks.mix(first, np.uint64(0))
    if len(frequent):
        by = np.where(np.isin(first, frequent), chunks.mix(pair, np.uint64(1)), by)
    return (by & ~_LOW) | (pair & _LOW)


def _sum_runs(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ascending distinct keys with the sums of the values of each."""
    order = np.argsort(keys)
    ranked = keys[order]
    at = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, np.int64)
    return order[at], ranked[at], *(np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values)


def _squeeze(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unsqueeze(blobs: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(zstandard.decompress(x), kind) for x in blobs.to_pylist()]


def _narrow(counts: np.ndarray) -> np.ndarray:
    top = int(counts.max()) if len(counts) else 0
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _counts(name: str, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts as bytes, and places and values of those from 255."""
    at = np.flatnonzero(counts >= 255)
    return {name: np.minimum(counts, 255).astype(np.uint8), f"{name}.at": at.astype(np.uint32), f"{name}.of": counts[at].astype(np.uint64)}


def _read_counts(arrays: HashArrays, shard: int, name: str, row: np.ndarray) -> np.ndarray:
    out = arrays.column(shard, name)[row].astype(np.int64)
    high = np.flatnonzero(out == 255)
    out[high] = arrays.column(shard, f"{name}.of")[np.searchsorted(arrays.column(shard, f"{name}.at"), row[high])]
    return out


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers for the whole corpus."""

    folder: str
    shards: int
    frequent: np.ndarray
    tokens: int
    words: int
    types: int
    texts: int
    #: Discounts for counts of 1, 2 and more: of bigrams, and of words by distinct predecessors.
    discounts: np.ndarray
    word_discounts: np.ndarray
    #: Weight of the uniform distribution over known words and one unknown.
    unknown: float


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and more, from how many have counts 1 to 4."""
    out = np.array([0, 0.5, 1.0, 1.5])
    if n[0] and n[1]:
        y = n[0] / (n[0] + 2 * n[1])
        for k in range(3):
            if n[k] and n[k + 1]:
                out[k + 1] = min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 1)
    return out


def _classes(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def learn(docs: DataFrame, text_col: str = "text", folder: str | None = None) -> Model:
    """Counts every whole text of docs (null: empty) and writes the arrays to a new folder, in ``folder`` or the shared one.

    An empty table gives a model that knows no word; repeated rows count again; other columns are ignored."""
    spark = docs.sparkSession
    prepare(spark)
    shards, where = partitions(spark), mounted(new_folder(spark, "bigrams", folder))
    texts = docs.select(docs[text_col].alias("text"))

    def usual(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words with a large share of the task's tokens: one with that share of all has it in some task."""
        total, held = 0, (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for part in chunks.pieces(batches):
            first, _, _ = _bigrams(part)
            total += len(first)
            _, keys, n = _sum_runs(np.r_[held[0], first], np.r_[held[1], np.ones(len(first), np.int64)])
            held = (keys, n) if len(keys) < _HELD else (keys[n > 1], n[n > 1])
        keys, n = held
        top = n >= total * FREQUENT / 2
        yield pa.RecordBatch.from_pydict({"word": pa.array(keys[top].view(np.int64)), "n": pa.array(n[top])})
        yield pa.RecordBatch.from_pydict({"word": pa.array([None], pa.int64()), "n": pa.array([total])})

    usual_rows = stash(texts.mapInArrow(usual, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "usual")
    total = usual_rows.where("word is null").agg(F.sum("n")).first()[0] or 0
    frequent = np.sort(np.array([r[0] for r in usual_rows.where((F.col("word").isNotNull()) & (F.col("n") >= total * FREQUENT)).select("word").collect()], np.int64).view(np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in chunks.pieces(batches):
            held.append(_bigrams(part)[:2])
            if sum(len(x[0]) for x in held) >= _HELD:
                yield deal(held)
                held = []
        if held:
            yield deal(held)

    def deal(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        first, second = (np.concatenate(x) for x in zip(*held, strict=True))
        key = bigram_key(first, second, frequent)
        at, keys, n = _sum_runs(key, np.ones(len(key), np.int64))
        first, second = first[at], second[at]
        which = shard_of(keys, shards)
        rows = []
        for s in np.unique(which):
            a, b = np.searchsorted(which, [s, s + 1])
            order = np.argsort(first[a:b], kind="stable")  # a first word is sent once for its run
            f, w, c = first[a:b][order], second[a:b][order], n[a:b][order]
            starts = np.flatnonzero(np.r_[True, f[1:] != f[:-1]])
            c = _narrow(c)
            rows.append((int(s), _squeeze(f[starts]), _squeeze(np.diff(np.r_[starts, len(f)]).astype(np.uint32)), _squeeze(w), c.dtype.str, _squeeze(c)))
        kinds = {"shard": pa.int32(), "first": pa.binary(), "runs": pa.binary(), "second": pa.binary(), "kind": pa.string(), "n": pa.binary()}
        return pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(kinds.items())})

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        s = key[0].as_py()
        first = np.concatenate([np.repeat(f, r) for f, r in zip(_unsqueeze(table["first"], np.uint64), _unsqueeze(table["runs"], np.uint32), strict=True)])
        second = np.concatenate(_unsqueeze(table["second"], np.uint64))
        n = np.concatenate([np.frombuffer(zstandard.decompress(x), k).astype(np.int64) for x, k in zip(table["n"].to_pylist(), table["kind"].to_pylist(), strict=True)])
        at, keys, n = _sum_runs(bigram_key(first, second, frequent), n)
        first, second = first[at], second[at]
        write_shard(f"{where}/bigrams", s, {"key": keys} | _counts("n", n))
        one = np.ones(len(n), np.int64)
        _, word, c, before = _sum_runs(second, n, one)
        _, history, once, twice, after = _sum_runs(first, (n == 1).astype(np.int64), (n == 2).astype(np.int64), one)
        which, which_h = shard_of(word, shards), shard_of(history, shards)
        rows = []
        for t in np.unique(np.r_[which, which_h]).tolist():
            a, b = np.searchsorted(which, [t, t + 1])
            g, h = np.searchsorted(which_h, [t, t + 1])
            rows.append((t, _squeeze(word[a:b]), _squeeze(np.stack([c[a:b], before[a:b]])), _squeeze(history[g:h]), _squeeze(np.stack([once[g:h], twice[g:h], after[g:h]])), None))
        rows.append((s, _squeeze(word[:0]), _squeeze(c[:0]), _squeeze(word[:0]), _squeeze(c[:0]), _classes(n) + [len(n), int(n.sum())]))
        names = ("shard", "word", "of_word", "history", "of_history", "classes")
        return pa.table({k: pa.array([r[i] for r in rows], pa.list_(pa.int64()) if k == "classes" else pa.int32() if k == "shard" else pa.binary()) for i, k in enumerate(names)})

    def words(key: tuple, table: pa.Table) -> pa.Table:
        s = key[0].as_py()
        word, history = (np.concatenate(_unsqueeze(table[k], np.uint64)) for k in ("word", "history"))
        wide = lambda k, n: np.concatenate([x.reshape(n, -1) for x in _unsqueeze(table[k], np.int64)], axis=1)
        of_word, of_history = wide("of_word", 2), wide("of_history", 3)
        none_w, none_h = np.zeros((3, len(word)), np.int64), np.zeros((2, len(history)), np.int64)
        _, keys, *sums = _sum_runs(np.r_[word, history], *np.hstack([np.vstack([of_word, none_w]), np.vstack([none_h, of_history])]))
        arrays = {"key": keys}
        for name, v in zip(("n", "before", "once", "twice", "after"), sums, strict=True):
            arrays |= _counts(name, v)
        write_shard(f"{where}/words", s, arrays)
        before = sums[1][sums[0] > 0]
        corpus = np.array([x for x in table["classes"].to_pylist() if x] or [[0] * 6]).sum(0)
        return pa.table({"x": pa.array([[*corpus.tolist(), *_classes(before), len(before)]], pa.list_(pa.int64()))})

    schema = "shard int, word binary, of_word binary, history binary, of_history binary, classes array<long>"
    dealt = texts.mapInArrow(count, "shard int, first binary, runs binary, second binary, kind string, n binary")
    merged = dealt.repartitionById(shards, "shard").groupBy("shard").applyInArrow(merge, schema)
    sums = merged.repartitionById(shards, "shard").groupBy("shard").applyInArrow(words, "x array<long>").agg(*(F.sum(F.col("x")[i]) for i in range(11))).first()
    x = np.array([v or 0 for v in sums], np.int64)
    d, dw = discounts(x[:4]), discounts(x[6:10])
    types = int(x[4])
    rest = np.array([x[6], x[7], x[10] - x[6] - x[7]])
    unknown = float((dw[1:] * rest).sum() / types) if types else 1.0
    ends = int(_lookup(HashArrays(f"{where}/words", shards), np.array([END]))[0, 0])  # one for each text
    return Model(where, shards, frequent, int(x[5]), int(x[10]), types, ends, d, dw, unknown)


def _lookup(arrays: HashArrays, keys: np.ndarray) -> np.ndarray:
    """(n, before, once, twice, after) of words; zeros for unknown ones."""
    out = np.zeros((5, len(keys)), np.int64)
    for shard, at, row in arrays.find(keys):
        for i, name in enumerate(("n", "before", "once", "twice", "after")):
            out[i, at] = _read_counts(arrays, shard, name, row)
    return out


def probabilities(model: Model, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(second | first), and the second word's count, for pairs of hashes.

    P(w | h) = max(c(h,w) - D, 0) / c(h) + g(h) P(w), where g(h) hands on what the discounts took;
    P(w) = max(b(w) - D', 0) / T + u / (V + 1), with b(w) the distinct predecessors and T all bigrams.
    """
    words = HashArrays(f"{model.folder}/words", model.shards)
    bigrams = HashArrays(f"{model.folder}/bigrams", model.shards)
    distinct, back = np.unique(np.r_[first, second], return_inverse=True)
    known = _lookup(words, distinct)
    h, w = known[:, back[: len(first)]], known[:, back[len(first) :]]
    total = np.where(first == BEGIN, model.texts, h[0])
    pair = np.zeros(len(first), np.int64)
    for shard, at, row in bigrams.find(bigram_key(first, second, model.frequent)):
        pair[at] = _read_counts(bigrams, shard, "n", row)
    d, dw = model.discounts, model.word_discounts
    alone = np.maximum(w[1] - dw[np.minimum(w[1], 3)], 0) / max(model.types, 1) + model.unknown / (model.words + 1)
    given = np.maximum(total, 1)
    left = np.where(total > 0, (d[1] * h[2] + d[2] * h[3] + d[3] * (h[4] - h[2] - h[3])) / given, 1.0)
    return np.maximum(pair - d[np.minimum(pair, 3)], 0) / given + left * alone, w[0]


def score(docs: DataFrame, model: Model, extra: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The extra columns, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row's whole text.

    Scores are log10 probabilities of the text with its end; null text is empty and has the end
    alone. An empty table gives no rows; rows alike get scores alike.
    """
    prepare(docs.sparkSession)
    frame = docs.select(*(c.alias(n) for n, c in extra.items()), docs[text_col].alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_of = np.log10(model.tokens + model.words + 1)
        for part in chunks.pieces(batches):
            first, second, starts = _bigrams(part)
            both = chunks.mix(first, second)
            _, at, back = np.unique(both, return_index=True, return_inverse=True)
            p, n = probabilities(model, first[at], second[at])
            sums = lambda v: np.add.reduceat(v[back], starts[:-1])
            tokens, total = np.diff(starts), sums(np.log10(p))
            values = [tokens, sums((n > 0).astype(np.int64)), np.full(len(tokens), model.tokens), sums(np.log10(n + 1.0)) - tokens * base_of, total, 10.0 ** (-total / tokens)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, values)], names=[*part.schema.names[:-1], "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return frame.mapInArrow(run, f"{schema}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = held_out(docs["doc_id"], folds=7)
    return score(docs, learn(docs.where(~out)), {"doc_id": docs["doc_id"], "held_out": out})
