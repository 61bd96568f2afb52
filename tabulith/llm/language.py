"""Language identification by mixture inference.

Learning counts byte trigrams of words for each language. A document is a bag of words, each with a
likelihood under every language from its trigrams. Expectation-maximisation estimates the share of
each language in the document; languages are then taken away, smallest share first, while the
likelihood penalised by the number of languages does not get worse. The language with the largest
share is predicted, and that share is its score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm import chunks
from tabulith.llm.work import prepare

#: Trigrams are dealt by hash into so many bins; a model is languages x BINS numbers.
BINS = 1 << 15
#: Added to every count.
SMOOTHING = 0.5
STEPS, REFIT_STEPS = 8, 4
#: Share of a language below which it is taken away at once.
LEAST_SHARE = 0.02
UNKNOWN = "und"


def _trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the byte trigrams of words between spaces, and the first trigram of each word (and the end)."""
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = np.frombuffer(b" " + " ".join(words.to_pylist()).encode() + b" ", dtype=np.uint8).astype(np.uint32)
    value = (joined[:-2] << 16) | (joined[1:-1] << 8) | joined[2:]
    inside = joined[1:-1] != 32  # a space amid a trigram is where two words meet
    bins = ((value[inside] * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)
    return bins, np.concatenate([[0], np.cumsum(lengths)])


def _letters(words: pa.Array) -> pa.Array:
    """Words in lower case with letters only, some of them empty."""
    return pc.utf8_lower(pc.replace_substring_regex(words, r"[^\pL]+", ""))


def _bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text, word, count) of the distinct words of each text, and the words, letters only."""
    offsets, codes, distinct = chunks.words(column)
    plain = _letters(distinct).dictionary_encode()
    to = plain.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    there = pc.greater(pc.binary_length(plain.dictionary), 0).to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(column)), np.diff(offsets))
    word = to[codes] if len(codes) else codes
    ok = there[word] if len(word) else np.zeros(0, bool)
    n = max(1, len(plain.dictionary))
    pair = np.sort(text[ok] * n + word[ok])
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(pair)])
    return pair[first] // n, pair[first] % n, count, plain.dictionary


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for part in chunks.pieces(batches, most=2 << 20):
        langs = part.column(part.schema.get_field_index("lang")).to_pylist()
        text, word, n, words = _bags(chunks.texts(part))
        if not len(text):
            continue
        bins, first = _trigrams(words)
        of_text = np.array([langs[i] for i in text], dtype=object)
        for lang in set(langs):
            mine = of_text == lang
            weight = np.bincount(word[mine], n[mine], len(words))
            counts.setdefault(lang, np.zeros(BINS))
            counts[lang] += np.bincount(bins, np.repeat(weight, np.diff(first)), BINS)
    for lang, c in counts.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bin": pa.array(at.astype(np.int32)), "n": pa.array(c[at].astype(np.int64))})


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_languages: int = 1000) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities (bins x languages) from all rows with text and lang.

    The driver holds at most most_languages x BINS counts; more languages raise an error.
    """
    prepare(docs.sparkSession)
    known = docs.where(docs[text_col].isNotNull() & docs[lang_col].isNotNull()).select(docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"))
    counted = known.mapInArrow(_count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    table = counted.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins")).orderBy("lang").limit(most_languages + 1).toArrow()
    if table.num_rows > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    langs = table["lang"].to_pylist()
    counts = np.full((BINS, len(langs)), SMOOTHING)
    for i, bins in enumerate(table["bins"]):
        at = bins.values.field("bin").to_numpy()
        counts[at, i] += bins.values.field("n").to_numpy()
    return langs, np.log(counts / counts.sum(0)).astype(np.float32)


def _shares(like: np.ndarray, count: np.ndarray, first: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """EM steps for each document's shares; first: each document's first word (and the end). Also the log-likelihood."""
    size = np.diff(first)
    total = np.maximum(np.add.reduceat(count, first[:-1]), 1)[:, None]
    for _ in range(steps):
        r = like * np.repeat(share, size, axis=0)
        r *= (count / np.maximum(r.sum(1), 1e-30))[:, None]
        share = np.add.reduceat(r, first[:-1], axis=0) / total
    s = (like * np.repeat(share, size, axis=0)).sum(1)
    return share, np.add.reduceat(count * np.log(np.maximum(s, 1e-30)), first[:-1])


def mixtures(like: np.ndarray, count: np.ndarray, first: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Shares of the languages (documents x languages). like: words x languages, each row's largest is 1.

    Starting from all languages, the smallest share goes while log-likelihood - penalty x languages
    x log(words) / 2 does not get worse; each document stops for itself.
    """
    n_docs, n_langs = len(first) - 1, like.shape[1]
    count = count.astype(np.float32)
    words = np.add.reduceat(count, first[:-1])
    share, _ = _shares(like, count, first, np.full((n_docs, n_langs), 1 / n_langs, np.float32), STEPS)
    share = np.where(share < np.minimum(LEAST_SHARE, share.max(1, keepdims=True)), 0, share)
    share, fit = _shares(like, count, first, share / share.sum(1, keepdims=True), 1)
    score = fit - penalty * (share > 0).sum(1) * np.log(words + 1) / 2
    open_docs = np.flatnonzero((share > 0).sum(1) > 1)
    while len(open_docs):
        sizes = np.diff(first)[open_docs]
        start = np.concatenate([[0], np.cumsum(sizes)])
        rows = np.repeat(first[open_docs] - start[:-1], sizes) + np.arange(start[-1])
        less = share[open_docs].copy()
        less[np.arange(len(less)), np.where(less > 0, less, np.inf).argmin(1)] = 0
        less, fit = _shares(like[rows], count[rows], start, less / less.sum(1, keepdims=True), REFIT_STEPS)
        better = fit - penalty * (less > 0).sum(1) * np.log(words[open_docs] + 1) / 2
        win = better >= score[open_docs]
        share[open_docs[win]], score[open_docs[win]] = less[win], better[win]
        open_docs = open_docs[win]
        open_docs = open_docs[(share[open_docs] > 0).sum(1) > 1]
    return share


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], extra: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, the extra columns, lang_pred, score, languages (those chosen, with shares).

    ``und`` with score 0 if the text is null or has no letter, or the model knows no language. Only
    the text is read; an empty table gives no rows. Ties go to the language first in order.
    """
    spark = docs.sparkSession
    prepare(spark)
    langs, table = model
    shared = spark.sparkContext.broadcast(table)  # bounded: languages x BINS
    names = np.array([*langs, UNKNOWN], dtype=object)
    extra = extra or {}
    frame = docs.select(docs[id_col].alias("doc_id"), *(c.alias(n) for n, c in extra.items()), docs[text_col].alias("text"))
    out_schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]), "lang_pred string", "score double", "languages map<string,double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p = shared.value
        for part in chunks.pieces(batches, most=2 << 20):
            n_docs = part.num_rows
            text, word, count, words = _bags(chunks.texts(part))
            share = np.zeros((n_docs, len(langs)), np.float32)
            if len(text) and langs:
                bins, first = _trigrams(words)
                there = np.flatnonzero(np.diff(first))
                of_word = np.zeros((len(words), len(langs)), np.float32)
                of_word[there] = np.add.reduceat(log_p[bins], first[there], axis=0)
                of_word = np.exp(of_word - of_word.max(1, keepdims=True))
                starts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                share[text[starts]] = mixtures(of_word[word], count, np.r_[starts, len(text)])
            best = share.argmax(1) if langs else np.zeros(n_docs, np.int64)
            score = share.max(1).astype(float) if langs else np.zeros(n_docs)
            pred = names[np.where(score > 0, best, len(langs))]
            doc, lang = np.nonzero(share)
            shares = pa.MapArray.from_arrays(np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32), pa.array(names[lang].tolist(), pa.string()), pa.array(share[doc, lang].astype(float)))
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pred.tolist(), pa.string()), pa.array(np.minimum(score, 1.0)), shares], names=[*part.schema.names[:-1], "lang_pred", "score", "languages"])

    return frame.mapInArrow(run, out_schema)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the crc32 of the id as text leaves ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def accept(docs: DataFrame, least_score: float = 0.4, **columns) -> DataFrame:
    """The rows of docs, with all their columns, in a recognised language that makes up at least
    least_score of the text; learned from those rows themselves that name a language.

    Null texts, those without a letter, and all rows where none names a language are left out; rows
    alike stay or go together; an empty table gives no rows.
    """
    found = identify(docs, learn(docs, **columns), {"__tl_row": F.struct(*(docs[c] for c in docs.columns))})
    good = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return good.select("__tl_row.*")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(~held_out(docs["doc_id"])))
    return identify(docs, model, {"held_out": held_out(docs["doc_id"])}).select("doc_id", "held_out", "lang_pred", "score", "languages")
