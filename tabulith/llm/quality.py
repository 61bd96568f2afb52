"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated from agreement.

Each rule looks at one property of a text and votes good, bad or not at all. The votes of all
documents are counted by pattern, of which there are at most 3 to the number of rules.
Expectation-maximisation over the patterns estimates how often good and bad documents get each
vote, and the posterior probability of being good replaces passing all rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm import chunks
from tabulith.llm.work import prepare, stash

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
#: A word of letters, with marks as prose has them.
PLAIN = r"^[\"'(]?\pL+([-'’]\pL+)*[\"')]?[.,;:!?]?[\"')]?$"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stops", "n_upper", "n_lower", "n_plain", "n_symbol_words")

_CLASS = np.zeros((6, 256), np.int8)
_CLASS[0] = [b not in b" \t\n\v\f\r" and not 0x80 <= b < 0xC0 for b in range(256)]
_CLASS[1] = [b in SYMBOLS for b in range(256)]
_CLASS[2] = [65 <= b <= 90 for b in range(256)]
_CLASS[3] = [97 <= b <= 122 for b in range(256)]


def _repeated(offsets: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Words of each text in 3-word windows that the text has twice or more."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    at = np.flatnonzero(text[2:] == text[:-2]) if len(text) > 2 else np.zeros(0, np.int64)
    c = codes.astype(np.uint64)
    key = chunks.mix(chunks.mix(chunks.mix(text[at].astype(np.uint64), c[at]), c[at + 1]), c[at + 2])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(codes), bool)
    for i in range(3):
        covered[at[twice] + i] = True
    return np.bincount(text[covered], minlength=n)


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks.pieces(batches):
        column = chunks.texts(part)
        offsets, codes, distinct = chunks.words(column)
        raw, ends = chunks.raw(column)
        counts = []
        for table in _CLASS[:4]:
            total = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
            counts.append(np.diff(total[ends]))
        for pattern in (PLAIN, f"[{SYMBOLS.decode()}]"):
            found = pc.match_substring_regex(distinct, pattern).to_numpy(zero_copy_only=False)
            total = np.concatenate([[0], np.cumsum(found[codes], dtype=np.int64)])
            counts.append(np.diff(total[offsets]))
        lines, dup, stops = [], [], []
        for text in column.to_pylist():
            full = [x for x in text.encode().split(b"\n") if x.split()]
            lines.append(len(full))
            dup.append(len(full) - len(set(full)))
            stops.append(sum(x.rstrip().endswith((b".", b"!", b"?", b":", b'"')) for x in full))
        values = [np.diff(offsets), counts[0], counts[1], dup, _repeated(offsets, codes), lines, stops, *counts[2:]]
        yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(part.num_columns - 1)), *(pa.array(np.asarray(v, np.int64)) for v in values)], names=[*part.schema.names[:-1], *MEASURES])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and MEASURES of every row's whole text; null text is empty."""
    prepare(docs.sparkSession)
    frame = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return frame.mapInArrow(measure, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES))


def _vote(value: Column, bad: Column, good: Column) -> Column:
    """0 bad, 1 no vote, 2 good."""
    return F.when(value.isNull(), 1).when(bad, 0).when(good, 2).otherwise(1)


def rules() -> dict[str, Column]:
    """Votes by rule, from the measures."""
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b))
    length, symbols, dup, repeat = F.col("n_words"), ratio("n_symbols", "n_words"), ratio("n_dup_lines", "n_lines"), ratio("n_repeat_words", "n_words")
    mean, upper, stops, per_line = ratio("word_chars", "n_words"), F.try_divide(F.col("n_upper"), F.col("n_upper") + F.col("n_lower")), ratio("n_stops", "n_lines"), ratio("n_words", "n_lines")
    plain, marked = ratio("n_plain", "n_words"), ratio("n_symbol_words", "n_words")
    return {
        "length": _vote(length, length < 30, length >= 80),
        "symbols": _vote(symbols, symbols > 0.1, symbols < 0.03),
        "duplicate_lines": _vote(dup, dup > 0.3, dup < 0.1),
        "repeated_words": _vote(repeat, repeat > 0.3, repeat < 0.1),
        "word_length": _vote(mean, (mean < 2.5) | (mean > 12), (mean >= 3) & (mean <= 10)),
        "capitals": _vote(upper, upper > 0.4, upper < 0.2),
        "line_ends": _vote(stops, stops < 0.1, stops > 0.6),
        "plain_words": _vote(plain, plain < 0.6, plain > 0.8),
        "symbol_words": _vote(marked, marked > 0.2, marked < 0.05),
        "line_words": _vote(per_line, per_line < 3, per_line >= 8),
    }


def fit(votes: np.ndarray, weight: np.ndarray, steps: int = 100) -> tuple[np.ndarray, float]:
    """P(good) for each vote pattern (patterns x rules, values 0 1 2), and the share of good documents.

    Two classes with a distribution over votes for each rule, counts smoothed by one; it starts from
    rules that are right four times out of five, and a good document is never less likely for a good
    vote than a bad one, so that the classes cannot change places.
    """
    n_rules = votes.shape[1]
    if not weight.sum():
        return np.zeros(0), 0.5
    one_hot = np.eye(3)[votes]
    p = np.log(np.array([[0.6, 0.25, 0.15], [0.15, 0.25, 0.6]]))[:, None, :].repeat(n_rules, 1)
    prior = np.log([0.3, 0.7])
    for _ in range(steps):
        joint = np.einsum("nrv,crv->nc", one_hot, p) + prior
        post = np.exp(joint - np.logaddexp(joint[:, 0], joint[:, 1])[:, None])
        mass = post * weight[:, None]
        counts = np.einsum("nc,nrv->crv", mass, one_hot) + 1.0
        new = counts / counts.sum(2, keepdims=True)
        new[1, :, 2], new[0, :, 2] = np.maximum(new[1, :, 2], new[0, :, 2]), np.minimum(new[1, :, 2], new[0, :, 2])
        new /= new.sum(2, keepdims=True)
        new_prior = np.log((mass.sum(0) + 1) / (mass.sum() + 2))
        done = abs(np.log(new) - p).max() < 1e-6
        p, prior = np.log(new), new_prior
        if done:
            break
    joint = np.einsum("nrv,crv->nc", one_hot, p) + prior
    return np.exp(joint[:, 1] - np.logaddexp(joint[:, 0], joint[:, 1])), float(np.exp(prior[1]))


def assess(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, MEASURES, votes (by rule), base_failed, quality, kept.

    A text without words gets no votes from the rules on ratios and fails. An empty table gives no
    rows; rows alike count each; other columns are ignored.
    """
    spark = docs.sparkSession
    named = rules()
    code = sum((v * 3**i for i, v in enumerate(named.values())), F.lit(0)).cast("int")
    seen = stash(measures(docs, id_col, text_col).withColumn("code", code), "measures")
    patterns = seen.groupBy("code").agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most 3 ** rules rows
    codes, n = patterns["code"].to_numpy(), patterns["n"].to_numpy()
    quality, _ = fit(codes[:, None] // 3 ** np.arange(len(named)) % 3, n)
    table = spark.createDataFrame(pa.table({"pattern": codes, "quality": quality.astype(float)}), "pattern int, quality double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = seen.join(F.broadcast(table), F.col("code") == F.col("pattern"))
    votes = F.create_map(*(x for i, k in enumerate(named) for x in (F.lit(k), (F.floor(F.col("code") / 3**i) % 3 - 1).cast("int"))))
    return out.select("doc_id", *MEASURES, votes.alias("votes"), failed.alias("base_failed"), "quality", (~failed & (F.col("quality") >= least)).alias("kept"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assess(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
