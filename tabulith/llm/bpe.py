"""BPE encoding and decoding over a table of distinct words.

A byte-level BPE tokenizer treats the stretches of a text between white space apart (a stretch has
the space before it, as in " word,"). Spark gathers the distinct stretches of all texts, each is
encoded once, and the table is kept as sorted hash arrays in the shared folder. Encoding cuts a text
again and joins the ids back by position; decoding joins ids with the vocabulary's pieces.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm import chunks
from tabulith.llm.hasharrays import HashArrays, shard_of, write_shard
from tabulith.llm.work import mounted, new_folder, partitions, prepare

#: White space as the pre-tokenizer has it.
_WS = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNITS = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: A space with white space on both sides, or at the end: only there cutting before a space is wrong.
_UNSAFE = f"[{_WS}] (?:[{_WS}]|$)"
#: Distinct stretches that a task holds before it hands them on.
_HELD = 300_000
#: Units that go to the library at once.
_AT_ONCE = 50_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizers library's tokenizer of a byte-level BPE file, without truncation and padding."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def _added(path: str) -> re.Pattern | None:
    found = _added_strings(path)
    return re.compile("(" + "|".join(map(re.escape, sorted(found, key=len, reverse=True))) + ")") if found else None


@lru_cache(maxsize=4)
def _added_strings(path: str) -> tuple[str, ...]:
    return tuple(x.content for x in tokenizer(path).get_added_tokens_decoder().values())


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _renumbered(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes below n that occur, in ascending order, and codes by their place among them."""
    there = np.zeros(n, bool)
    there[codes] = True
    used = np.flatnonzero(there)
    place = np.zeros(n, np.int64)
    place[used] = np.arange(len(used))
    return used, place[codes]


def units(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """First unit of each text (and the end), the unit's code at each position, distinct units by code."""
    added = _added(path)
    slow = pc.match_substring_regex(column, _UNSAFE)
    if added is not None:
        slow = pc.or_(slow, pc.match_substring_regex(column, added.pattern))
    slow_rows = np.flatnonzero(slow.to_numpy(zero_copy_only=False))
    easy = pc.if_else(slow, pa.scalar("", pa.large_string()), column) if len(slow_rows) else column
    split = pc.split_pattern(easy, " ")
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = split.flatten().dictionary_encode()
    codes, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    first = offsets[:-1]
    codes[first] += n  # nothing stands before a text's first piece
    used, codes = _renumbered(codes, 2 * n)
    behind, begin = used[used < n], used[used >= n] - n
    found = chunks.strings(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), coded.dictionary.take(pa.array(behind)), pa.scalar(" ", pa.large_string()))) + chunks.strings(coded.dictionary.take(pa.array(begin)))
    if (empty := found.index("") if "" in found else -1) >= 0:
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    if len(slow_rows):
        code = {u: i for i, u in enumerate(found)}
        each = [codes[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        for row in slow_rows.tolist():
            text, own = column[row].as_py(), []
            for i, part in enumerate(added.split(text) if added else [text]):
                own += [part] if i % 2 else _UNITS.findall(part)
            each[row] = np.array([code.setdefault(u, len(code)) for u in own], np.int64)
        found = list(code)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])])
        codes = np.concatenate(each) if each else codes
    return offsets, codes, found


def spread(offsets: np.ndarray, codes: np.ndarray, unit_ids: np.ndarray, sizes: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """ids of all texts, and where each text's begin (and the end); unit_ids lie one unit after another, or from start."""
    start = np.cumsum(sizes) - sizes if start is None else start
    size = sizes[codes]
    end = np.cumsum(size)
    at = np.repeat(start[codes] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
    return unit_ids[at], np.concatenate([[0], end])[offsets]


def _keys(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Key and check of units: 96 bits of one hash."""
    whole = [xxhash.xxh3_128_digest(u) for u in found]
    both = np.frombuffer(b"".join(whole), ">u8").reshape(-1, 2).astype(np.uint64)
    return both[:, 0], (both[:, 1] >> np.uint64(32)).astype(np.uint32)


@dataclass(frozen=True)
class WordTable:
    """ids of the distinct units of a corpus, in files of the shared folder."""

    folder: str
    shards: int
    tokenizer_file: str

    def ids(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of units one after another, and how many each has. Units that the table has not, or has
        no room for as two share a key, are encoded here."""
        key, check = _keys(found)
        arrays = HashArrays(self.folder, self.shards)
        sizes, hits, absent = np.zeros(len(found), np.int64), [], np.ones(len(found), bool)
        for shard, at, row in arrays.find(key):
            right = arrays.column(shard, "check")[row] == check[at]
            at, row = at[right], row[right]
            ends = arrays.column(shard, "end")
            before = np.where(row > 0, ends[row - 1], 0).astype(np.int64)
            sizes[at] = ends[row] - before
            absent[at] = False
            hits.append((shard, at, before))
        rest = np.flatnonzero(absent)
        own, own_sizes = encode_units([found[i] for i in rest.tolist()], self.tokenizer_file)
        sizes[rest] = own_sizes
        to = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        for shard, at, before in hits:
            out[_runs(to[at], sizes[at])] = arrays.column(shard, "ids")[_runs(before, sizes[at])]
        out[_runs(to[rest], own_sizes)] = own
        return out, sizes


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of n places each, one run after another."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def build_table(docs: DataFrame, tokenizer_file: str | None = None, text_col: str = "text", folder: str | None = None) -> WordTable:
    """Encodes each distinct unit of the texts once, with the tokenizers library."""
    spark = docs.sparkSession
    prepare(spark)
    path = tokenizer_file or default_file()
    shards = partitions(spark)
    where = mounted(new_folder(spark, "words", folder))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[str] = set()
        for part in chunks.pieces(batches, most=2 << 20):
            held.update(units(chunks.texts(part), path)[2])
            if len(held) > _HELD:
                yield emit(held)
                held = set()
        yield emit(held)

    def emit(held: set[str]) -> pa.RecordBatch:
        found = [x for x in held if x]
        key = _keys(found)[0] if found else np.zeros(0, np.uint64)
        return pa.RecordBatch.from_pydict({"shard": pa.array(shard_of(key, shards).astype(np.int32)), "unit": pa.array(found, pa.string())})

    def encode_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, set[str]] = {}
        for batch in batches:
            which = batch.column(0).to_numpy()
            for s in np.unique(which).tolist():
                mine.setdefault(s, set()).update(chunks.strings(batch.column(1).filter(pa.array(which == s))))
        while mine:
            s, left = mine.popitem()
            words = sorted(left)
            left.clear()
            key, check = _keys(words)
            order = np.argsort(key, kind="stable")
            key, check = key[order], check[order]
            alone = np.ones(len(key), bool)  # of units with one key the first is kept, and none if they are alike in the check too
            alone[1:] = key[1:] != key[:-1]
            same = np.flatnonzero(~alone)
            alone[same[check[same] == check[same - 1]] - 1] = False
            order = order[alone].tolist()
            made = [encode_units([words[i] for i in order[at : at + _AT_ONCE]], path) for at in range(0, len(order), _AT_ONCE)]
            small = np.uint16 if tokenizer(path).get_vocab_size() <= 1 << 16 else np.uint32
            ids = np.concatenate([np.zeros(0, small), *(x.astype(small) for x, _ in made)])
            ends = np.cumsum(np.concatenate([np.zeros(0, np.int64), *(n for _, n in made)]))
            write_shard(where, s, {"key": key[alone], "check": check[alone], "end": ends.astype(np.uint32), "ids": ids})
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(words)])})

    found = docs.select(docs[text_col].alias("text")).mapInArrow(gather, "shard int, unit string")
    found.repartitionById(shards, "shard").mapInArrow(encode_all, "n long").agg(F.sum("n")).collect()
    return WordTable(where, shards, path)


#: What the letters and white space of the pre-tokenizer's pattern are up to U+024F (fixed values); NUL is kept free as an end mark.
_L, _S = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f", r" \t-\r"
_PIECES = re.compile(rf"\0|'(?:[sdmt]|ll|ve|re)| ?[{_L}]+| ?[0-9]+| ?[^\0{_S}{_L}0-9]+|[{_S}]+(?![^\0{_S}])|[{_S}]+")
#: Units in which other characters stand go through the whole library.
_OTHER = "[^\x01-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"


@lru_cache(maxsize=4)
def _letters(path: str) -> dict[int, str]:
    """The vocabulary's letters for the UTF-8 bytes of the characters from U+0001 up to U+024F."""
    letter = {b: c for c, b in _byte_letters().items()}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(1, 0x250)}


def _byte_letters() -> dict[str, int]:
    """The byte for which each letter of a byte-level vocabulary stands."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=4)
def _model_alone(path: str):
    """The library's tokenizer with the same BPE model, and nothing that cuts texts before it."""
    from tokenizers import Tokenizer

    return Tokenizer(tokenizer(path).model)


@lru_cache(maxsize=4)
def _token_letters(path: str) -> np.ndarray:
    """Letters of each id's token."""
    vocab = tokenizer(path).get_vocab(with_added_tokens=False)
    out = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)
    out[list(vocab.values())] = list(map(len, vocab))
    return out


def _encode_pieces(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """ids and sizes of units that have only characters up to U+024F and no added token.

    The units are cut together, and their distinct pieces go to the BPE model together; as a piece's
    tokens have as many letters as it has itself, its ids are found again by counting letters."""
    coded = pa.array(_PIECES.findall("\0".join([*chunks.strings(column), ""])), pa.string()).dictionary_encode()
    codes, found = coded.indices.to_numpy().astype(np.int64), chunks.strings(coded.dictionary)
    mark = found.index("\0")
    del found[mark]
    letters = "\0".join(found).translate(_letters(path)).split("\0") if found else []
    ids = np.array(array("I", _model_alone(path).encode_batch_fast([letters], is_pretokenized=True, add_special_tokens=False)[0].ids), np.uint32)
    to = np.searchsorted(np.cumsum(_token_letters(path)[ids]), np.cumsum(list(map(len, letters))), side="right")
    sizes = np.insert(np.diff(to, prepend=0), mark, 0)
    size = sizes[codes]
    out = ids[_runs((np.cumsum(sizes) - sizes)[codes], size)]
    return out, np.diff(np.cumsum(size)[codes == mark], prepend=0)


def encode_units(found: list[str], path: str, at_once: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """ids of units by the library, one unit after another, and how many each has.

    Units of common characters are cut here and go to the library's BPE model, which spares its
    bookkeeping; all others, and those with an added token, go through the whole library."""
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    column = pa.array(found, pa.large_string())
    other = pc.match_substring_regex(column, _OTHER)
    for x in _added_strings(path):
        other = pc.or_(other, pc.match_substring(column, x))
    rest = np.flatnonzero(other.to_numpy(zero_copy_only=False))
    if not len(rest):
        return _encode_pieces(column, path)
    flat, own_sizes = array("I"), []
    for at in range(0, len(rest), at_once):
        for x in tokenizer(path).encode_batch_fast([found[i] for i in rest[at : at + at_once].tolist()], add_special_tokens=False):
            own = x.ids
            flat.extend(own)
            own_sizes.append(len(own))
    sizes, easy = np.zeros(len(found), np.int64), pc.invert(other)
    sizes[rest] = own_sizes
    ids = np.zeros(0, np.uint32)
    if len(rest) < len(found):
        ids, sizes[easy.to_numpy(zero_copy_only=False)] = _encode_pieces(column.filter(easy), path)
    out = np.empty(int(sizes.sum()), np.uint32)
    to = np.cumsum(sizes) - sizes
    mine = easy.to_numpy(zero_copy_only=False)
    out[_runs(to[mine], sizes[mine])] = ids
    out[_runs(to[rest], sizes[rest])] = np.array(flat, np.uint32)
    return out, sizes


def _carried(docs: DataFrame, text_col: str, extra: dict[str, Column]) -> tuple[DataFrame, str]:
    frame = docs.select(*(c.alias(n) for n, c in extra.items()), docs[text_col].alias("text"))
    return frame, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])


def _ids(part: pa.RecordBatch, table: WordTable) -> pa.Array:
    """ids of a batch's texts."""
    offsets, codes, found = units(chunks.texts(part), table.tokenizer_file)
    ids, first = spread(offsets, codes, *table.ids(found))
    return binary(ids.astype("<u4"), first * 4)


def encode(docs: DataFrame, table: WordTable, extra: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The extra columns and ``ids`` (little-endian unsigned 32-bit integers) of every row's whole text.

    Strings of added tokens in a text become those tokens, as in the library. Null text is empty; an
    empty text has no ids; an empty table gives no rows; rows alike give rows alike.
    """
    prepare(docs.sparkSession)
    frame, schema = _carried(docs, text_col, extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks.pieces(batches, most=2 << 20):
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], _ids(part, table)], names=[*part.schema.names[:-1], "ids"])

    return frame.mapInArrow(run, f"{schema}, ids binary")


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Stretches of an array as binary values; offsets in bytes."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


@lru_cache(maxsize=4)
def pieces(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the vocabulary's pieces one after another, and where each id's begin (and the end)."""
    byte = _byte_letters()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = {i: bytes(byte[c] for c in t) for t, i in spec["model"]["vocab"].items()} | {x["id"]: x["content"].encode() for x in spec["added_tokens"]}
    each = [vocab.get(i, b"") for i in range(max(vocab) + 1)]
    return np.frombuffer(b"".join(each), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in each])])


def _texts(ids_column: pa.Array, path: str) -> pa.Array:
    """Texts of ids, joined with the vocabulary's pieces."""
    data, start = pieces(path)
    raw, ends = chunks.raw(pc.fill_null(pc.cast(ids_column, pa.large_binary()), b""))
    ids = np.frombuffer(raw.tobytes(), "<u4")
    n = np.diff(start)[ids]
    out = data[_runs(start[ids], n)].tobytes()
    cut = np.concatenate([[0], np.cumsum(n)])[ends // 4].tolist()
    return pa.array([out[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.string())


def decode(encoded: DataFrame, tokenizer_file: str | None = None, ids_col: str = "ids") -> DataFrame:
    """encoded with a column ``decoded``: the text of the ids, special tokens as their strings; null ids give "".

    Bytes that are no UTF-8 become U+FFFD."""
    path = tokenizer_file or default_file()
    prepare(encoded.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks.pieces(batches, ids_col, 4 << 20):
            texts = _texts(batch.column(batch.schema.get_field_index(ids_col)), path)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, f"{schema}, decoded string")


def round_trip(docs: DataFrame, extra: dict[str, Column], tokenizer_file: str | None = None, text_col: str = "text") -> DataFrame:
    """The extra columns, ids and decoded, with a word table of the texts themselves.

    One worker for each task encodes and decodes; rows are as encode() and decode() give them."""
    table = build_table(docs, tokenizer_file, text_col)
    frame, schema = _carried(docs, text_col, extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks.pieces(batches, most=2 << 20):
            ids = _ids(part, table)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, _texts(ids, table.tokenizer_file)], names=[*part.schema.names[:-1], "ids", "decoded"])

    return frame.mapInArrow(run, f"{schema}, ids binary, decoded string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = round_trip(docs, {"doc_id": docs["doc_id"]})
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def encoder(path: str, most: int = 500_000) -> Encoder:
    """Encodes texts by their distinct units without a table; up to ``most`` units are remembered."""
    known: dict[str, int] = {}
    held, start, size, used = np.zeros(1 << 16, np.uint32), np.zeros(most, np.int64), np.zeros(most, np.int64), 0

    def run(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        nonlocal held, used
        offsets, codes, found = units(column, path)
        at = np.fromiter(map(known.get, found, repeat(-1)), np.int64, len(found))
        absent = np.flatnonzero(at < 0)
        new = [found[i] for i in absent.tolist()]
        ids, n = encode_units(new, path)
        begin, many = start[at], size[at]
        begin[absent], many[absent] = used + np.cumsum(n) - n, n
        kept = min(len(new), most - len(known))
        start[len(known) : len(known) + kept], size[len(known) : len(known) + kept] = begin[absent[:kept]], n[:kept]
        known.update(zip(new[:kept], range(len(known), len(known) + kept), strict=True))
        everything = used + len(ids)
        if everything > len(held):
            held = np.concatenate([held, np.zeros(everything, np.uint32)])
        held[used:everything] = ids
        used += int(n[:kept].sum())
        return spread(offsets, codes, held, many, begin)

    return run


@lru_cache(maxsize=2)
def worker_encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return encoder(path)
