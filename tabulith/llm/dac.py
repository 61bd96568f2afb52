"""Token ids in files of directly addressable codes.

An id is cut into chunks of 8 bits, lowest first. Level 0 has the first chunk of every id, and a
bitmap with a 1 where the id goes on; level 1 has the second chunks of those that do, in order, with
a bitmap of its own, and so on. A rank directory counts the ones before every 512 bits, so that the
place of an id's next chunk follows from one directory entry and at most eight words of the bitmap:
any token can be read without decoding a block.

A file is a JSON line (the arrays' names, types, places) padded to 8 bytes, then the arrays.
Documents lie in ascending id order (null first; rows with one id by their text's hash), each with
an end id. Files are numbered by range of ids, then in order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulith.llm import chunks
from tabulith.llm.bpe import default_file, worker_encoder
from tabulith.llm.work import mounted, new_folder, partitions, prepare, replace_file, stash

CHUNK = 8
#: Bits for each entry of the rank directory.
STRIDE = 512
#: A file ends with the document that brings it to so many ids.
FILE_IDS = 4 << 20


def pack(ids: np.ndarray) -> dict[str, np.ndarray]:
    """The levels of ids: chunk.l, bits.l (least bit first) and rank.l."""
    out, rest, level = {}, ids.astype(np.uint32), 0
    while True:
        more = rest >> CHUNK > 0
        out[f"chunk.{level}"] = (rest & 0xFF).astype(np.uint8)
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(bits) // (STRIDE // 8)) * (STRIDE // 8), np.uint8)
        padded[: len(bits)] = bits
        ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, STRIDE // 64).sum(1, dtype=np.uint64)
        out[f"bits.{level}"], out[f"rank.{level}"] = padded, np.concatenate([[0], np.cumsum(ones)]).astype(np.uint64)
        if not more.any():
            return out
        rest, level = rest[more] >> CHUNK, level + 1


class DacFile:
    """A memory-mapped file; ``token(i)`` and ``span(a, b)`` read ids, ``docs`` the documents' ids."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        head = bytes(raw[: int(np.flatnonzero(raw[: 1 << 16] == 10)[0])])
        self.arrays = {name: raw[at : at + n].view(kind) for name, (kind, at, n) in json.loads(head).items()}
        self.starts = self.arrays["starts"]
        self.levels = sum(name.startswith("chunk.") for name in self.arrays)

    def docs(self) -> pa.Array:
        return pa.ipc.open_stream(pa.py_buffer(self.arrays["docs"].tobytes())).read_all().column(0).combine_chunks()

    def rank(self, level: int, i: int) -> int:
        """Ones before bit i of a level's bitmap."""
        block, within = divmod(i, STRIDE)
        words = self.arrays[f"bits.{level}"].view(np.uint64)[block * (STRIDE // 64) : block * (STRIDE // 64) + -(-within // 64)]
        n = int(self.arrays[f"rank.{level}"][block])
        if len(words):
            last = within - 64 * (len(words) - 1)
            n += int(np.bitwise_count(words[:-1]).sum()) + (int(words[-1]) & ((1 << last) - 1)).bit_count()
        return n

    def token(self, i: int) -> int:
        value = 0
        for level in range(self.levels):
            value |= int(self.arrays[f"chunk.{level}"][i]) << (CHUNK * level)
            if not self.arrays[f"bits.{level}"][i >> 3] >> (i & 7) & 1:
                break
            i = self.rank(level, i)
        return value

    def span(self, a: int, b: int) -> np.ndarray:
        out = np.zeros(b - a, np.uint32)
        at = np.arange(b - a)
        for level in range(self.levels):
            out[at] |= self.arrays[f"chunk.{level}"][a:b].astype(np.uint32) << np.uint32(CHUNK * level)
            bits = np.unpackbits(self.arrays[f"bits.{level}"][a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 :][: b - a]
            at = at[bits > 0]
            if not len(at):
                break
            a = self.rank(level, a)
            b = a + len(at)
        return out


def write_file(path: str, docs: pa.Array, starts: np.ndarray, ids: np.ndarray) -> None:
    sink = pa.BufferOutputStream()
    table = pa.table({"doc_id": docs})
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    arrays = {"docs": np.frombuffer(sink.getvalue(), np.uint8), "starts": starts.astype(np.uint64)} | pack(ids)
    size = lambda n: -(-n // 8) * 8
    room, head = 0, b""
    while len(head) + 1 > room:  # places depend on the head's own length
        room = size(max(len(head) + 1, room + 8))
        at, places = room, {}
        for name, a in arrays.items():
            places[name] = (a.dtype.str, at, a.nbytes)
            at += size(a.nbytes)
        head = json.dumps(places).encode()

    def put(f) -> None:
        f.write(head.ljust(room - 1) + b"\n")
        for a in arrays.values():
            f.write(a.tobytes().ljust(size(a.nbytes), b"\0"))

    replace_file(path, put)


@lru_cache(maxsize=64)
def open_file(path: str) -> DacFile:
    return DacFile(path)


def write(docs: DataFrame, folder: str | None = None, tokenizer_file: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and writes every row's whole text, and gives the files: number, file, path, docs, ids, start.

    Null text is empty, so only the end id is written. An empty table gives no files; other columns
    are ignored. A repeated task writes the same files again under their names. Each call writes to a folder
    of its own, in ``folder`` if one is named.
    """
    spark = docs.sparkSession
    prepare(spark)
    path, where = tokenizer_file or default_file(), mounted(new_folder(spark, "tokens", folder))
    key = F.xxhash64(docs[text_col])
    frame = docs.select(docs[id_col].alias("doc_id"), key.alias("text_key"), docs[text_col].alias("text"))
    frame = frame.repartitionByRange(partitions(spark), "doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number, file = worker_encoder(path), TaskContext.get().partitionId(), 0
        names, parts, sizes = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal file, names, parts, sizes
            n = np.concatenate(sizes)
            out = f"{where}/{number:06d}-{file:06d}.dac"
            write_file(out, pa.concat_arrays(names), np.concatenate([[0], np.cumsum(n)]), np.concatenate(parts))
            row = {"number": [number], "file": [file], "path": [out], "docs": [len(n)], "ids": [int(n.sum())]}
            file, names, parts, sizes = file + 1, [], [], []
            return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k in ("number", "file") else None) for k, v in row.items()})

        for part in chunks.pieces(batches):
            ids, first = encode(chunks.texts(part))
            names.append(part.column(0))
            sizes.append(np.diff(first) + 1)
            parts.append(np.insert(ids, first[1:], np.uint32(end_id)))
            if sum(map(len, parts)) >= FILE_IDS:
                yield flush()
        if sizes:
            yield flush()

    files = stash(frame.mapInArrow(run, "number int, file int, path string, docs long, ids long"), "files")
    before = Window.orderBy("number", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(files: DataFrame, id_type: str = "long") -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian) from the files."""
    prepare(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (x for batch in batches for x in batch.to_pylist()):
            dac = open_file(row["path"])
            docs, starts = dac.docs(), dac.starts.astype(np.int64)
            for at in range(0, len(docs), 1000):
                own = starts[at : at + 1001].tolist()
                ids = [dac.span(a, b).astype("<u4").tobytes() for a, b in zip(own[:-1], own[1:], strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": docs.slice(at, 1000), "start": pa.array([row["start"] + a for a in own[:-1]]), "n_tokens": pa.array([len(x) // 4 for x in ids]), "ids": pa.array(ids, pa.binary())})

    spread = files.repartition(partitions(files.sparkSession), "path")
    return spread.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = read(write(docs), docs.schema["doc_id"].dataType.simpleString())
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
