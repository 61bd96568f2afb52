"""Whole texts in Arrow batches, cut between documents into pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of text; a longer text makes a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts(batch: pa.RecordBatch, name: str = "text", lower: bool = False) -> pa.Array:
    """The text column as large strings that begin at offset 0, null as empty; with lower, A-Z lower-cased.

    Arrow's ascii_lower gives wrong bytes for slices, so the bytes are lower-cased here."""
    column = batch.column(batch.schema.get_field_index(name))
    data, ends = raw(pc.fill_null(pc.cast(column, pa.large_string()), ""))
    held = data.tobytes()
    return pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(np.ascontiguousarray(ends)), pa.py_buffer(held.lower() if lower else held)])


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (and the end)."""
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def strings(column: pa.Array) -> list[str]:
    """An array's values as a list, by way of NumPy, which is several times faster."""
    return column.to_numpy(zero_copy_only=False).tolist()


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between the six ASCII spaces: first word of each text (and the end), the word's code at
    each position, and the distinct words by code."""
    split = pc.ascii_split_whitespace(column)
    flat, offsets = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # an empty string stands before a leading or after a trailing space
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return offsets.astype(np.int64), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of 64-bit values."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x
