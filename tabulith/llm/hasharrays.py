"""Sorted hash arrays in files, dealt into shards by the key's leading bits and memory-mapped.

Shard s of S holds the keys whose leading 16 bits fall in the s-th of S equal ranges, in ascending
order, so one ascending list of keys visits the shards one after another.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from tabulith.llm.work import replace_file

LEADING = np.uint64(48)
MOST_SHARDS = 1 << 16


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> LEADING).astype(np.int64) * shards) >> 16


def write_shard(folder: str, shard: int, arrays: dict[str, np.ndarray]) -> None:
    """arrays["key"] is ascending and without repeats; other columns lie beside it."""
    for name, values in arrays.items():
        replace_file(f"{folder}/{shard:05d}.{name}.npy", lambda f, v=values: np.save(f, v))


@lru_cache(maxsize=4096)
def _mapped(path: str) -> np.ndarray | None:
    return np.load(path, mmap_mode="r") if os.path.exists(path) else None


class HashArrays:
    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards

    def column(self, shard: int, name: str) -> np.ndarray | None:
        return _mapped(f"{self.folder}/{shard:05d}.{name}.npy")

    def find(self, keys: np.ndarray):
        """Yields (shard, index into keys, row in the shard) for the keys that are there."""
        order = np.argsort(keys)
        ranked = keys[order]
        which = shard_of(ranked, self.shards)
        starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else []
        for at, to in zip(starts, [*starts[1:], len(which)], strict=True):
            shard = int(which[at])
            stored = self.column(shard, "key")
            if stored is None or not len(stored):
                continue
            wanted = ranked[at:to]
            row = np.searchsorted(stored, wanted)
            row[row == len(stored)] = 0
            hit = stored[row] == wanted
            yield shard, order[at:to][hit], row[hit]
