"""Word hashes of whole texts inside tasks."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash


class WordHashes(dict):
    """64-bit hash of each word seen; bounded."""

    limit = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) > self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, words, count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, count)


KNOWN = WordHashes()  # of the running task; ``forgetting`` empties it


def give_back() -> None:
    """Return what a task has freed to the system: allocators keep it, in every worker process, through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def forgetting(task, *caches):
    """``task`` (batches to batches) that leaves the caches empty and its memory free: a worker process outlives its tasks and stages."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            for c in (KNOWN, *caches):
                c.clear()
            give_back()
    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combined(hashes: np.ndarray, offsets: list[int], seed: int = 0) -> np.ndarray:
    """For each start, one hash of the words at ``offsets`` from it, in order."""
    n = max(0, len(hashes) - max(offsets))
    out = np.full(n, (0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64), np.uint64)
    for j, k in enumerate(offsets):  # another odd factor for each place
        out += hashes[k:k + n] * np.uint64((0xD6E8FEB86659FD93 * (2 * j + 1)) % (1 << 64))
    return mixed(out)
