"""Texts as flat numpy arrays of words: the form every word-based operator works on.

A slice of an Arrow batch is split once, in C++, into one flat list of words;
each distinct word is looked at once, and everything after that is array work
on word codes or word hashes. Words are runs of anything but ASCII white space.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 8 << 20  # text per slice: bounds a task's memory whatever the batch holds
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)


def released() -> None:
    """Give memory that is free, but held by Arrow and the C library, back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def tidied(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """`run` over a task's batches, after which its Python worker holds no more than before.

    Workers are used again by later tasks and stay while Spark's own operators
    work, so what one task needed at most would add to all that follows.
    """

    @wraps(run)
    def tidy(*given) -> Iterator[pa.RecordBatch]:
        yield from run(*given)
        released()

    return tidy


def slices(batches: Iterable[pa.RecordBatch], budget: int = SLICE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about `budget` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = (np.cumsum(size, dtype=np.int64) - size) // budget
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1, [batch.num_rows]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column without nulls (null reads as empty)."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def fold_ascii(texts: pa.Array) -> pa.Array:
    """Lower-case A-Z and nothing else."""
    return pc.ascii_lower(texts)


class Words:
    """The words of a slice: `code` (index into `vocab`) per word, `start` per text (one more than texts)."""

    def __init__(self, texts: pa.Array) -> None:
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten()
        bounds = split.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        real = pc.greater(pc.binary_length(flat), 0)  # text edges give empty pieces
        if pc.all(real).as_py() is False:
            keep = real.to_numpy(zero_copy_only=False)
            bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
            flat = flat.filter(real)
        coded = flat.dictionary_encode()
        self.start = bounds
        self.code = coded.indices.to_numpy(zero_copy_only=False)
        self.vocab = coded.dictionary
        self.count = np.diff(bounds)

    def __len__(self) -> int:
        return len(self.code)

    @property
    def doc(self) -> np.ndarray:
        """The text (place in the slice) of every word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every word, the same in every task."""
        h = xxhash.xxh3_64_intdigest
        distinct = np.fromiter((h(w, seed) for w in self.vocab.cast(pa.binary()).to_pylist()), np.uint64, len(self.vocab))
        return distinct[self.code] if len(self.vocab) else np.empty(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (a bijection)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from every place on (len(h) - n + 1 values, texts ignored)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    size = len(h) - n + 1
    out = h[:size].copy()
    with np.errstate(over="ignore"):
        for j in range(1, n):
            out *= BASE
            out += h[j : size + j]
    return out


def inside(start: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the total - n + 1 windows of n words lie in one text."""
    size = max(0, total - n + 1)
    ok = np.ones(size, bool)
    for back in range(1, n):  # a window may not run over the next text's start
        at = start[1:-1] - back
        ok[at[(at >= 0) & (at < size)]] = False
    return ok


def per_text(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of word values by text."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[start[1:]] - total[start[:-1]]
