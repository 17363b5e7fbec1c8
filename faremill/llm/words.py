"""Words of whole texts as arrays, read straight from Arrow's byte buffers.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed
and carriage return. All of these are single bytes in UTF-8, so words are found on bytes,
for every text of a slice at once.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SEPARATORS)] = False

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20_240_501))
_PLACE = _rng.integers(1, 2**63, (2, 4096), dtype=np.uint64) * _U(2) + _U(1)
_FAR = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    return mix(left * _U(0xD6E8FEB86659FD93) + (right ^ (right >> _U(32))) * _U(0xA0761D6478BD642F))


class Words:
    """Words of the texts of one slice.

    data: bytes of all texts; starts, ends: byte range of each word; doc: text of each
    word; first: for each text, the index of its first word, with the total at the end.
    """

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = text_bytes(texts)
        inside = IS_WORD[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        heads = self.offsets[:-1]
        before[heads[heads < len(inside)]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        tails = self.offsets[1:] - 1
        after[tails[(tails >= 0) & (self.offsets[1:] > self.offsets[:-1])]] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self._inside = inside

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, kind: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, the same in every process. kind 1: another such hash."""
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
        values = (self.data[self._inside].astype(np.uint64) + _U(1)) * (
            _PLACE[kind, place & 4095] + (place >> 12).astype(np.uint64) * _FAR
        )
        return mix(np.add.reduceat(values, at) + lengths.astype(np.uint64))

    def left(self) -> np.ndarray:
        """Words of the same text from each word on, itself included."""
        return self.first[1:][self.doc] - np.arange(len(self))

    def word(self, index: int) -> bytes:
        return self.data[self.starts[index] : self.ends[index]].tobytes()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty) and where each text begins and ends in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, values = texts.buffers()
    n = len(texts)
    if n == 0 or where is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    offsets = np.frombuffer(where, dtype=wide)[texts.offset : texts.offset + n + 1].astype(np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.zeros(0, dtype=np.uint8)
    if high > low:
        data = np.frombuffer(values, dtype=np.uint8)[low:high]
    return data, offsets - low


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 of a slice are meaningless."""
    have, out, done = 1, None, 0
    power = words
    while True:
        if n & have:
            if out is None:
                out, done = power, have
            else:
                out = pair(out, _shift(power, done))
                done += have
        if done == n:
            return out
        power = pair(power, _shift(power, have))
        have *= 2


def _shift(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def kept_in_worker(name: str, make):
    """make(), once in the life of a Python worker: Spark reuses workers for many tasks."""
    store = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def give_back() -> None:
    """Return freed memory to the system. Python workers live on for later tasks of any kind,
    and what allocators keep for themselves would add up beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def slices(batches, column: str = "text", most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about most_bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        _, offsets = text_bytes(texts)
        at, rows = 0, batch.num_rows
        while at < rows:
            to = int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1
            to = min(rows, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to
    give_back()
