"""Hashed character n-grams of the words of a batch, and sums of their rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def sums_of_runs(table: np.ndarray, buckets: np.ndarray, begins: np.ndarray, counts: np.ndarray, longest: int = 128) -> np.ndarray:
    """np.add.reduceat(table[buckets], begins, axis=0) to the last bit, for runs of `counts` rows, at least one.

    Runs of the same length are added place by place, in the order in which numpy adds a run: its first row to the sum of the others,
    and eight sums side by side where these are eight or more. Runs past `longest` are left to numpy.
    """
    out = np.empty((len(begins), table.shape[1]), dtype=table.dtype)
    for count in np.unique(np.minimum(counts, longest + 1)).tolist():
        runs = np.flatnonzero(counts == count if count <= longest else counts > longest)
        if count > longest:
            for i in runs:
                out[i] = np.add.reduceat(table[buckets[begins[i] : begins[i] + counts[i]]], [0], axis=0)[0]
            continue
        rows = table.take(buckets[begins[runs] + np.arange(count)[:, None]], axis=0)
        first, others = rows[0], rows[1:]
        side = len(others) // 8 * 8
        for i in range(8, side):
            others[i % 8] += others[i]
        for step in (1, 2, 4) if side else ():
            for i in range(0, 8, 2 * step):
                others[i] += others[i + step]
        for i in range(side or 1, len(others)):
            others[0] += others[i]
        out[runs] = first + others[0] if count > 1 else first
    return out


class WordGrams:
    """Buckets of the n-grams of each word (bytes, A-Z lower-cased, with a mark before and after).

    `buckets[i]` and `counts[i]` belong to the i-th n: the buckets of all words one after
    another, and how many each word has. n = 0 stands for the whole word.
    """

    def __init__(self, vocabulary: pa.Array, sizes: tuple[int, ...], bits: int):
        column = vocabulary.cast(pa.large_binary())
        n = len(column)
        lengths = np.zeros(n, dtype=np.int64)
        if n:
            offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
            raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
            lengths = np.diff(offsets)
        else:
            raw = np.zeros(0, dtype=np.uint8)
        marked = np.zeros(len(raw) + 2 * n, dtype=np.uint64)
        ends = np.cumsum(lengths + 2)
        begins = ends - lengths - 2
        inner = np.arange(len(raw)) + np.repeat(2 * np.arange(n) + 1, lengths)
        marked[inner] = _LOWER[raw]
        marked[begins], marked[ends - 1] = 1, 2
        shift = np.uint64(64 - bits)
        self.words = n
        self.buckets: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        for size in sizes:
            if size == 0:
                values = self._whole(marked, begins, ends)
                counts = np.ones(n, dtype=np.int64)
            else:
                counts = np.maximum(lengths + 2 - size + 1, 0)
                total = int(counts.sum())
                first = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(total)
                values = np.full(total, size, dtype=np.uint64)
                for i in range(size):
                    values = (values + marked[first + i]) * _MIX
                    values ^= values >> np.uint64(31)
            self.buckets.append(((values * _MIX) >> shift).astype(np.int64))
            self.counts.append(counts)

    @staticmethod
    def _whole(marked: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(begins):
            return np.zeros(0, dtype=np.uint64)
        place = np.arange(len(marked), dtype=np.uint64) - np.repeat(begins, ends - begins).astype(np.uint64)
        mixed = (marked + np.uint64(257) * place + np.uint64(7)) * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
        return np.add.reduceat(mixed, begins)

    def totals(self) -> np.ndarray:
        return sum(self.counts, np.zeros(self.words, dtype=np.int64))

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Per word, the sum of the table's rows at its buckets."""
        out = np.zeros((self.words, table.shape[1]), dtype=np.float32)
        for buckets, counts in zip(self.buckets, self.counts):
            some = np.flatnonzero(counts)
            if len(some):
                out[some] += sums_of_runs(table, buckets, (np.cumsum(counts) - counts)[some], counts[some])
        return out
