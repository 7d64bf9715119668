"""Whole texts of an Arrow batch as word codes, and scratch tables shared by the operators of this package.

A word is a run of characters other than the six ASCII white-space characters
(space, tab, line feed, vertical tab, form feed, carriage return).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Texts of one batch are worked on in pieces of whole rows of about so many bytes.
CHUNK_BYTES = 4 << 20


@dataclass
class Words:
    """`codes[bounds[i]:bounds[i + 1]]` are the words of text i, as positions in `vocabulary` (bytes)."""

    bounds: np.ndarray
    codes: np.ndarray
    vocabulary: pa.Array

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and where each begins; a null text has none."""
    column = texts.cast(pa.large_binary()).fill_null(b"")
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data_buffer is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data_buffer, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes belong to words, where each word begins, and the first word of each text."""
    solid = ~_SPACE[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    inner = offsets[offsets < len(data)]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    return solid, starts, np.searchsorted(starts, offsets)


def split_words(texts: pa.Array) -> Words:
    data, offsets = raw_bytes(texts)
    if not len(data):
        return Words(np.zeros(len(offsets), dtype=np.int64), np.zeros(0, dtype=np.int32), pa.array([], pa.binary()))
    solid, starts, bounds = word_spans(data, offsets)
    ends = np.append(np.cumsum(solid)[starts] - 1, np.count_nonzero(solid)).astype(np.int64)
    flat = np.ascontiguousarray(data[solid])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(flat)]
    )
    coded = words.dictionary_encode()
    return Words(bounds, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows, cut where the text bytes pass a multiple of the limit; a long text is a slice of its own."""
    if not batch.num_rows:
        return
    _, offsets = raw_bytes(batch.column(batch.schema.get_field_index(column)))
    block = offsets[:-1] // limit
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(low, high - low)


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]], also for empty ranges."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: its rows survive the executors that made them."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for a null one; each word ends where white space or the text ends."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fitting_texts(rows: DataFrame, group: str, limit: int) -> DataFrame:
    """The texts that a model is fitted on, from the rows of a few sampled ids: `doc_id`, `text` and `group`.

    One text of each id and group (the smallest by hash), so repeated ids add no rows; and in each group, in the order of the
    ids' hashes, as many as hold `limit` bytes together. The rows of a group are those of a bounded sample of ids.
    """
    picked = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text"))).alias("_picked")
    one = rows.groupBy("doc_id", group).agg(picked).select("doc_id", F.col("_picked.text").alias("text"), group)
    order = Window.partitionBy(group).orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    held = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).over(order)
    return one.withColumn("_held", held).filter(F.col("_held") <= limit).drop("_held")
