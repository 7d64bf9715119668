"""Token ids in fixed-width bit packing, with block offsets for random access.

Each id takes the bits that the largest id of the vocabulary needs, one after another,
least significant bit first. A block holds whole documents, as many as reach
`BLOCK_IDS` ids, and is one row of a shard:

    shard, block, first_id, n_ids, width, doc_ids, ends, payload

`first_id` counts the ids of the shard before the block, `ends[i]` the ids of the block up to the
end of document i, so id j of document i is at bit `(ends[i - 1] + j) * width` of the payload.
Shards follow each other in ascending doc_id order. The container is Parquet, because
Spark commits it atomically to any store and a task that is run again replaces its own file; a block row is unpacked by numpy
alone. Blocks are written in order, so statistics of `first_id` lead a reader to the row group of a position.

Defined results: a null or empty text is only the end id; a null doc_id sorts first; rows of one id
are ordered by the hash of their text and may lie in neighbouring shards; an empty table gives no block; other columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveylake.llm.words import Words, pieces, raw_bytes, word_spans

BLOCK_IDS = 1 << 16
ROW_GROUP_BYTES = 32 << 20
END_ID = 1
BLOCK_FIELDS = (
    "shard int, block int, first_id long, n_ids long, width int, doc_ids array<long>, ends array<long>, payload binary"
)
# Distinct words whose ids a worker remembers; beyond that it begins anew.
REMEMBERED = 600_000


def width_of(vocabulary_size: int) -> int:
    """Bits for ids 0 to vocabulary_size - 1, one at least."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """Ids start to start + count of a payload; only the bytes that hold them are touched."""
    first = start * width
    part = np.frombuffer(payload, dtype=np.uint8)[first // 8 : (first + count * width + 7) // 8]
    bits = np.unpackbits(part, bitorder="little")[first % 8 : first % 8 + count * width].reshape(count, width)
    wide = np.zeros((count, 32), dtype=np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def pretokens(texts: pa.Array) -> Words:
    """Texts cut into parts that the tokenizer treats one by one: at white space, and before ASCII punctuation that follows a letter.

    Letters and punctuation never share a token, and the tokenizer lower-cases, so
    concatenating the parts' ids gives the text's ids. Texts with a possible special token (`<|`) are cut at white space only.
    """
    data, offsets = raw_bytes(texts)
    if not len(data):
        return Words(np.zeros(len(offsets), dtype=np.int64), np.zeros(0, dtype=np.int32), pa.array([], pa.binary()))
    solid, starts, _ = word_spans(data, offsets)
    special = np.any((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    if not special:
        begin = np.zeros(len(data), dtype=bool)
        begin[starts] = True
        letter = _LETTER[data]
        # U+00C0 to U+00FF without the signs of multiplication and division, in two bytes.
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begin[1:] |= letter[:-1] & _PUNCTUATION[data[1:]]
        starts = np.flatnonzero(begin)
        data = _LOWER[data]
    ends = np.append(np.cumsum(solid)[starts] - 1, np.count_nonzero(solid)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[solid]))]
    ).dictionary_encode()
    return Words(np.searchsorted(starts, offsets), words.indices.to_numpy(zero_copy_only=False), words.dictionary)


class WordEncoder:
    """Ids of texts by a tokenizer of the tokenizers library whose pre-tokens never span white space; each distinct part is encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)  # ids of all known parts, one after another
        self.ends = np.zeros(1, dtype=np.int64)  # part i is flat[ends[i]:ends[i + 1]]

    def _learn(self, unknown: list[bytes]) -> None:
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in unknown], add_special_tokens=False)
        ids = [e.ids for e in encoded]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        more = np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int32, count=int(lengths.sum()))
        self.places.update(zip(unknown, range(len(self.places), len(self.places) + len(unknown))))
        self.flat = np.concatenate([self.flat, more])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        words = pretokens(texts)
        vocabulary = words.vocabulary.to_pylist()
        if len(self.places) > REMEMBERED:
            self._forget()
        unknown = [w for w in vocabulary if w not in self.places]
        if unknown:
            self._learn(unknown)
        part = np.fromiter(map(self.places.__getitem__, vocabulary), dtype=np.int64, count=len(vocabulary))[words.codes]
        sizes = self.ends[part + 1] - self.ends[part]
        total = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(self.ends[part] - total[:-1], sizes) + np.arange(total[-1])
        return self.flat[where], total[words.bounds[1:]] - total[words.bounds[:-1]]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


class _ShardWriter:
    """Gathers documents into blocks."""

    def __init__(self, shard: int, width: int, block_ids: int):
        self.shard, self.width, self.block_ids = shard, width, block_ids
        self.block, self.first_id = 0, 0
        self.parts: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.ends: list[int] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        self.parts.append(ids)
        self.docs.append(doc_id)
        self.held += len(ids)
        self.ends.append(self.held)
        if self.held >= self.block_ids:
            yield from self.close()

    def close(self) -> Iterator[dict]:
        if not self.docs:
            return
        yield {
            "shard": self.shard,
            "block": self.block,
            "first_id": self.first_id,
            "n_ids": self.held,
            "width": self.width,
            "doc_ids": self.docs,
            "ends": self.ends,
            "payload": pack(np.concatenate(self.parts), self.width),
        }
        self.block, self.first_id = self.block + 1, self.first_id + self.held
        self.parts, self.docs, self.ends, self.held = [], [], [], 0


BLOCK_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("width", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def write_blocks(
    docs: DataFrame, path: str, tokenizer: Callable[[], str], shards: int, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> None:
    """Encode documents in ascending doc_id order into `shards` packed shards at `path`.

    `tokenizer` gives the vocabulary file's place on the machine that calls it.
    """
    width = width_of(vocabulary_size(tokenizer()))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_text_hash")]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text_hash"), "text")
    ordered = narrow.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer, words = _ShardWriter(TaskContext.get().partitionId(), width, block_ids), encoder(tokenizer())
        end = np.array([end_id], dtype=np.int32)
        for batch in batches:
            for piece in pieces(batch):
                ids, counts = words.encode(piece.column(1))
                at = 0
                for doc_id, count in zip(piece.column(0).to_pylist(), counts.tolist()):
                    for block in writer.add(doc_id, np.concatenate([ids[at : at + count], end])):
                        yield pa.RecordBatch.from_pylist([block], schema=BLOCK_ARROW)
                    at += count
        for block in writer.close():
            yield pa.RecordBatch.from_pylist([block], schema=BLOCK_ARROW)

    # Row groups of this size bound what a reader of many blocks holds at once.
    ordered.mapInArrow(run, BLOCK_FIELDS).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def read_blocks(spark, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_FIELDS).parquet(path)


def document_ids(block: dict, i: int) -> np.ndarray:
    """The ids of document i of a block row, unpacked from its place."""
    begin = block["ends"][i - 1] if i else 0
    return unpack(block["payload"], block["width"], begin, block["ends"][i] - begin)


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document, from the blocks: `doc_id`, `start` over all shards, `n_tokens`, `ids_crc32`."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    begins = totals.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("shard_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = {f.name: batch.column(j)[row].as_py() for j, f in enumerate(batch.schema)}
                ids = unpack(block["payload"], block["width"], 0, block["n_ids"])
                ends = np.array(block["ends"], dtype=np.int64)
                begin = np.concatenate([[0], ends[:-1]])
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array([block["shard"]] * len(ends), pa.int32()),
                        pa.array(begin + block["first_id"], pa.int64()),
                        pa.array(ends - begin, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "shard", "shard_offset", "n_tokens", "ids_crc32"],
                )

    read = blocks.mapInArrow(run, "doc_id long, shard int, shard_offset long, n_tokens long, ids_crc32 long")
    return read.join(F.broadcast(begins), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("shard_offset")).alias("start"), "n_tokens", "ids_crc32"
    )
