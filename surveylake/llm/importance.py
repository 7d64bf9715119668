"""Draw documents that resemble a target set: importance weights from hashed n-gram counts, and seeded Gumbel keys.

A table of 256 bytes lower-cases A-Z and blanks every other ASCII byte that is no letter or digit, so that a
translated text splits into its words with `bytes.split`; bytes of multi-byte characters belong to words. A feature
is a run of 1 to `max_n` consecutive words, joined by a space. Its hash is a chain: the CRC-32 of a run is the seed
from which the space and the next word go on, so no joined text is made. Counters count the words of a task, and
Spark adds up one number per bucket and task.

A bucket's gain is floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for s of S source and t of T target features
in B buckets; a document's weight is the floored mean gain of its features, and its score adds a Gumbel number
drawn from the SHA-256 of seed and doc_id. Drawn are the highest scores among documents of `min_words` words.

Defined results: null and empty texts have no features, weight 0 and a score like any other; they are too short to be
drawn unless `min_words` is 0. A null doc_id draws like the empty id and ranks after the others of its score.
Equal scores rank by doc_id, then by the hash of the text; rows that repeat id and text are drawn one by one,
in any order among themselves. An empty document table gives no rows; an empty target set counts as T = 0. Very long
texts are translated whole but split into lists of words piece by piece. Columns to keep
lie in one struct, `doc`, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.words import pieces, stored

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
SHARE = 10
SEED = "2024"

# Bytes of a text whose words are held as a list at a time.
PIECE_BYTES = 1 << 20
# Distinct words that a task remembers before it folds their counts, or forgets their gains.
REMEMBERED = 1 << 19

_LETTER_OR_DIGIT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz")
# Byte to byte: A-Z to a-z, every other ASCII byte that is no letter or digit to a space, the rest to itself.
TRANSLATION = bytes(
    low if low >= 0x80 or low in _LETTER_OR_DIGIT else 0x20
    for low in (b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
)


def word_lists(text: bytes, limit: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lists from pieces of about `limit` bytes, cut between words."""
    spaced = text.translate(TRANSLATION)
    if len(spaced) <= limit:
        yield spaced.split()
        return
    start = 0
    while start < len(spaced):
        end = spaced.find(b" ", start + limit)
        end = len(spaced) if end < 0 else end
        yield spaced[start:end].split()
        start = end


def run_hashes(lists: Iterator[list[bytes]], max_n: int) -> Iterator[list[int]]:
    """CRC-32 of all runs of 2 to `max_n` words: each longer run goes on from the hash of the run without its last word."""
    carry: list[bytes] = []
    for words in lists:
        line = carry + words
        hashes = [crc32(w) for w in line]
        for n in range(2, max_n + 1):
            hashes = [crc32(w, crc32(b" ", h)) for h, w in zip(hashes, line[n - 1 :])]
            # Runs that end inside the carried words belong to the piece before.
            yield hashes[max(0, len(carry) - n + 1) :]
        carry = line[max(0, len(line) - max_n + 1) :]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in batches:
        for piece in pieces(batch):
            column = piece.column(piece.schema.get_field_index("text"))
            yield piece, column.cast(pa.large_binary()).to_pylist()


def _bucket_counter(max_n: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, dtype=np.int64)
        words: Counter[bytes] = Counter()
        runs: Counter[int] = Counter()

        def fold() -> None:
            for seen, hashes in ((words, map(crc32, words)), (runs, iter(runs))):
                if seen:
                    slots = np.fromiter((h % buckets for h in hashes), dtype=np.int64, count=len(seen))
                    np.add.at(totals, slots, np.fromiter(seen.values(), dtype=np.int64, count=len(seen)))
                    seen.clear()

        for _, texts in _texts(batches):
            for text in filter(None, texts):
                for part in word_lists(text):
                    words.update(part)
                if max_n > 1:
                    for part in run_hashes(word_lists(text), max_n):
                        runs.update(part)
                if len(words) + len(runs) > REMEMBERED:
                    fold()
        fold()
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends one number per bucket."""
    counted = texts.select("text").mapInArrow(_bucket_counter(max_n, buckets), "bucket long, n long")
    totals = np.zeros(buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # `buckets` rows at most
        totals[row["bucket"]] = row["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """What a feature of each bucket adds to a document's sum, in thousandths."""
    buckets = len(source)
    all_source, all_target = int(source.sum()), int(target.sum())
    return [
        math.floor(1000 * math.log(float(t + 1) * float(all_source + buckets) / (float(s + 1) * float(all_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ]


class _WordGains(dict):
    def __init__(self, table: list[int]):
        super().__init__()
        self.table = table

    def __missing__(self, word: bytes) -> int:
        gain = self[word] = self.table[crc32(word) % len(self.table)]
        return gain


def gumbel(doc_id: object, seed: str = SEED) -> int:
    """The random part of a document's score, in thousandths; the same in every run."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    drawn = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _weigher(table: list[int], max_n: int, seed: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordGains(table)
        for piece, texts in _texts(batches):
            ids = piece.column(piece.schema.get_field_index("doc_id")).to_pylist()
            rows = []
            for doc_id, text in zip(ids, texts):
                n_words = n_features = total = 0
                for part in word_lists(text or b""):
                    n_words += len(part)
                    total += sum(map(known.__getitem__, part))
                n_features = n_words
                if max_n > 1:
                    for part in run_hashes(word_lists(text or b""), max_n):
                        n_features += len(part)
                        total += sum(table[h % len(table)] for h in part)
                weight = total // n_features if n_features else 0
                rows.append((n_words, n_features, weight, weight + gumbel(doc_id, seed)))
                if len(known) > REMEMBERED:
                    known.clear()
            numbers = [pa.array(column, pa.int64()) for column in zip(*rows)]
            kept = [piece.column(piece.schema.get_field_index(c)) for c in ("doc", "doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *numbers], ["doc", "doc_id", "text_hash", "n_words", "n_features", "weight", "score"]
            )

    return weigh


def weigh_documents(
    docs: DataFrame, table: list[int], keep: Sequence[str] = ("doc_id",), max_n: int = MAX_N, seed: str = SEED
) -> DataFrame:
    """`doc` (the kept columns), `doc_id`, `text_hash`, `n_words`, `n_features`, `weight` and `score` of every row."""
    rows = docs.select(
        F.struct(*[f"`{c}`" for c in keep]).alias("doc"), "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    )
    names = {"n_words": "long", "n_features": "long", "weight": "long", "score": "long"}
    schema = rows.drop("text").schema
    for name, kind in names.items():
        schema = schema.add(name, kind)
    return rows.mapInArrow(_weigher(table, max_n, seed), schema)


def rank_drawn(scored: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """Add `rank`: 1, 2, 3... over the drawn rows by falling score, null for the others. Returns a stored table's rows.

    Scores are whole thousandths, so there are some 100,000 of them at most, whatever the table's size: their counts
    tell the lowest score drawn. Only rows from there on are sorted, by ranges that many tasks share; a row's rank is its
    place in its range and the rows of the ranges before.
    """
    spark = scored.sparkSession
    rows = stored(scored.withColumn("_seq", F.monotonically_increasing_id()), "importance-scores")
    long_enough = F.col("n_words") >= min_words
    counts = sorted(
        ((r["score"], r["count"]) for r in rows.filter(long_enough).groupBy("score").count().collect()), reverse=True
    )
    quota, taken, lowest = share * sum(n for _, n in counts) // 100, 0, None
    for score, n in counts:
        if taken >= quota:
            break
        taken, lowest = taken + n, score
    columns = [F.col(c) for c in rows.columns if c != "_seq"]
    if lowest is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    reached = long_enough & (F.col("score") >= lowest)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "text_hash", "_seq"]
    ranged = (
        rows.filter(reached)
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
        .select(
            *columns,
            F.spark_partition_id().alias("_range"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
        )
    )
    ranged = stored(ranged, "importance-ranges")
    before, shifts = 0, []
    for part, n in sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect()):
        shifts.append((part, before))
        before += n
    shift = spark.createDataFrame(shifts, "_range int, _before long")
    place = F.col("_before") + F.col("_place") + 1
    drawn = ranged.join(F.broadcast(shift), "_range").select(*columns, F.when(place <= quota, place).alias("rank"))
    return drawn.unionByName(rows.filter(~reached).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: int = SHARE,
    keep: Sequence[str] = ("doc_id",),
    max_n: int = MAX_N,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """Every row of `docs` with its weight, score and rank among the drawn `share` percent; `target` has `text`."""
    table = gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets))
    return rank_drawn(weigh_documents(docs, table, keep, max_n, seed), share, min_words)


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of `docs`, with its columns."""
    found = resample(docs, target, keep=docs.columns, **options)
    return found.filter(F.col("rank").isNotNull()).select("doc.*")
