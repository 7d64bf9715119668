"""Phrases whose words occur together more often than their parts tell, per language, by top-order marginalisation.

Only one order of word windows is counted: at every word the window of `order` words that starts there, padded with
empty words where its piece of text ends. The columns of a window are the word column led by 0 to `order` - 1 places.
A phrase of k words occurs where a window starts with it, so a ROLLUP over the columns sums the windows into the
counts of all their prefixes, the phrases of 1 to `order` words, without an explosion per length.

Before that, one pass adds up word totals and fills hashed slots with capped counts of words and of runs of two and
three words. Each run counts in PROBES slots; if any of them stays under `min_count`, the run is too rare to be a phrase or a
part of one, and so is any run around it; windows are padded from there on, which changes no count of `min_count` or more.
The number of slots follows the bytes of text up to MOST_SLOTS; a corpus beyond that fills them more, and then more windows
are counted, one per word at most, with the same results.

Each task hands on every frequent window once, so rows would grow with tasks times windows. Both passes therefore run in as
many tasks as there are cores, however many partitions the texts are read in.

Texts are lower-cased (A-Z only) and cut into pieces at ``. , ; : ! ?`` and the line breaks U+000A to U+000D; words of a
piece are parted by spaces and tabs. A candidate has 2 to `order` words and at least `min_count` occurrences, overlaps included. It is
dropped if a longer candidate holds its words in a row and occurs at least `covered` percent as often. Its score is the
lowest, over its cuts in two parts, of floor(1000 a n / (l r)); equal scores keep the first cut.

Defined results: null and empty texts have no words; a null language is called `und`, together with that name; repeated rows
count as often as they occur, and rows without an id like any other; equal scores rank by count, then phrase (by bytes); an
empty table gives no rows; extra columns are ignored. Texts are handled in blocks cut between pieces, so a very long text needs
memory for a block only; a single piece (no separator at all) is held whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveylake.llm.words import raw_bytes, stored

ORDER = 5
MIN_COUNT = 100
COVERED = 100
TOP = 2000
UNKNOWN = "und"

# Slots of each hashed table of capped counts, a power of two: one byte each, and one bit each in the tasks.
LEAST_SLOTS, MOST_SLOTS = 1 << 22, 1 << 26
# Bytes of text that one slot is meant for, and slots that each run is counted in.
SLOT_BYTES = 64
PROBES = 2
# Runs of so many words are checked against slots of their own.
CHECKED = 3
# Rows in which a table of slots travels.
SLOT_BLOCK = 1 << 16
# Windows of a task, as rows of words, that are held to be merged with those of its next blocks.
MERGE_ROWS = 1 << 20
# Bytes of text whose words are held at a time.
BLOCK_BYTES = 1 << 20

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = _BREAK
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PROBE_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Block:
    """The words of a block of text: code, piece and language of each, and the vocabulary behind the codes (bytes)."""

    codes: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    vocabulary: pa.Array


def _cuts(data: np.ndarray, offsets: np.ndarray, limit: int) -> list[int]:
    """Places to cut the bytes into blocks of about `limit`: where a text begins or after a break."""
    cuts = [0]
    while len(data) - cuts[-1] > limit:
        low = cuts[-1] + limit
        after = np.searchsorted(offsets, low)
        cut = int(offsets[after]) if after < len(offsets) else len(data)
        for start in range(low, cut, limit):
            breaks = np.flatnonzero(_KIND[data[start : min(start + limit, cut)]] == _BREAK)
            if len(breaks):
                cut = start + int(breaks[0]) + 1
                break
        if cut >= len(data):
            break
        cuts.append(cut)
    return [*cuts, len(data)]


def blocks(batch: pa.RecordBatch, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Words of the `text` column in blocks; `lang` holds row numbers of the batch's distinct languages."""
    data, offsets = raw_bytes(batch.column(batch.schema.get_field_index("text")))
    if not len(data):
        return
    lang_codes = batch.column(batch.schema.get_field_index("lang")).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cuts = _cuts(data, offsets, limit)
    for low, high in zip(cuts[:-1], cuts[1:]):
        part = np.frombuffer(data[low:high].tobytes().translate(_LOWER), dtype=np.uint8)
        kind = _KIND[part]
        solid = kind == _WORD
        begins = offsets[(offsets > low) & (offsets < high)] - low
        before = np.zeros(len(part), dtype=bool)
        before[1:] = solid[:-1]
        before[begins] = False
        starts = np.flatnonzero(solid & ~before)
        if not len(starts):
            continue
        text = np.searchsorted(offsets, starts + low, side="right") - 1
        ends = np.append(np.cumsum(solid)[starts] - 1, np.count_nonzero(solid)).astype(np.int64)
        flat = np.ascontiguousarray(part[solid])
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(flat)]
        ).dictionary_encode()
        # Breaks and texts passed: both only grow, so the sum names the piece.
        piece = np.cumsum(kind == _BREAK)[starts] + text
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        yield Block(codes, piece, lang_codes[text], words.dictionary)


def run_slots(block: Block, languages: list[str], slots: int) -> list[np.ndarray]:
    """Per length of run, 1 to CHECKED words, the PROBES slots of the run from each word on; -1 where the piece ends before."""
    shift = np.uint64(64 - (slots.bit_length() - 1))
    hashed = np.array([crc32(w) for w in block.vocabulary.to_pylist()], dtype=np.uint64)
    seeds = np.array([crc32(name.encode()) for name in languages], dtype=np.uint64) << np.uint64(32)
    state = (hashed[block.codes] ^ seeds[block.lang]) * _MIX
    out = []
    for n in range(1, CHECKED + 1):
        if n > 1:
            state = state[:-1] if len(state) else state
            state = ((state ^ (state >> np.uint64(29))) + hashed[block.codes[n - 1 :]]) * _MIX
        whole = np.full((PROBES, len(block.codes)), -1, dtype=np.int64)
        if n <= len(block.codes):
            inside = block.piece[n - 1 :] == block.piece[: len(block.piece) - n + 1]
            mixed = state
            for probe in whole:
                probe[: len(mixed)] = np.where(inside, (mixed >> shift).astype(np.int64), -1)
                mixed = (mixed ^ (mixed >> np.uint64(32))) * _PROBE_MIX
        out.append(whole)
    return out


def _languages(batch: pa.RecordBatch) -> list[str]:
    return batch.column(batch.schema.get_field_index("lang")).dictionary_encode().dictionary.to_pylist()


def _slot_counter(slots: int, cap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: word totals of each language, and the capped counts of all slots as rows of bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        counts = np.zeros((CHECKED, slots), dtype=np.uint8)
        for batch in batches:
            names = _languages(batch)
            for block in blocks(batch):
                for name, n in zip(names, np.bincount(block.lang, minlength=len(names)).tolist()):
                    totals[name] = totals.get(name, 0) + n
                for table, at in zip(counts, run_slots(block, names, slots)):
                    touched, n = np.unique(at[at >= 0], return_counts=True)
                    table[touched] = np.minimum(table[touched] + n, cap)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals)), pa.array(totals.values(), pa.int64()), *[pa.nulls(len(totals), pa.int32())] * 2,
             pa.nulls(len(totals), pa.binary())],
            ["lang", "n", "run", "place", "counts"],
        )
        size = min(SLOT_BLOCK, slots)
        for run in range(CHECKED):
            for place in range(0, slots, size):
                part = counts[run, place : place + size]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([run], pa.int32()),
                         pa.array([place // size], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                        ["lang", "n", "run", "place", "counts"],
                    )

    return count


def _merge_slots(cap: int):
    def merge(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds up rows of the same place; rows arrive sorted by place, one sum is held at a time."""
        key, total = None, None

        def frequent() -> pa.RecordBatch:
            bits = np.packbits(total >= cap).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([bits], pa.binary())],
                ["run", "place", "bits"],
            )

        for batch in groups:
            for run, place, counts in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if (run, place) != key:
                    if key is not None:
                        yield frequent()
                    key, total = (run, place), np.zeros(len(counts), dtype=np.uint16)
                total = np.minimum(total + np.frombuffer(counts, dtype=np.uint8), cap)
        if key is not None:
            yield frequent()

    return merge


@dataclass
class Frequent:
    """Words of each language, and per length of run one bit for every slot: may a run of it reach the minimum count?"""

    totals: dict[str, int]
    bits: np.ndarray
    slots: int

    def may(self, run: int, at: np.ndarray) -> np.ndarray:
        """`at` holds the slots of a run in each row, as `run_slots` gives them; -1 for none."""
        held = (self.bits[run][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        return ((at >= 0) & (held == 1)).all(axis=0)


def slots_for(texts: DataFrame) -> int:
    """A power of two, one slot for SLOT_BYTES of text, between LEAST_SLOTS and MOST_SLOTS."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("size")).first()["size"] or 0
    return min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (size // SLOT_BYTES).bit_length()))


def frequent_slots(texts: DataFrame, min_count: int, slots: int) -> Frequent:
    """One pass over the texts. The driver gets a number per language and `slots` bits per length of run."""
    cap = min(min_count, 255)
    found = stored(
        texts.mapInArrow(
            _slot_counter(slots, cap), "lang string, n long, run int, place int, counts binary"
        ),
        "phrase-slots",
    )
    totals = found.filter(F.col("lang").isNotNull()).groupBy("lang").agg(F.sum("n").alias("n"))
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = (
        found.filter(F.col("run").isNotNull())
        .select("run", "place", "counts")
        .repartition(tasks, "run", "place")
        .sortWithinPartitions("run", "place")
        .mapInArrow(_merge_slots(cap), "run int, place int, bits binary")
    )
    size = min(SLOT_BLOCK, slots) // 8
    bits = np.zeros((CHECKED, slots // 8), dtype=np.uint8)
    for row in merged.collect():  # `slots` bits per length of run
        bits[row["run"], row["place"] * size : (row["place"] + 1) * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return Frequent({r["lang"]: r["n"] for r in totals.collect()}, bits, slots)


def lead_windows(block: Block, order: int, may: list[np.ndarray]) -> np.ndarray:
    """The led word codes of each word that may be frequent, -1 as padding; `may[r][i]`: may the run of r + 1 words at i be?"""
    n = len(block.codes)
    columns = np.full((order, n), -1, dtype=np.int64)
    columns[0] = block.codes
    goes_on = may[0].copy()
    for k in range(1, min(order, n)):
        # The word k places on joins if every checked run that ends with it may be frequent.
        last = n - k
        goes_on = goes_on[:last]
        for run in range(min(CHECKED, k + 1)):
            goes_on = goes_on & may[run][k - run : n - run]
        columns[k, :last] = np.where(goes_on, block.codes[k:], -1)
    return columns[:, may[0]]


class WindowSums:
    """Windows of a task with their counts. Blocks are merged while that at least halves their rows, else handed on."""

    def __init__(self, keys: list[str], limit: int = MERGE_ROWS):
        self.keys, self.limit, self.held = keys, limit, []

    def add(self, windows: pa.Table) -> Iterator[pa.RecordBatch]:
        self.held.append(windows)
        if sum(t.num_rows for t in self.held) > self.limit:
            yield from self.hand_on(self.limit // 2)

    def hand_on(self, keep: int = 0) -> Iterator[pa.RecordBatch]:
        """The merged rows, unless they are few enough to be kept for the next blocks."""
        if not self.held:
            return
        merged = pa.concat_tables(self.held)
        if len(self.held) > 1:
            merged = merged.group_by(self.keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*self.keys, "n"])
        self.held = [merged] if merged.num_rows <= keep else []
        if not self.held:
            yield from merged.to_batches(max_chunksize=1 << 16)


def _window_counter(order: int, frequent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names_out = ["lang", *[f"w{k}" for k in range(1, order + 1)]]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = frequent.value, WindowSums(names_out)
        for batch in batches:
            names = _languages(batch)
            for block in blocks(batch):
                may = [known.may(run, at) for run, at in enumerate(run_slots(block, names, known.slots))]
                columns = lead_windows(block, order, may)
                keys = [f"c{k}" for k in range(order)]
                table = pa.table([pa.array(block.lang[may[0]]), *map(pa.array, columns)], names=["lang", *keys])
                summed = table.group_by(["lang", *keys], use_threads=False).aggregate([([], "count_all")])
                # Code -1 takes the last word, the empty one.
                vocabulary = pa.concat_arrays([block.vocabulary.cast(pa.binary()), pa.array([b""], pa.binary())]).cast(pa.string())
                last = len(vocabulary) - 1

                def words(name: str) -> pa.Array:
                    codes = summed[name].to_numpy()
                    return vocabulary.take(pa.array(np.where(codes < 0, last, codes)))

                langs = pa.array(names).take(pa.array(summed["lang"].to_numpy()))
                result = [langs, *[words(k) for k in keys], pa.array(summed["count_all"].to_numpy())]
                yield from sums.add(pa.table(result, names=[*names_out, "n"]))
        yield from sums.hand_on()

    return count


def phrase_counts(
    docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, slots: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """(lang, words, size, f) of every phrase of 1 to `order` words that occurs `min_count` times, and each language's words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    slots = slots or slots_for(texts)
    texts = texts.coalesce(spark.sparkContext.defaultParallelism)
    frequent = frequent_slots(texts, min_count, slots)
    columns = [f"w{k}" for k in range(1, order + 1)]
    schema = "lang string, " + ", ".join(f"{c} string" for c in columns) + ", n long"
    windows = texts.mapInArrow(_window_counter(order, spark.sparkContext.broadcast(frequent)), schema)
    # GROUPING_ID has a bit for each column summed over, so its ones tell how many words are left.
    summed = spark.sql(
        f"SELECT lang, {', '.join(columns)}, {order} - bit_count(grouping_id()) AS size, sum(n) AS f "
        f"FROM {{windows}} GROUP BY lang, w1, ROLLUP({', '.join(columns[1:])}) HAVING sum(n) >= {min_count}",
        windows=windows,
    )
    words = F.slice(F.array(*columns), 1, F.col("size").cast("int"))
    # A prefix that ends in padding repeats a shorter one.
    phrases = summed.select("lang", words.alias("words"), F.col("size").cast("int").alias("size"), "f").filter(
        F.element_at("words", -1) != ""
    )
    return stored(phrases, "phrase-counts"), frequent.totals


def _runs(words, at, size):
    return F.array_join(F.slice(words, at, size), " ")


def _runs_of(words, size):
    """All runs of `size` words inside a longer phrase; none of a phrase that isn't longer."""
    places = F.sequence(F.lit(1), F.size(words) - size + 1)
    return F.when(F.size(words) > size, F.transform(places, lambda at: _runs(words, at, size))).otherwise(F.array())


def collocations(
    docs: DataFrame,
    order: int = ORDER,
    min_count: int = MIN_COUNT,
    covered: int = COVERED,
    top: int | None = TOP,
    slots: int | None = None,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language, or all of them."""
    spark = docs.sparkSession
    counts, totals = phrase_counts(docs, order, min_count, slots)
    named = counts.select("lang", F.array_join("words", " ").alias("phrase"), "words", "size", "f")
    candidates = named.filter("size >= 2")
    # Every run of words inside a candidate, shorter than it, with the largest count of a candidate around it.
    inner = F.concat(*[_runs_of("words", size) for size in range(2, order)]) if order > 2 else F.array().cast("array<string>")
    around = candidates.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase")
    around = around.agg(F.max("f").alias("longer"))
    kept = candidates.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull()
        | (F.lit(100).cast("decimal(3,0)") * F.col("longer") < F.lit(covered).cast("decimal(3,0)") * F.col("f"))
    )
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = kept.select("lang", "phrase", "words", "size", F.col("f").alias("a"), cut.alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _runs("words", F.lit(1), F.col("k")).alias("first"),
        _runs("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    # All of these are read from files, so a word that starts very many candidates can be split by the join.
    cuts = stored(cuts, "phrase-cuts")
    whole = named.select("lang", "phrase", "f")
    sized = cuts.join(whole.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        whole.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]
    )
    languages = spark.createDataFrame(list(totals.items()), "lang string, n long")
    # 18 digits each: products of counts stay exact far beyond 64 bits.
    big = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    sized = sized.join(F.broadcast(languages), "lang").select(
        "lang", "phrase", "k", *[F.col(c) for c in big],
        F.call_function("div", (big["a"] * 1000).cast("decimal(20,0)") * big["n"], big["l"] * big["r"]).alias("score"),
    )
    best = sized.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b"))
    ranked = best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
    if top is None:
        return ranked
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return ranked.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
