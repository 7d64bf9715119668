"""SimHash fingerprints and their self-join by traversing pairs of binary trie nodes.

Two fingerprints that differ in at most `budget` bits agree in all but `budget` of
any blocks the bits are cut into. For every choice of agreeing blocks the bits are
reordered to put these first; all fingerprints under one such prefix form a binary trie.
A trie is the sorted array itself: a node is a range that shares a prefix.
The join starts with a trie paired with itself and descends both nodes of a pair bit by
bit, adds up the differing bits, and drops a pair when the sum passes the budget.

Groups of near copies would still visit all their pairs. So neighbours in the sorted
order of each trie are linked first, whose components label the fingerprints; node
pairs that lie in one component are dropped, and whole tries of one component never
reach a task. Tries too large for a task are cut into pairs of subtries by their next bits.

Defined results: null and empty texts have the fingerprint 0 and are linked like others;
equal rows share a component; rows with the same id are rows of their own, joined
only by their fingerprints; a null id never names a component unless it has
no other id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveylake.llm.components import components
from surveylake.llm.words import pieces, stored

BITS = 64
SHINGLE = 4
SEED = 42
BUDGET = 4
BLOCKS = 6
# Fingerprints of one trie handled in one task, and rows of a group of tries.
TRIE_ROWS = 50_000
GROUP_ROWS = 200_000
SPLIT_BITS = 4


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits; bit i is set where more than half of the shingles' hashes have it. Only A-Z are lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(word) + 1 for word in words], out=starts[1:])
    n = max(1, len(words) - width + 1)
    begins = starts[:n].tolist()
    ends = (starts[min(width, len(words)) :][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(begins, ends)], dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for low in range(0, n, 1 << 14):
        part = hashes[low : low + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """`doc_id`, `text_hash` and `fp`, the fingerprint as a signed long, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                values = np.array([fingerprint(t, width) for t in piece.column(2).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(values.view(np.int64))], names=["doc_id", "text_hash", "fp"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return narrow.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def block_sizes(blocks: int) -> list[int]:
    return [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]


def _reordered(fp: Column, first: tuple[int, ...], sizes: list[int]) -> Column:
    """The bits of the chosen blocks in front, then the others."""
    starts = [BITS - sum(sizes[: i + 1]) for i in range(len(sizes))]
    result, left = F.lit(0).cast("long"), BITS
    for i in (*first, *(i for i in range(len(sizes)) if i not in first)):
        left -= sizes[i]
        piece = F.shiftrightunsigned(fp, starts[i]).bitwiseAND(F.lit((1 << sizes[i]) - 1).cast("long"))
        result = result.bitwiseOR(F.shiftleft(piece, left))
    return result


def trie_rows(labelled: DataFrame, blocks: int = BLOCKS, budget: int = BUDGET) -> DataFrame:
    """A row per fingerprint and trie order: `trie` and its prefix `key`, `depth` (bits of the key), `bits` reordered."""
    sizes = block_sizes(blocks)
    orders = []
    for number, chosen in enumerate(itertools.combinations(range(blocks), blocks - budget)):
        depth = sum(sizes[i] for i in chosen)
        bits = _reordered(F.col("fp"), chosen, sizes)
        orders.append(
            F.struct(
                F.lit(number).alias("trie"),
                F.lit(depth).alias("depth"),
                F.shiftrightunsigned(bits, BITS - depth).alias("key"),
                bits.alias("bits"),
            )
        )
    return labelled.select("*", F.explode(F.array(*orders)).alias("o")).select(*labelled.columns, "o.*")


def neighbour_links(tries: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links between neighbours in the sorted order of each trie; some links only, at most one a row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for frame in frames:
            if last is not None:
                frame = pd.concat([last, frame], ignore_index=True)
            last = frame.iloc[-1:]
            bits = frame["bits"].to_numpy().view(np.uint64)
            near = np.bitwise_count(bits[1:] ^ bits[:-1]) <= budget
            near &= frame["trie"].to_numpy()[1:] == frame["trie"].to_numpy()[:-1]
            fp = frame["fp"].to_numpy()
            yield pd.DataFrame({"u": fp[1:][near], "v": fp[:-1][near]})

    parts = int(tries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = tries.select("trie", "bits", "fp").repartitionByRange(parts, "trie", "bits")
    return ordered.sortWithinPartitions("trie", "bits").mapInPandas(run, "u long, v long")


def _open_units(units: DataFrame) -> DataFrame:
    """Units (pairs of nodes) that can still hold a link between two components, with their number of rows."""
    return (
        units.groupBy("unit")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.count("*").alias("n"),
            F.min("side").alias("first_side"),
            F.max("side").alias("last_side"),
            F.max("cross").alias("is_cross"),
        )
        .filter("low <> high and (not is_cross or first_side <> last_side)")
        .select("unit", "n")
    )


def _split_units(units: DataFrame, budget: int, step: int = SPLIT_BITS) -> DataFrame:
    """Each pair of nodes as the pairs of their children `step` bits below that the budget still allows."""
    child = F.expr(f"shiftrightunsigned(shiftleft(bits, depth), {BITS - step})")
    other = F.explode(F.sequence(F.lit(0), F.lit((1 << step) - 1))).alias("other")
    paired = units.select("*", child.alias("child"), other).withColumn("other", F.col("other").cast("long"))
    differing = F.col("differing") + F.bit_count(F.col("child").bitwiseXOR(F.col("other"))).cast("int")
    # In a pair of different nodes the children keep the order of their sides; in a node paired with itself, that of their bits.
    ahead = F.when(F.col("cross"), F.col("side") == 0).otherwise(F.col("child") <= F.col("other"))
    first = F.when(ahead, F.col("child")).otherwise(F.col("other"))
    second = F.when(ahead, F.col("other")).otherwise(F.col("child"))
    return (
        paired.withColumns({"differing": differing, "_a": first, "_b": second, "_ahead": ahead})
        .filter(F.col("differing") <= budget)
        .select(
            F.xxhash64("unit", "_a", "_b").alias("unit"),
            "fp",
            "label",
            "bits",
            (F.col("depth") + step).alias("depth"),
            "differing",
            (F.col("cross") | (F.col("_a") != F.col("_b"))).alias("cross"),
            F.when(F.col("_ahead"), 0).otherwise(1).alias("side"),
        )
    )


def traverse(
    bits: np.ndarray, label: np.ndarray, pairs: np.ndarray, depth: np.ndarray, budget: int = BUDGET
) -> np.ndarray:
    """Links (i, j) between rows of different labels under the start pairs of nodes.

    `bits` is sorted within each node. A pair is (low, high, low, high, differing):
    two ranges of rows, the same one twice for a node paired with itself, and the bits in which they differ so far.
    """
    changes = np.concatenate([[0, 0], np.cumsum(label[1:] != label[:-1])])  # changes[i + 1]: label changes up to row i

    def useful(p: np.ndarray) -> np.ndarray:
        a, b, c, d, differing = p.T
        p = p[(b > a) & (d > c) & (differing <= budget) & ((a != c) | (b - a > 1))]
        a, b, c, d, _ = p.T
        one = (changes[b] == changes[a + 1]) & (changes[d] == changes[c + 1]) & (label[a] == label[c])
        return p[~one]

    found, active = [], np.zeros((0, 5), dtype=np.int64)
    for level in range(int(depth.min(initial=BITS)), BITS):
        active = useful(np.concatenate([active, pairs[depth == level]]))
        leaves = (active[:, 1] - active[:, 0] == 1) & (active[:, 3] - active[:, 2] == 1)
        ends = active[leaves]
        near = np.bitwise_count(bits[ends[:, 0]] ^ bits[ends[:, 2]]) <= budget
        found.append(ends[near][:, [0, 2]])
        active = active[~leaves]
        if not len(active):
            continue
        ones = np.concatenate([[0], np.cumsum((bits >> np.uint64(BITS - 1 - level)) & np.uint64(1))]).astype(np.int64)
        a, b, c, d, differing = active.T
        m, n = b - (ones[b] - ones[a]), d - (ones[d] - ones[c])
        selves = (a == c) & (b == d)
        active = np.concatenate(
            [
                np.stack([a, m, c, n, differing], axis=1),
                np.stack([m, b, n, d, differing], axis=1),
                np.stack([a, m, n, d, differing + 1], axis=1),
                np.stack([m, b, c, n, differing + 1], axis=1)[~selves],
            ]
        )
    ends = useful(active)
    found.append(ends[:, [0, 2]])
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def _links_of_group(frame: pd.DataFrame, budget: int) -> pd.DataFrame:
    """Links between labels under all units of a group."""
    frame = frame.assign(order=frame["bits"].to_numpy().view(np.uint64)).sort_values(["unit", "side", "order"])
    unit, side = frame["unit"].to_numpy(), frame["side"].to_numpy()
    edge = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]) | (side[1:] != side[:-1])])
    low, high = edge, np.r_[edge[1:], len(frame)]
    cross = frame["cross"].to_numpy()[low]
    # A pair of two nodes has its two sides one after the other; a side alone meets nothing.
    nxt = np.minimum(np.arange(len(low)) + 1, len(low) - 1)
    whole = cross & (side[low] == 0) & (unit[low[nxt]] == unit[low]) & (side[low[nxt]] == 1)
    second = np.where(cross, nxt, np.arange(len(low)))
    differing = frame["differing"].to_numpy()[low].astype(np.int64)
    pairs = np.stack([low, high, low[second], high[second], differing], axis=1)[~cross | whole]
    depth = frame["depth"].to_numpy()[low][~cross | whole]
    label = frame["label"].to_numpy()
    links = traverse(frame["order"].to_numpy(), label, pairs, depth, budget)
    return pd.DataFrame({"u": label[links[:, 0]], "v": label[links[:, 1]]}).drop_duplicates()


def trie_links(labelled: DataFrame, blocks: int, budget: int, trie_rows_limit: int, group_rows: int) -> DataFrame:
    """Links (u, v) between labels whose fingerprints differ in at most `budget` bits, by the trie join."""
    units = trie_rows(labelled, blocks, budget).select(
        F.xxhash64("trie", "key").alias("unit"),
        "fp",
        "label",
        "bits",
        "depth",
        F.lit(0).alias("differing"),
        F.lit(False).alias("cross"),
        F.lit(0).alias("side"),
    )
    # A node with fewer bits left than a split takes holds fewer rows than this, so no split runs past the last bit.
    trie_rows_limit = max(trie_rows_limit, 2 << SPLIT_BITS)
    parts = []
    while True:
        opened = stored(units.join(_open_units(units), "unit"), "simhash-units")
        parts.append(opened.filter(F.col("n") <= trie_rows_limit))
        large = opened.filter(F.col("n") > trie_rows_limit)
        if large.isEmpty():
            break
        units = stored(_split_units(large, budget), "simhash-split")
    ready = functools.reduce(DataFrame.unionByName, parts)
    groups = 1 + ready.count() // group_rows
    return (
        ready.withColumn("group", F.pmod("unit", F.lit(groups)))
        .groupBy("group")
        .applyInPandas(lambda frame: _links_of_group(frame, budget), "u long, v long")
        .distinct()
    )


def near_components(
    fps: DataFrame, blocks: int = BLOCKS, budget: int = BUDGET, trie_rows_limit: int = TRIE_ROWS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """`fp` and `root` for every distinct fingerprint; fingerprints that reach each other by links share their root."""
    distinct = stored(fps.select("fp").distinct(), "simhash-distinct")
    early = components(neighbour_links(trie_rows(distinct, blocks, budget), budget), "simhash-early")
    # Rows of 16 bytes each become one per trie next; by size alone they would be written by a few tasks.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labelled = stored(
        distinct.join(early.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("label"))
        .repartition(tasks, "fp"),
        "simhash-labels",
    )
    links = trie_links(labelled, blocks, budget, trie_rows_limit, group_rows)
    late = components(links, "simhash-late").withColumnRenamed("node", "label")
    return labelled.join(late, "label", "left").select("fp", F.coalesce("root", "label").alias("root"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, **limits) -> DataFrame:
    """Every row's `doc_id`, `text_hash`, `fp`, `component_id` (smallest doc_id reachable) and whether it is `first` there."""
    fps = stored(fingerprints(docs, width), "simhash-fingerprints")
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_hash"))
    firsts = fps.groupBy("fp").agg(F.min(name).alias("name"))
    rooted = stored(firsts.join(near_components(firsts, **limits), "fp"), "simhash-roots")
    # Stored, so that the join below reads both sides from files and a root of very many fingerprints can be split.
    named = stored(rooted.groupBy("root").agg(F.min("name").alias("first_name")), "simhash-names")
    lookup = rooted.join(named, "root").select("fp", "first_name")
    return fps.join(lookup, "fp").select(
        "doc_id",
        "text_hash",
        "fp",
        F.col("first_name.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first_name.doc_id")) & (F.col("text_hash") == F.col("first_name.text_hash"))).alias("first"),
    )


def keep_first(docs: DataFrame, **limits) -> DataFrame:
    """One document of each component, with the columns of the input: the smallest id, then the smallest text hash."""
    return first_rows(docs, near_duplicates(docs, **limits))


def first_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `docs` that `found` (`doc_id`, `text_hash`, `first`) calls first.

    Of repeated rows of one id and text, one stays (the smallest hash of the whole row).
    """
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("doc_id").isNull().alias("_no_id")]
    duplicates = found.filter(~F.col("first"))
    removed = duplicates.select(*key, F.col("text_hash").alias("_text")).distinct()
    names = [f"`{c}`" for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("_row"), *key, F.xxhash64("text").alias("_text"))
    same = W.partitionBy("_id", "_no_id", "_text").orderBy(F.xxhash64(F.to_json("_row")))
    single = rows.withColumn("_rank", F.row_number().over(same)).filter("_rank = 1")
    return single.join(removed, ["_id", "_no_id", "_text"], "left_anti").select("_row.*")
