"""Benchmark decontamination: containment search for short test items inside long documents.

Texts become sets of five-word shingles: runs of letters and digits, lower case,
joined by a space; a text of fewer words has its whole sequence as its only
shingle, a text without words has none. An item is found in a document
that holds at least `threshold` of the item's distinct shingles.

The index is made of the items, partitioned by size (number of distinct shingles,
in powers of two). A partition keeps of every item its `k` smallest shingle
hashes (its bottom-k sketch), where `k` is one more than the shingles an item of the partition's
largest size may miss. An item of `n` shingles may miss `n - ceil(threshold * n)`, so a document that
holds enough of it shares at least `need`, the rest of its sketch, which is one or more: the search loses nothing.

Two steps. The search joins the hashes of all documents' shingles with the sketches alone; a document that
reaches an item's `need` is a candidate for it. Only candidate documents are then cut again and their
candidate items verified by all shingles, compared word by word.

Defined results: null and empty texts match nothing and are found nowhere; repeated item rows
count once per item id and text; documents with the same id are judged row by row, and one match of
(doc_id, item_id) is reported, the fullest; empty tables give no rows; other columns of the inputs are ignored.
Texts are cut whole, however long: a task holds one text's words, and its shingles leave the task as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .words import stored

SHINGLE = 5
THRESHOLD = 0.8
# The search broadcasts up to so many sketch rows; they are of fixed size (two longs, two ints), 32 MB at most.
BROADCAST_SKETCHES = 500_000
# The verification broadcasts the items' shingles up to so many bytes of words; beyond either bound the join shuffles.
BROADCAST_BYTES = 32 << 20


def shingle_rows(rows: DataFrame, width: int = SHINGLE) -> DataFrame:
    """A row for each shingle of `text`, repeats included: the other columns and the words `s1` to `s<width>`.

    A shorter sequence is filled up with empty strings. Five word columns need no joined string per shingle.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    filled = F.concat("_words", F.array_repeat(F.lit(""), F.greatest(F.lit(width) - F.size("_words"), F.lit(0))))
    n = F.size("_filled") - (width - 1)
    cut = rows.withColumn("_words", words).withColumn("_filled", filled)
    names = shingle_columns(width)
    zipped = F.arrays_zip(*[F.slice("_filled", F.lit(i + 1), n).alias(name) for i, name in enumerate(names)])
    others = [c for c in rows.columns if c != "text"]
    # Texts without words are told by their first column, after the fact: a filter on the words would cut every text twice.
    exploded = cut.select(*others, F.explode(zipped).alias("_s"))
    return exploded.select(*others, *[F.col(f"_s.{c}") for c in names]).filter("s1 <> ''")


def shingle_columns(width: int = SHINGLE) -> list[str]:
    return [f"s{i + 1}" for i in range(width)]


def item_index(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per item text and distinct shingle: `item_id`, `item_text`, `item_shingles`, `size_class`, `rank`, `sketch`, `need`, `s1`...

    `rank` orders the shingles of an item by hash, from 1; `sketch` marks those of its bottom-k sketch, of which
    a document has to share `need`.
    """
    names = shingle_columns()
    kept = items.select("item_id", F.xxhash64("text").alias("item_text"), "text").distinct()
    item = W.partitionBy("item_id", "item_text")
    ranked = shingle_rows(kept).distinct().withColumns(
        {
            "rank": F.row_number().over(item.orderBy(F.xxhash64(*names), *names)),
            "item_shingles": F.count("*").over(item),
        }
    )
    size_class = F.ceil(F.log2("item_shingles")).cast("int")
    largest = F.pow(F.lit(2.0), F.col("size_class"))
    k = (_may_miss(largest, threshold) + 1).cast("int")
    need = (F.least(F.col("_k"), F.col("item_shingles")) - _may_miss(F.col("item_shingles"), threshold)).cast("int")
    return (
        ranked.withColumn("size_class", size_class)
        .withColumn("_k", k)
        .withColumns({"sketch": F.col("rank") <= F.col("_k"), "need": need})
        .drop("_k")
    )


def _may_miss(size: Column, threshold: float) -> Column:
    return size - F.ceil(size * threshold - 1e-9)


def candidates(docs: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs of a document row (`doc_id`, hash `doc_text` of its text) and an `item` (hash of id and text) that share enough of the sketch.

    Items whose hashes are equal count as one here, which can only add a pair to verify.
    """
    names = shingle_columns()
    hashed = F.xxhash64(*names).alias("_hash")
    sketches = index.filter("sketch").select(hashed, _item(), F.col("rank").cast("int"), "need")
    if index.filter("sketch").count() <= BROADCAST_SKETCHES:
        sketches = F.broadcast(sketches)
    return (
        shingle_rows(docs.select("doc_id", F.xxhash64("text").alias("doc_text"), "text"))
        .select("doc_id", "doc_text", hashed)
        .join(sketches, "_hash")
        .groupBy("doc_id", "doc_text", "item")
        .agg(F.count_distinct("rank").alias("_shared"), F.min("need").alias("_need"))
        .filter("_shared >= _need")
        .select("doc_id", "doc_text", "item")
    )


def _item() -> Column:
    return F.xxhash64("item_id", "item_text").alias("item")


def _pairs(docs: DataFrame, index: DataFrame, threshold: float) -> DataFrame:
    """Verified pairs of a document row (its id and the hash of its text) and an item's text."""
    found = stored(candidates(docs, index), "benchmark-candidates")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("doc_text"), "text").alias("d")
    ids = found.select("doc_id", "doc_text").distinct().alias("f")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.doc_text") == F.col("f.doc_text"))
    rows = shingle_rows(keyed.join(ids, same, "left_semi"))
    members = index.withColumn("item", _item()).join(found.select("item").distinct(), "item", "left_semi")
    words = sum((F.octet_length(c) for c in shingle_columns()), F.lit(0))
    if (index.agg(F.sum(words)).first()[0] or 0) <= BROADCAST_BYTES:
        members = F.broadcast(members)
    verified = (
        rows.join(members, shingle_columns())
        .groupBy("doc_id", "doc_text", "item_id", "item_text", "item")
        .agg(F.max("item_shingles").alias("item_shingles"), F.count_distinct("rank").alias("matched"))
        .withColumn("containment", F.col("matched") / F.col("item_shingles"))
        .filter(F.col("containment") >= threshold)
        .alias("v")
    )
    pair = (
        F.col("v.doc_id").eqNullSafe(F.col("c.doc_id"))
        & (F.col("v.doc_text") == F.col("c.doc_text"))
        & (F.col("v.item") == F.col("c.item"))
    )
    return verified.join(found.alias("c"), pair, "left_semi").drop("item")


def find_items(docs: DataFrame, index: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (doc_id, item_id) with `item_shingles`, `matched` and `containment`; `index` is a stored `item_index`."""
    pairs = _pairs(docs, index, threshold)
    best = F.max(F.struct("containment", "matched", "item_shingles")).alias("best")
    return pairs.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        F.col("best.item_shingles").alias("item_shingles"),
        F.col("best.matched").alias("matched"),
        F.col("best.containment").alias("containment"),
    )


def clean_documents(docs: DataFrame, index: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents, with the columns of the input, in which no item is found; a found id and text goes with all its rows."""
    names = [f"`{c}`" for c in docs.columns]
    rows = docs.select(
        F.struct(*names).alias("_row"), "text", "doc_id", F.xxhash64("text").alias("_text"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("doc_id").isNull().alias("_no_id"),
    )
    found = _pairs(docs.select("doc_id", "text"), index, threshold).select(
        F.col("doc_text").alias("_text"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.col("doc_id").isNull().alias("_no_id"),
    )
    return rows.join(found.distinct(), ["_text", "_id", "_no_id"], "left_anti").select("_row.*")
