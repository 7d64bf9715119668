"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; the ledger keeps the measurements and
one long whose bit i says that rule i failed. A policy is a named, versioned mask:
a document is kept where `bits & mask` is 0. The ledger is stored with the number of rules it knows;
changing a policy, or asking what a rule costs, reads it and never the texts again.

Defined results: a null or empty text has all measurements 0 and fails `few_words`
only; repeated rows are judged each for itself; an empty table gives an empty
ledger; very long texts are measured whole, each in a piece of its own; other columns are ignored, and a caller
joins or appends as needed; a policy with a rule that a stored ledger does not know is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.llm.words import Words, pieces, raw_bytes, split_words, sums_between, word_spans
from surveylake.sources.tables import partition_values

WINDOW = 8
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words")
LEDGER_FIELDS = (*MEASURES, "bits")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # a condition over the measurements


# The position of a rule is its bit: append rules, never reorder them.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("few_letter_words", "10 * n_letter_words < 8 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 16 * n_words"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[name] for name in names)


BASE = mask("few_words", "repeated_windows")
# Policy versions: the rules that count. A new version is added, an old one stays as it was.
POLICIES = {
    1: BASE,
    2: BASE | mask("symbols", "duplicate_lines", "few_letter_words", "short_words", "long_words"),
}
CURRENT = 2


def repeated_words(words: Words, window: int = WINDOW, seed: int = 7) -> np.ndarray:
    """Per text, the words that lie in a window found twice or more in that text, the first one included."""
    n, counts = len(words.codes), words.counts()
    if n < window:
        return np.zeros(len(counts), dtype=np.int64)
    values = np.random.default_rng(seed).integers(1, 1 << 63, size=len(words.vocabulary), dtype=np.uint64)[words.codes]
    hashes = np.zeros(n - window + 1, dtype=np.uint64)
    for i in range(window):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + values[i : n - window + 1 + i]
    owner = words.owners()
    hashes ^= owner[: len(hashes)].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    inside = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    if not len(inside):
        return np.zeros(len(counts), dtype=np.int64)
    order = np.argsort(hashes[inside], kind="stable")
    ranked = hashes[inside][order]
    same = ranked[1:] == ranked[:-1]
    found = inside[order[np.append(same, False) | np.append(False, same)]]
    covered = np.zeros(n + 1, dtype=np.int64)
    np.add.at(covered, found, 1)
    np.add.at(covered, found + window, -1)
    return sums_between(np.cumsum(covered[:-1]) > 0, words.bounds)


def line_counts(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    words = split_words(texts)
    data, offsets = raw_bytes(texts)
    solid, starts, _ = word_spans(data, offsets)
    lines = np.array([line_counts(text) for text in texts.to_pylist()], dtype=np.int64).reshape(-1, 2)
    # A word has a letter if one of its bytes is an ASCII letter or belongs to a character beyond ASCII.
    letters = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) | (data >= 0x80)
    with_letter = sums_between(letters & solid, np.append(starts, len(data))) > 0
    return {
        "n_words": words.counts(),
        "word_chars": sums_between(solid & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": sums_between(SYMBOLS[data], offsets),
        "n_lines": lines[:, 0],
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": repeated_words(words),
        "n_letter_words": sums_between(with_letter, words.bounds),
    }


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(BIT[rule.name])).otherwise(0).cast("long"))
    return bits


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, the measurements and `bits` of every document. `keep` may name any input columns but the ledger's own."""
    clash = set(keep) & set(LEDGER_FIELDS)
    carried = [c for c in keep if c not in clash]
    source = docs.select(*[F.col(f"`{c}`") for c in carried], F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text"):
                measured = measure(piece.column(len(carried)))
                columns = [*piece.columns[:-1], *(pa.array(measured[m], pa.int64()) for m in MEASURES)]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, *MEASURES])

    fields = [T.StructField(c, docs.schema[c].dataType) for c in carried]
    schema = T.StructType([*fields, *(T.StructField(m, T.LongType()) for m in MEASURES)])
    return source.mapInArrow(run, schema).withColumn("bits", failure_bits())


def write_ledger(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Store the ledger of these documents under the number of its rules and read it back."""
    ledger(docs, keep).write.parquet(f"{path.rstrip('/')}/rules={len(RULES)}")
    return read_ledger(docs.sparkSession, path)


def read_ledger(spark: SparkSession, path: str, policy: int = CURRENT) -> DataFrame:
    """The stored ledger that knows most rules, with that number as `rules`; the policy has to be among them."""
    known = max((int(n) for n in partition_values(spark, path, "rules")), default=0)
    if POLICIES[policy] >> known:
        raise ValueError(f"policy {policy} has rules that the ledger at {path} does not know; judge the texts again")
    return spark.read.parquet(f"{path.rstrip('/')}/rules={known}").withColumn("rules", F.lit(known))


def failed(bits: Column, rules: int) -> Column:
    return bits.bitwiseAND(F.lit(rules).cast("long")) != 0


def ablation(table: DataFrame, rules: int = POLICIES[CURRENT]) -> DataFrame:
    """Per rule of a policy: documents it rejects, those only it rejects, and what the policy keeps with and without it."""
    bits = F.col("bits").bitwiseAND(F.lit(rules).cast("long"))
    used = [rule for rule in RULES if BIT[rule.name] & rules]
    counts = [F.count_if(bits == 0).alias("kept")]
    for rule in used:
        bit = F.lit(BIT[rule.name]).cast("long")
        counts.append(F.count_if(bits.bitwiseAND(bit) != 0).alias(f"{rule.name}_rejects"))
        counts.append(F.count_if(bits == bit).alias(f"{rule.name}_alone"))
    row = table.agg(*counts)
    entries = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.col(f"{rule.name}_rejects").alias("rejected"),
                F.col(f"{rule.name}_alone").alias("rejected_alone"),
                F.col("kept").alias("kept_with"),
                (F.col("kept") + F.col(f"{rule.name}_alone")).alias("kept_without"),
            )
            for rule in used
        ]
    )
    return row.select(F.explode(entries).alias("e")).select("e.*")


def keep_documents(docs: DataFrame, rules: int = POLICIES[CURRENT]) -> DataFrame:
    """The documents that a policy keeps, with their own columns.

    The judgement travels with the row, so no join is needed: all input columns pass through under names of position.
    """
    names = docs.columns
    renamed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("text")
    )
    judged = ledger(renamed, keep=("_row",)).filter(~failed(F.col("bits"), rules))
    return judged.select(*[F.col("_row").getField(c).alias(c) for c in names])
