"""A corpus pipeline of five stages over `documents`; each stage's rows are written and read again as the next one's input.

Every stage handles null and empty texts, repeated rows, empty tables and extra columns as its operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm import decontamination, mixing, quality, sharding, simhash
from surveylake.llm.queries import SHARDS, bounded_batches, table
from surveylake.llm.words import stored
from surveylake.session import apply_run_conf, scratch_path

# The stages' operators draw seeds and hashes that SQL engines don't share, so no SQL gives run()'s rows.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of quality rules keeps."""
    return quality.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles differ in at most four bits, link by link."""
    return simhash.keep_first(docs, width=simhash.SHINGLE, budget=simhash.BUDGET)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    index = stored(decontamination.item_index(table(spark, sf_dir, "benchmark")), "benchmark-index")
    return decontamination.clean_documents(docs, index)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs, F.array("source"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their size, virtual slot, shard and the version of the slot map."""
    return sharding.shard_documents(docs, scratch_path(spark, "slot-map"), SHARDS)[0]


def _stage(function):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(bounded_batches(apply_run_conf(spark)), docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", _stage(quality_rules)),
    ("near-dedup", _stage(near_dedup)),
    ("decontamination", _stage(decontaminate)),
    ("mixing", _stage(mix_sources)),
    ("sharding", _stage(shard)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
