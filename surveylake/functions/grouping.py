"""Survivor selection that holds when one group is a third of the data.

A plain ranking window would send every row of a group to one task. Here the
survivor is found with a limit Spark applies before the shuffle, and the other
rows are found by joining the table to one summary row per duplicated group,
which Spark can split when a group is hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_first(when: Column) -> Column:
    """Ascending rank that puts the latest time first; NULL and what is no time come last."""
    return F.coalesce(-F.unix_micros(when.try_cast("timestamp")), F.lit(2**63 - 1))


def keep_first(df: DataFrame, keys: Sequence[str], rank: Column, *ties: Column) -> DataFrame:
    """One row per key: the smallest ``rank``, then the smallest of ``ties``.

    The ``= 1`` filter on ``row_number`` is planned as a group limit on both
    sides of the exchange: a map task passes on at most one row per key.
    """
    window = W.partitionBy(*keys).orderBy(rank, *ties)
    ranked = df.withColumn("_position", F.row_number().over(window))
    return ranked.filter(F.col("_position") == 1).drop("_position")


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """NULL-safe equality of all keys between two aliased frames."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys],
    )


def not_first(df: DataFrame, keys: Sequence[str], rank: Column, carry: Sequence[str] = ()) -> DataFrame:
    """All rows ``keep_first`` drops, with the survivor's ``carry`` columns as ``_kept_<name>``.

    ``rank`` must be the one given to ``keep_first`` and cover every column of
    this frame that is not a key. The table is read and shuffled once, as
    distinct rows with the number of their copies; copies and hot groups combine
    map-side. One summary row per duplicated group, taken from the same shuffle,
    is joined to the distinct rows. All copies are written out again, but for
    one of the survivor.
    """
    columns = [f"`{c}`" for c in df.columns]
    distinct = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_rank", rank)
    survivor = F.min(F.struct(F.col("_rank").alias("rank"), *carry)).alias("_survivor")
    groups = distinct.groupBy(*keys).agg(survivor, F.sum("_copies").alias("_rows")).filter(F.col("_rows") > 1)

    def dropped(rows: DataFrame) -> DataFrame:
        joined = rows.alias("r").join(groups.alias("g"), same_keys("r", "g", keys))
        kept = (F.col("r._rank") == F.col("g._survivor.rank")).cast("bigint")
        return joined.select(
            *[F.col(f"r.{c}") for c in columns],
            *[F.col(f"g._survivor.`{c}`").alias(f"_kept_{c}") for c in carry],
            (F.col("r._copies") - kept).alias("_copies"),
        ).filter(F.col("_copies") > 0)

    once = dropped(distinct.filter(F.col("_copies") == 1)).drop("_copies")
    return once.unionByName(repeat_rows(dropped(distinct.filter(F.col("_copies") > 1)), "_copies"))


def repeat_rows(df: DataFrame, copies: str, chunk: int = 10_000) -> DataFrame:
    """Each row ``copies`` times, spread over tasks in chunks so no task writes one huge group."""
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"({copies} - 1) div {chunk}"))
    spread = (
        df.withColumn("_chunk", F.explode(chunks))
        .withColumn("_size", F.least(F.lit(chunk), F.col(copies) - F.col("_chunk") * chunk))
        .hint("rebalance")
    )
    return spread.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size").cast("bigint")))
    ).drop("_chunk", "_size", "_copy", copies)


def hash_order(record_id: Column, seed: int) -> Column:
    """A reproducible pseudo-random order of records."""
    return F.md5(F.concat(record_id.cast("string"), F.lit(str(seed))))
