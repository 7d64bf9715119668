"""Mergeable states of final responses: one small row per channel and date, from which rollups and change checks follow.

A state holds what averages, ranges and counts are made of, and a digest of the rows. States of different dates
add up, in any order, to the state of a month or a year. So a run reads the responses of its own dates only, and
the rest of the history as states.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rollups import SCORES

STATE_MONTH = "state_month"
DIGESTS = ("digest_a", "digest_b")


def row_digests(columns: Sequence[str]) -> list[Column]:
    """Two order-free digests of a group's rows: sums of 64-bit hashes, which add up over parts.

    A sum counts repeated rows, unlike an exclusive or. Hashing skips NULLs, so which
    columns are NULL is hashed as well. Columns enter by name, not by position.
    """
    named = [F.col(f"`{c}`") for c in sorted(columns)]
    cells = [*named, *[c.isNull() for c in named]]
    return [
        F.sum(F.xxhash64(F.lit(salt), *cells).cast("decimal(20,0)")).cast("decimal(38,0)").alias(name)
        for salt, name in enumerate(DIGESTS)
    ]


def score_states(df: DataFrame, *by: str, digest: Sequence[str] = ()) -> DataFrame:
    """The state of every ``event_date`` (and ``by``): rows, and per score its sum, count, minimum and maximum.

    ``digest`` names the columns the digests cover; without any, only the scores and keys enter.
    """
    parts = [F.count(F.lit(1)).alias("rows")]
    for q in SCORES:
        parts += [F.sum(q).alias(f"{q}_sum"), F.count(q).alias(f"{q}_count")]
        parts += [F.min(q).alias(f"{q}_min"), F.max(q).alias(f"{q}_max")]
    covered = digest or [*by, "event_date", *SCORES]
    states = df.groupBy(*by, "event_date").agg(*parts, *row_digests(covered))
    return states.withColumn(STATE_MONTH, F.date_format("event_date", "yyyy-MM"))


def merged(states: DataFrame, *by: str | Column) -> DataFrame:
    """States added up per ``by``: again a state, with the dates covered."""
    parts = [F.sum("rows").alias("rows")]
    for q in SCORES:
        parts += [F.sum(f"{q}_sum").alias(f"{q}_sum"), F.sum(f"{q}_count").alias(f"{q}_count")]
        parts += [F.min(f"{q}_min").alias(f"{q}_min"), F.max(f"{q}_max").alias(f"{q}_max")]
    parts += [F.sum(name).cast("decimal(38,0)").alias(name) for name in DIGESTS]
    dates = [F.min("event_date").alias("event_start_date"), F.max("event_date").alias("event_end_date")]
    return states.groupBy(*by).agg(*parts, *dates)


def _averages() -> list[Column]:
    return [F.try_divide(f"{q}_sum", f"{q}_count").alias(f"{q}_avg_csat") for q in SCORES]


def daily_from_states(states: DataFrame, as_of: date) -> DataFrame:
    """As ``rollups.daily_scores``."""
    return states.select("channel", "event_date", *_averages(), F.lit(as_of).alias("processing_date"))


def _months(years: Sequence[int], last_month: int = 12) -> list[str]:
    """Names of the state partitions that hold these years: the filter prunes the scan."""
    return [f"{year:04d}-{month:02d}" for year in years for month in range(1, last_month + 1)]


def cumulative_from_states(states: DataFrame, as_of: date, *by: str) -> DataFrame:
    """As ``rollups.cumulative_scores``, from the states of the year."""
    year = states.filter(F.col(STATE_MONTH).isin(_months([as_of.year])))
    folded = merged(year, *by).select(*by, *_averages(), "event_start_date", "event_end_date")
    return folded.withColumn("calculated_date", F.lit(as_of))


def monthly_from_states(states: DataFrame, as_of: date, *by: str) -> DataFrame:
    """As ``rollups.monthly_yago``, from the states of two years."""
    wanted = states.filter(F.col(STATE_MONTH).isin(_months([as_of.year - 1, as_of.year], as_of.month)))
    label = F.when(F.year("event_date") == as_of.year, "current").otherwise("yago")
    folded = merged(wanted, *by, F.month("event_date").alias("month"), label.alias("year_label"))
    return folded.select(
        *by, "month", "year_label", *_averages(), F.col("rows").alias("record_count"), F.lit(as_of).alias("calculated_date")
    )


def content_check(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Per channel and date of either side: the counts, the count rule, and whether the rows themselves differ.

    ``new_records_found`` compares counts only, as before; ``content_changed`` also tells changed rows of
    equal number, in any order.
    """
    keys = ["channel", "event_date"]
    mine = new.select(*keys, F.col("rows").alias("new_count"), F.struct("rows", *DIGESTS).alias("_new"))
    theirs = stored.select(*keys, F.col("rows").alias("existing_count"), F.struct("rows", *DIGESTS).alias("_old"))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("new_count", "existing_count")]
    more = F.coalesce("new_count", F.lit(0)) > F.coalesce("existing_count", F.lit(0))
    return mine.join(theirs, keys, "full").select(
        *keys, *counts, more.alias("new_records_found"), (~F.col("_new").eqNullSafe(F.col("_old"))).alias("content_changed")
    )
