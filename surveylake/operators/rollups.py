"""Score rollups and run checks over final responses."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORES = ("q1", "q2", "q3")


def _averages() -> list[Column]:
    return [F.avg(q).alias(f"{q}_avg_csat") for q in SCORES]


def daily_scores(df: DataFrame, as_of: date) -> DataFrame:
    """Average scores per channel and event date.

    One aggregation over every date and channel, combined map-side. A date
    without rows gives no row.
    """
    return (
        df.groupBy("channel", "event_date").agg(*_averages()).withColumn("processing_date", F.lit(as_of))
    )


def cumulative_scores(history: DataFrame, as_of: date, *by: str) -> DataFrame:
    """Row-weighted averages over the calendar year of ``as_of``, with the dates covered.

    Without ``by`` the result is one row, of NULLs if the year has no data. The
    year test reaches the scan as a partition filter.
    """
    return (
        history.filter(F.year("event_date") == as_of.year)
        .groupBy(*by)
        .agg(
            *_averages(),
            F.min("event_date").alias("event_start_date"),
            F.max("event_date").alias("event_end_date"),
        )
        .withColumn("calculated_date", F.lit(as_of))
    )


def monthly_yago(history: DataFrame, as_of: date, *by: str) -> DataFrame:
    """Monthly averages of this year and of the year before, up to the month of ``as_of``.

    The month of ``as_of`` is partial this year and whole last year. Months
    without rows are absent. Both years come from one scan and one aggregation.
    """
    year, month = F.year("event_date"), F.month("event_date")
    wanted = year.isin(as_of.year, as_of.year - 1) & (month <= as_of.month)
    label = F.when(year == as_of.year, "current").otherwise("yago")
    return (
        history.filter(wanted)
        .groupBy(*by, month.alias("month"), label.alias("year_label"))
        .agg(*_averages(), F.count(F.lit(1)).alias("record_count"))
        .withColumn("calculated_date", F.lit(as_of))
    )


def new_records_check(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Per channel and date: does the run bring more rows than are stored?

    Only counts are compared, so changed content of equal size is not new. The
    counts, one row per batch, are joined; a batch the run lacks is ``false``.
    """
    keys = ["channel", "event_date"]
    incoming = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("new_count"))
    stored = existing.groupBy(*keys).agg(F.count(F.lit(1)).alias("existing_count"))
    both = incoming.join(stored, keys, "full")
    return both.select(
        *keys,
        F.coalesce("new_count", F.lit(0)).alias("new_count"),
        F.coalesce("existing_count", F.lit(0)).alias("existing_count"),
        (F.coalesce("new_count", F.lit(0)) > F.coalesce("existing_count", F.lit(0))).alias("new_records_found"),
    )


def availability(df: DataFrame, channels: DataFrame) -> DataFrame:
    """Per channel of the list: did any date of the run leave rows?"""
    seen = df.groupBy("channel").agg(F.count(F.lit(1)).alias("final_rows"))
    return channels.join(seen, "channel", "left").select(
        "channel",
        F.coalesce("final_rows", F.lit(0)).alias("final_rows"),
        (F.coalesce("final_rows", F.lit(0)) > 0).alias("available"),
    )
