"""Campaign filter, input profile and the removed-records report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..channels import REMOVED_COLUMNS, Channel
from .normalize import comment_value

MAIN_CAMPAIGN = "Main"
CAMPAIGN_REASON = "CAMPAIGN_FILTER_NON_MAIN"
DEDUP_REASON = "DEDUP"


def is_main_campaign(df: DataFrame) -> Column:
    """True for the main campaign, never NULL; a frame without the column passes whole."""
    if "campaign" not in df.columns:
        return F.lit(True)
    return F.col("campaign").eqNullSafe(MAIN_CAMPAIGN)


def campaign_keep(df: DataFrame) -> DataFrame:
    return df.filter(is_main_campaign(df))


def campaign_removed(df: DataFrame) -> DataFrame:
    """Rows outside the main campaign.

    Rows without a campaign are reported too, so kept and removed rows add up to
    the input; a plain ``!=`` would lose them from both.
    """
    return df.filter(~is_main_campaign(df))


def input_profile(df: DataFrame, channel: Channel | None = None, *by: str) -> DataFrame:
    """Received, with verbatim, removed by campaign and passed on, in one aggregation."""
    comment = comment_value(df, channel) if channel else F.col("comment")
    main = is_main_campaign(df)
    if "channel" in df.columns:
        # Only the ivr channel is filtered.
        main = main | (F.col("channel") != "ivr")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("received"),
        F.count(comment).alias("with_verbatim"),
        F.count_if(~main).alias("campaign_removed"),
        F.count_if(main).alias("passed"),
    )


def removed_report(parts: list[tuple[DataFrame, Column]], survey_type: Column, removed_date: Column) -> DataFrame:
    """Stack removed rows of several steps, each with its reason, into one report."""

    def report(df: DataFrame, reason: Column) -> DataFrame:
        present = [F.col(c) for c in REMOVED_COLUMNS if c in df.columns]
        return df.select(
            *present,
            reason.alias("removal_reason"),
            survey_type.alias("survey_type"),
            removed_date.alias("removed_date"),
        )

    frames = [report(df, reason) for df, reason in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
