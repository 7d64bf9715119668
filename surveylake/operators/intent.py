"""Intent mapping through the lookup, its match rate, and a suffix audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import match_key

MatchKey = Callable[[Column], Column]


def clean_intent_map(lookup: DataFrame, key: MatchKey = match_key) -> DataFrame:
    """One row per cleaned old intent.

    Several rows for one key are settled by the smallest mapped value, so the
    choice does not depend on the order of the file. Rows without an old intent
    can never match and are left out.
    """
    return (
        lookup.filter(F.col("old_intent").isNotNull())
        .groupBy(key(F.col("old_intent")).alias("_intent_key"))
        .agg(F.min(F.lower(F.trim("new_intent"))).alias("_mapped_intent"))
    )


def _with_mapping(df: DataFrame, lookup: DataFrame, key: MatchKey) -> DataFrame:
    # No broadcast is forced: Spark broadcasts the lookup while its size is under
    # the session's threshold and shuffles, splitting hot intents, beyond it.
    keyed = df.withColumn("_intent_key", key(F.col("intent")))
    return keyed.join(clean_intent_map(lookup, key), "_intent_key", "left")


def map_intent(df: DataFrame, lookup: DataFrame, key: MatchKey = match_key) -> DataFrame:
    """Replace ``intent`` by its mapped value.

    Mapped values are lower case; unmapped intents stay as they were. Unlike the
    earlier jobs, the lookup's own columns do not leak into the result. ``key``
    is the rule both sides are matched by (``loose_match_key`` is the earlier one).
    """
    mapped = _with_mapping(df, lookup, key)
    return mapped.select(
        *[
            F.coalesce("_mapped_intent", "intent").alias("intent") if c == "intent" else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def intent_match_rate(df: DataFrame, lookup: DataFrame, *by: str) -> DataFrame:
    """Rows, matched, unmatched and percent matched (0 for no rows), optionally per group."""
    counted = (
        _with_mapping(df.select("intent", *by), lookup, match_key)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("total_count"), F.count("_mapped_intent").alias("matched_count"))
    )
    percent = F.when(F.col("total_count") > 0, F.col("matched_count") * 100.0 / F.col("total_count")).otherwise(0.0)
    return counted.withColumn(
        "unmatched_count", F.col("total_count") - F.col("matched_count")
    ).withColumn("match_rate", percent)


# Fixed value: the trailing text the owners report in intents of the sms/web channels.
THANK_YOU_SUFFIX = r"(?i)[-\s]*thank\s*you\s*$"


def intent_suffix_audit(df: DataFrame) -> DataFrame:
    """Per channel: responses, and those whose intent ends in a thank-you suffix."""
    return df.groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col("intent").rlike(THANK_YOU_SUFFIX)).alias("suffixed_count"),
    )


def strip_intent_suffix(df: DataFrame) -> DataFrame:
    """Optional cleanup; not part of the daily run, which leaves such intents unmapped."""
    stripped = F.regexp_replace("intent", THANK_YOU_SUFFIX, "")
    return df.withColumn("intent", F.coalesce(F.nullif(stripped, F.lit("")), F.col("intent")))
