"""Preparation of comments for scoring.

Only the parameters of this step are known, not its code; choices marked
[choice] are ours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..channels import SMS_WEB_CHANNELS
from ..functions.expressions import (
    clean_length_at_least,
    clean_text,
    has_pii,
    needs_translation,
    text_or_fallback,
)


def chosen_text(text: str, fallback: str | None = None) -> Column:
    """The text to score. [choice] A blank text counts as missing and takes the fallback."""
    return text_or_fallback(F.col(text), F.col(fallback)) if fallback else F.col(text)


def clean_prep(
    df: DataFrame,
    record_id: str,
    text: str,
    fallback: str | None = None,
    language: str | None = None,
    metadata: Sequence[str] = (),
) -> DataFrame:
    """Record id, cleaned text, personal-data flag and translation flag.

    Translation itself is an external service; rows that need it are only marked.
    """
    raw = chosen_text(text, fallback)
    spoken = F.col(language) if language else F.lit(None).cast("string")
    return df.select(
        F.col(record_id).alias("record_id"),
        clean_text(raw).alias("customer_text_clean"),
        has_pii(raw).alias("has_pii"),
        needs_translation(spoken).alias("needs_translation"),
        *metadata,
    )


def scorable(df: DataFrame, text: str, fallback: str | None = None) -> DataFrame:
    """Raw rows with any text left after cleaning, however short or long."""
    return df.filter(clean_length_at_least(chosen_text(text, fallback), 1))


def model_family(channel: Column) -> Column:
    """The model family of a channel: sms/web channels have models of their own."""
    return F.when(channel.isin(*SMS_WEB_CHANNELS), "sms_web").otherwise("default")
