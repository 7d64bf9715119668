"""Score normalization and the channel-independent view of a response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..channels import Channel, Score
from ..functions.expressions import first_present, leading_number, score

# Columns every channel shares, in the common view.
COMMON_COLUMNS = (
    "event_date",
    "contact_record_id",
    "cas_account_number",
    "customer_account_number",
    "response_received_date",
    "event_ts",
    "queue_time",
    "survey_id",
    "survey_name",
    "case_type",
    "intent",
    "campaign",
)


def _score_value(spec: Score) -> Column:
    raw = F.col(spec.source)
    return leading_number(raw) if spec.leading_number else score(raw)


def normalize(df: DataFrame, channel: Channel) -> DataFrame:
    """Add the channel's double scores and its question-text columns.

    Where a normalized column has the name of its raw column it replaces it, as
    in the api channels. Texts that are not numbers become NULL scores.
    """
    added = {s.target: _score_value(s) for s in channel.scores}
    added |= {q: _score_value(s) for q, s in zip(channel.score_questions, channel.scores)}
    added |= {q: F.col(raw) for q, raw in channel.text_questions}
    return df.withColumns(added)


def comment_value(df: DataFrame, channel: Channel) -> Column:
    """The response's comment, survey language first."""
    return first_present(df, channel.comment_columns)


def common_view(df: DataFrame, channel: Channel) -> DataFrame:
    """A normalized channel reduced to what de-duplication and rollups read.

    Only these columns reach the scan, and frames of all channels can be
    stacked and processed in one plan. Columns a channel lacks become NULL.
    """
    columns = [F.lit(channel.name).alias("channel")]
    columns += [
        F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in COMMON_COLUMNS
    ]
    columns.append(comment_value(df, channel).alias("comment"))
    columns += [F.col(c).alias(f"q{i}") for i, c in enumerate(channel.score_columns, start=1)]
    return df.select(*columns)
