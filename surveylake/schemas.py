"""Declared input schemas; reads use these instead of inferring."""

from __future__ import annotations

from pyspark.sql import types as T

from .channels import Channel

_IDENTITY = T.StructType(
    [
        T.StructField("contact_record_id", T.StringType()),
        T.StructField("cas_account_number", T.StringType()),
        T.StructField("customer_account_number", T.StringType()),
        T.StructField("response_received_date", T.TimestampType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("queue_time", T.TimestampType()),
        T.StructField("survey_id", T.StringType()),
        T.StructField("survey_name", T.StringType()),
        T.StructField("case_type", T.StringType()),
        T.StructField("intent", T.StringType()),
    ]
)


def curated_schema(channel: Channel) -> T.StructType:
    """Curated responses of one channel; raw scores arrive as text."""
    names = [s.source for s in channel.scores]
    names += [raw for _, raw in channel.text_questions]
    names += list(channel.comment_columns)
    if channel.campaign_filter:
        names.append("campaign")
    schema = T.StructType(list(_IDENTITY.fields))
    for name in dict.fromkeys(names):
        schema = schema.add(name, T.StringType())
    return schema.add("event_date", T.DateType())


INTENT_MAP = T.StructType(
    [T.StructField("old_intent", T.StringType()), T.StructField("new_intent", T.StringType())]
)

TRACKER = T.StructType(
    [T.StructField("execution_date", T.DateType())]
    + [
        T.StructField(f"{prefix}_available", T.BooleanType())
        for prefix in (
            "ivr",
            "sms_web_transactional",
            "sms_web_relational",
            "api_web_transactional",
            "api_web_relational",
        )
    ]
    + [
        T.StructField("dates_processed", T.ArrayType(T.DateType())),
        T.StructField(
            "source_new_records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("event_date", T.DateType()),
                        T.StructField("channel", T.StringType()),
                        T.StructField("new_records_found", T.BooleanType()),
                    ]
                )
            ),
        ),
    ]
)

# One row per date; the month is the partition.
SCORE_STATES = T.StructType(
    [T.StructField("channel", T.StringType()), T.StructField("event_date", T.DateType()), T.StructField("rows", T.LongType())]
    + [
        T.StructField(f"{q}_{part}", kind)
        for q in ("q1", "q2", "q3")
        for part, kind in (
            ("sum", T.DoubleType()), ("count", T.LongType()), ("min", T.DoubleType()), ("max", T.DoubleType()),
        )
    ]
    + [T.StructField(name, T.DecimalType(38, 0)) for name in ("digest_a", "digest_b")]
    + [T.StructField("state_month", T.StringType())]
)

# What each run says of the channels it processed; rows are only ever added.
RUN_LOG = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("available", T.BooleanType()),
        T.StructField("dates_processed", T.ArrayType(T.DateType())),
        T.StructField("new_records", TRACKER["source_new_records"].dataType),
        T.StructField("run_id", T.StringType()),
        T.StructField("written_at", T.TimestampType()),
        T.StructField("execution_date", T.DateType()),
    ]
)

# What happened to a record sent for reprocessing; rows are only ever added.
BATCH_EVENTS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("batch_index", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("happened_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)

# The columns found in a date's files; rows are only ever added.
DATE_COLUMNS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("partition_value", "files", "columns")]
)

# What a run found in a channel's raw table, one row per date.
RUN_STATISTICS = T.StructType(
    [T.StructField("channel", T.StringType()), T.StructField("event_date", T.DateType())]
    + [
        T.StructField(name, T.LongType())
        for name in (
            "received", "with_verbatim", "campaign_removed", "passed", "total_count", "matched_count", "unmatched_count",
        )
    ]
    + [T.StructField("match_rate", T.DoubleType())]
    + [
        T.StructField(name, T.LongType())
        for name in ("total_before", "with_comment", "without_comment", "case_1", "case_2", "case_3", "total_after")
    ]
)
