"""Sources, normalization, intent, quality and de-duplication over events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from surveylake.channels import CHANNEL_NAMES, parse_channel_list
from surveylake.functions.expressions import first_present, match_key
from surveylake.operators.dedup import (
    dedup_by_comment,
    dedup_by_keys,
    dedup_report,
    dedup_responses,
    dedup_samples,
    removed_by_comment,
    removed_by_keys,
)
from surveylake.operators.intent import intent_match_rate, intent_suffix_audit, map_intent, strip_intent_suffix
from surveylake.operators.normalize import normalize
from surveylake.operators.quality import campaign_keep, campaign_removed, input_profile
from surveylake.plans.daily import removed_responses
from surveylake.session import scratch_path
from surveylake.sinks.tables import overwrite_partitions
from surveylake.sources.tables import resolve_dates, scan_lookup_csv, scan_partition, select_channels

from .adapters import (
    INTENT_MAP_SQL,
    MAPPED_SQL,
    RESPONSES_SQL,
    SPECS,
    channel_raw,
    intent_map,
    responses,
    table,
)
from .registry import query

BATCH = ("channel", "event_date")
ROW_COLUMNS = "channel, event_date, contact_record_id, cas_account_number, response_received_date, comment"

# --- sources -----------------------------------------------------------------------

RUN_DATES = [date(2024, 1, d) for d in (1, 8, 15, 22, 29)] + [date(2024, 2, 5)]


@query(
    "scan_partition",
    f"""WITH {RESPONSES_SQL}
    SELECT event_date, channel, contact_record_id, cas_account_number, intent, campaign, comment, q1, q2, q3
    FROM responses WHERE event_date IN (DATE '2024-01-01', DATE '2024-01-08', DATE '2024-01-15', DATE '2024-01-22',
                                        DATE '2024-01-29', DATE '2024-02-05')""",
)
def _scan_partition(spark, folder):
    """All weeks of the table and one week that does not exist, read back by partition."""
    root = scratch_path(spark, "curated")
    columns = ("event_date", "channel", "contact_record_id", "cas_account_number", "intent", "campaign", "comment")
    r = responses(spark, folder).select(*columns, "q1", "q2", "q3")
    overwrite_partitions(r, root)
    return scan_partition(spark, root, RUN_DATES, r.schema).select(*r.columns)


@query(
    "scan_lookup_csv",
    f"WITH {RESPONSES_SQL}, {INTENT_MAP_SQL} SELECT DISTINCT old_intent, new_intent FROM intent_map",
)
def _scan_lookup_csv(spark, folder):
    root = scratch_path(spark, "lookup")
    # Quoted so that the outer spaces of a key survive the round trip.
    written = intent_map(spark, folder).write.option("header", True).option("quoteAll", True)
    written.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root)
    return scan_lookup_csv(spark, root).distinct()


@query(
    "resolve_dates",
    f"""WITH {RESPONSES_SQL}
    SELECT DISTINCT response_received_date AS event_date FROM responses
    WHERE event_date = (SELECT max(event_date) FROM responses)""",
)
def _resolve_dates(spark, folder):
    """The control object has one ingestion per week, holding the dates received in it."""
    root = scratch_path(spark, "control")
    days = responses(spark, folder).select("event_date", "response_received_date").distinct()
    weeks = days.groupBy("event_date").agg(F.collect_list(F.col("response_received_date").cast("string")).alias("d"))
    entry = F.struct(F.concat(F.lit("ingest-"), "event_date").alias("key"), F.to_json("d").alias("value"))
    line = F.format_string('"%s": %s', entry["key"], entry["value"])
    control = weeks.agg(F.concat(F.lit("{"), F.array_join(F.collect_list(line), ", "), F.lit("}")).alias("value"))
    control.write.text(root)
    return resolve_dates(spark, root)


@query(
    "select_channels",
    f"""WITH {RESPONSES_SQL} SELECT channel, event_date, contact_record_id FROM responses
    WHERE channel IN ('ivr', 'api_relational')""",
)
def _select_channels(spark, folder):
    wanted = parse_channel_list("API_Relational, ivr, bogus")
    return select_channels(responses(spark, folder), wanted).select("channel", "event_date", "contact_record_id")


# --- normalization --------------------------------------------------------------------


@query(
    "comment_value",
    f"""WITH {RESPONSES_SQL}
    SELECT contact_record_id, coalesce(CASE WHEN survey_id = '0' THEN comment END, intent) AS comment_value
    FROM responses""",
)
def _comment_value(spark, folder):
    df = responses(spark, folder).select(
        "contact_record_id",
        F.when(F.col("survey_id") == "0", F.col("comment")).alias("in_language"),
        F.col("intent").alias("plain"),
    )
    chosen = first_present(df, ["in_language", "absent_column", "plain"])
    return df.select("contact_record_id", chosen.alias("comment_value"))


@query(
    "intent_key",
    f"""WITH {RESPONSES_SQL}
    SELECT contact_record_id,
           regexp_replace(lower(trim(chr(9) || upper(intent) || '   ' || channel || ' ')), '\\s+', ' ', 'g') AS intent_key
    FROM responses""",
)
def _intent_key(spark, folder):
    text = F.concat(F.lit("\t"), F.upper("intent"), F.lit("   "), F.col("channel"), F.lit(" "))
    return responses(spark, folder).select("contact_record_id", match_key(text).alias("intent_key"))


def _normalize_sql(name: str) -> str:
    spec = SPECS[name]

    def value(i: int) -> str:
        if spec.scores[i].leading_number:
            return f"TRY_CAST(nullif(regexp_extract(q{i + 1}, '^(\\d+)', 1), '') AS DOUBLE)"
        return f"TRY_CAST(q{i + 1} AS DOUBLE)"

    columns = [f"{value(i)} AS {s.target}" for i, s in enumerate(spec.scores)]
    columns += [f"{value(i)} AS {q}" for i, q in enumerate(spec.score_questions)]
    raw = {raw: "intent" for _, raw in spec.text_questions} | {spec.comment_columns[1]: "comment"}
    columns += [f"{raw[source]} AS {alias}" for alias, source in spec.text_questions]
    return (
        f"WITH {RESPONSES_SQL} SELECT contact_record_id, {', '.join(columns)} FROM responses WHERE channel = '{name}'"
    )


def _normalize(name: str):
    spec = SPECS[name]
    wanted = [*spec.score_columns, *spec.score_questions, *[alias for alias, _ in spec.text_questions]]

    def run(spark, folder):
        return normalize(channel_raw(spark, folder, spec), spec).select("contact_record_id", *wanted)

    return run


for _name in CHANNEL_NAMES:
    query(f"normalize_{_name}", _normalize_sql(_name))(_normalize(_name))


# --- intent ----------------------------------------------------------------------------


@query(
    "intent_mapping",
    f"""WITH {RESPONSES_SQL}, {INTENT_MAP_SQL}, {MAPPED_SQL}
    SELECT channel, contact_record_id, survey_name, intent FROM mapped""",
)
def _intent_mapping(spark, folder):
    r = responses(spark, folder).select("channel", "contact_record_id", "survey_name", "intent")
    return map_intent(r, intent_map(spark, folder))


@query(
    "intent_match_rate",
    f"""WITH {RESPONSES_SQL}, {INTENT_MAP_SQL}, {MAPPED_SQL}
    SELECT channel, count(*) AS total_count, count(mapped_intent) AS matched_count,
           count(*) - count(mapped_intent) AS unmatched_count,
           round(count(mapped_intent) * 100.0 / count(*), 6)::DOUBLE AS match_rate
    FROM mapped GROUP BY channel""",
)
def _intent_match_rate(spark, folder):
    rate = intent_match_rate(responses(spark, folder), intent_map(spark, folder), "channel")
    return rate.withColumn("match_rate", F.round("match_rate", 6))


SUFFIXED = "CASE WHEN channel <> 'ivr' AND comment IS NULL THEN intent || '-thankyou' ELSE intent END"


def _suffixed(spark, folder):
    late = (F.col("channel") != "ivr") & F.col("comment").isNull()
    return responses(spark, folder).withColumn(
        "intent", F.when(late, F.concat("intent", F.lit("-thankyou"))).otherwise(F.col("intent"))
    )


@query(
    "intent_suffix_audit",
    f"""WITH {RESPONSES_SQL}, s AS (SELECT channel, {SUFFIXED} AS intent FROM responses)
    SELECT channel, count(*) AS total_count, count(*) FILTER (WHERE intent LIKE '%thankyou') AS suffixed_count
    FROM s GROUP BY channel""",
)
def _intent_suffix_audit(spark, folder):
    return intent_suffix_audit(_suffixed(spark, folder))


@query(
    "intent_suffix_cleanup",
    f"WITH {RESPONSES_SQL} SELECT channel, contact_record_id, intent FROM responses",
)
def _intent_suffix_cleanup(spark, folder):
    return strip_intent_suffix(_suffixed(spark, folder)).select("channel", "contact_record_id", "intent")


# --- quality ----------------------------------------------------------------------------


@query(
    "campaign_keep",
    f"WITH {RESPONSES_SQL} SELECT channel, contact_record_id, campaign FROM responses WHERE campaign = 'Main'",
)
def _campaign_keep(spark, folder):
    return campaign_keep(responses(spark, folder)).select("channel", "contact_record_id", "campaign")


@query(
    "campaign_removed",
    f"""WITH {RESPONSES_SQL} SELECT channel, contact_record_id, campaign FROM responses
    WHERE campaign IS DISTINCT FROM 'Main'""",
)
def _campaign_removed(spark, folder):
    return campaign_removed(responses(spark, folder)).select("channel", "contact_record_id", "campaign")


@query(
    "input_profile",
    f"""WITH {RESPONSES_SQL}
    SELECT channel, event_date, count(*) AS received, count(comment) AS with_verbatim,
           count(*) FILTER (WHERE channel = 'ivr' AND campaign IS DISTINCT FROM 'Main') AS campaign_removed,
           count(*) FILTER (WHERE NOT (channel = 'ivr' AND campaign IS DISTINCT FROM 'Main')) AS passed
    FROM responses GROUP BY channel, event_date""",
)
def _input_profile(spark, folder):
    return input_profile(responses(spark, folder), None, "channel", "event_date")


# --- de-duplication ------------------------------------------------------------------------

KEY_RANK_SQL = """
key_ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY channel, event_date, response_received_date, cas_account_number, survey_id, survey_name, case_type,
                 event_ts, queue_time
    ORDER BY response_received_date DESC NULLS LAST, contact_record_id) AS rn
  FROM responses WHERE channel <> 'ivr' OR campaign = 'Main')
"""
COMMENT_RANK_SQL = """
comment_ranked AS (
  SELECT *, row_number() OVER w AS rn, first_value(response_received_date) OVER w AS kept_date
  FROM responses
  WINDOW w AS (PARTITION BY channel, event_date, cas_account_number, comment,
                            CASE WHEN comment IS NULL THEN response_received_date END
               ORDER BY response_received_date DESC NULLS LAST, contact_record_id)),
comment_removed AS (
  SELECT *, CASE WHEN comment IS NULL THEN 'DEDUP_CASE_2'
                 WHEN response_received_date IS NOT DISTINCT FROM kept_date THEN 'DEDUP_CASE_1'
                 ELSE 'DEDUP_CASE_3' END AS removal_reason
  FROM comment_ranked WHERE rn > 1)
"""


def _main(spark, folder):
    """The ivr channel after its campaign filter, the other channels whole."""
    return responses(spark, folder).filter((F.col("channel") != "ivr") | (F.col("campaign") == "Main"))


def _row_columns():
    return [c.strip() for c in ROW_COLUMNS.split(",")]


@query("dedup_keys", f"WITH {RESPONSES_SQL}, {KEY_RANK_SQL} SELECT {ROW_COLUMNS} FROM key_ranked WHERE rn = 1")
def _dedup_keys(spark, folder):
    return dedup_by_keys(_main(spark, folder), BATCH).select(*_row_columns())


@query(
    "dedup_keys_removed",
    f"""WITH {RESPONSES_SQL}, {KEY_RANK_SQL}
    SELECT channel, event_date, response_received_date, cas_account_number, contact_record_id
    FROM key_ranked WHERE rn > 1""",
)
def _dedup_keys_removed(spark, folder):
    return removed_by_keys(_main(spark, folder), BATCH)


@query(
    "dedup_comment",
    f"WITH {RESPONSES_SQL}, {COMMENT_RANK_SQL} SELECT {ROW_COLUMNS} FROM comment_ranked WHERE rn = 1",
)
def _dedup_comment(spark, folder):
    return dedup_by_comment(responses(spark, folder), F.col("comment"), BATCH).select(*_row_columns())


@query(
    "dedup_removed",
    f"WITH {RESPONSES_SQL}, {COMMENT_RANK_SQL} SELECT {ROW_COLUMNS}, removal_reason FROM comment_removed",
)
def _dedup_removed(spark, folder):
    removed = removed_by_comment(responses(spark, folder), F.col("comment"), BATCH)
    return removed.select(*_row_columns(), "removal_reason")


@query(
    "dedup_report",
    f"""WITH {RESPONSES_SQL}, {COMMENT_RANK_SQL},
    cases AS (SELECT channel, event_date,
                     count(*) FILTER (WHERE removal_reason = 'DEDUP_CASE_1') AS case_1,
                     count(*) FILTER (WHERE removal_reason = 'DEDUP_CASE_2') AS case_2,
                     count(*) FILTER (WHERE removal_reason = 'DEDUP_CASE_3') AS case_3
              FROM comment_removed GROUP BY ALL),
    sizes AS (SELECT channel, event_date, count(*) AS total_before, count(comment) AS with_comment,
                     count(*) - count(comment) AS without_comment,
                     count(*) FILTER (WHERE rn = 1) AS total_after
              FROM comment_ranked GROUP BY ALL)
    SELECT s.*, coalesce(case_1, 0) AS case_1, coalesce(case_2, 0) AS case_2, coalesce(case_3, 0) AS case_3
    FROM sizes s LEFT JOIN cases c USING (channel, event_date)""",
)
def _dedup_report(spark, folder):
    return dedup_report(responses(spark, folder), F.col("comment"), BATCH)


@query(
    "dedup_samples",
    f"""WITH {RESPONSES_SQL}, {COMMENT_RANK_SQL},
    numbered AS (SELECT *, row_number() OVER (PARTITION BY removal_reason ORDER BY contact_record_id) AS sample
                 FROM comment_removed)
    SELECT removal_reason, CAST(sample AS INTEGER) AS sample, response_received_date, cas_account_number, comment
    FROM numbered WHERE sample <= 5""",
)
def _dedup_samples(spark, folder):
    removed = removed_by_comment(responses(spark, folder), F.col("comment"), BATCH)
    columns = ("removal_reason", "sample", "response_received_date", "cas_account_number", "comment")
    return dedup_samples(removed).select(*columns)


@query(
    "dedup_all_channels",
    f"""WITH {RESPONSES_SQL}, {KEY_RANK_SQL}, {COMMENT_RANK_SQL}
    SELECT {ROW_COLUMNS} FROM key_ranked WHERE rn = 1 AND channel = 'ivr'
    UNION ALL
    SELECT {ROW_COLUMNS} FROM comment_ranked WHERE rn = 1 AND channel <> 'ivr'""",
)
def _dedup_all_channels(spark, folder):
    return dedup_responses(_main(spark, folder)).select(*_row_columns())


def _quarantine_sql(name: str) -> str:
    label = SPECS[name].survey_type
    report = "response_received_date, cas_account_number, contact_record_id"
    if SPECS[name].key_dedup:
        return f"""WITH {RESPONSES_SQL}, {KEY_RANK_SQL}
        SELECT {report}, 'CAMPAIGN_FILTER_NON_MAIN' AS removal_reason, '{label}' AS survey_type,
               event_date AS removed_date
        FROM responses WHERE channel = '{name}' AND campaign IS DISTINCT FROM 'Main'
        UNION ALL
        SELECT {report}, 'DEDUP', '{label}', event_date FROM key_ranked WHERE rn > 1 AND channel = '{name}'"""
    return f"""WITH {RESPONSES_SQL}, {COMMENT_RANK_SQL}
    SELECT {report}, removal_reason, '{label}' AS survey_type, event_date AS removed_date
    FROM comment_removed WHERE channel = '{name}'"""


def _quarantine(name: str):
    def run(spark, folder):
        return removed_responses(channel_raw(spark, folder, SPECS[name]), SPECS[name])

    return run


for _name in CHANNEL_NAMES:
    query(f"quarantine_{_name}", _quarantine_sql(_name))(_quarantine(_name))
