"""Rollups, sinks, tracker, incremental load and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveylake.channels import CHANNEL_NAMES, SCORING_ORDER
from surveylake.operators.enrich import (
    ACCOUNT_COLUMNS,
    ARREARS_COLUMNS,
    OUTAGE_COLUMNS,
    enrich,
    latest_snapshot,
    reference_columns,
)
from surveylake.operators.incremental import append_missing, load_instruction, selected_dates
from surveylake.operators.rollups import (
    availability,
    cumulative_scores,
    daily_scores,
    monthly_yago,
    new_records_check,
)
from surveylake.plans.daily import run_availability, unified_responses
from surveylake.plans.enrichment import account_reference, enriched_responses
from surveylake.session import scratch_path
from surveylake.sinks.tables import (
    export_csv,
    load_reporting,
    load_status,
    overwrite_partitions,
    refresh_saved_table,
    write_removed_csv,
)
from surveylake.sinks.tracker import channel_gate, merge_tracker, scoring_order, tracker_update, upsert_tracker
from surveylake.schemas import TRACKER
from surveylake.sources.tables import scan_latest_snapshot, scan_table

from .adapters import (
    AS_OF,
    INTENT_MAP_SQL,
    MAPPED_SQL,
    ORDERS_SQL,
    RESPONSES_SQL,
    RUN_DATE,
    SNAPSHOTS_SQL,
    SPECS,
    TWO_ACCOUNTS_SQL,
    account_snapshots,
    arrears_snapshots,
    history,
    intent_map,
    outages,
    raw_channels,
    responses,
    snapshots,
    table,
    two_accounts,
)
from .registry import query
from .responses import BATCH, COMMENT_RANK_SQL, KEY_RANK_SQL

AVERAGES = ("q1_avg_csat", "q2_avg_csat", "q3_avg_csat")
# The order of a floating sum must not decide how a half-way value is rounded, so both sides add the same nudge.
NUDGE = 1e-8
AVERAGES_SQL = ", ".join(f"round(avg(q{i}) + {NUDGE}::DOUBLE, 6) AS q{i}_avg_csat" for i in (1, 2, 3))


def rounded(df):
    return df.withColumns({c: F.round(F.col(c) + NUDGE, 6) for c in AVERAGES})


# Final responses of all channels with numeric scores, as the daily run leaves them.
FINAL_SQL = f"""
final AS (
  SELECT * REPLACE (CASE WHEN channel = 'api_relational'
                         THEN TRY_CAST(nullif(regexp_extract(q1, '^(\\d+)', 1), '') AS DOUBLE)
                         ELSE TRY_CAST(q1 AS DOUBLE) END AS q1,
                    TRY_CAST(q2 AS DOUBLE) AS q2, TRY_CAST(q3 AS DOUBLE) AS q3)
  FROM (SELECT * EXCLUDE (rn) FROM key_ranked WHERE rn = 1 AND channel = 'ivr'
        UNION ALL
        SELECT * EXCLUDE (rn, kept_date) FROM comment_ranked WHERE rn = 1 AND channel <> 'ivr'))
"""
FINAL_CTE = f"WITH {RESPONSES_SQL}, {KEY_RANK_SQL}, {COMMENT_RANK_SQL}, {FINAL_SQL}"


def final(spark, folder):
    return unified_responses(raw_channels(spark, folder), SPECS, intent_map(spark, folder))


# --- rollups ------------------------------------------------------------------------


@query(
    "daily_run_scores",
    f"""{FINAL_CTE} SELECT channel, event_date, {AVERAGES_SQL}, DATE '2024-02-01' AS processing_date
    FROM final GROUP BY channel, event_date""",
)
def _daily_run_scores(spark, folder):
    """Raw channels through campaign filter, normalization, intent and de-duplication to daily scores."""
    return rounded(daily_scores(final(spark, folder), RUN_DATE))


@query(
    "final_responses",
    f"""{FINAL_CTE}, {INTENT_MAP_SQL}
    SELECT channel, event_date, contact_record_id, cas_account_number,
           coalesce(m.mapped, f.intent) AS intent, comment, q1, q2, q3
    FROM final f LEFT JOIN clean_map m ON lower(trim(f.intent)) = m.intent_key""",
)
def _final_responses(spark, folder):
    columns = ("contact_record_id", "cas_account_number", "intent", "comment", "q1", "q2", "q3")
    return final(spark, folder).select(*BATCH, *columns)


NUMERIC_SQL = f"""
numeric AS (SELECT * REPLACE (TRY_CAST(q1 AS DOUBLE) AS q1, TRY_CAST(q2 AS DOUBLE) AS q2,
                              TRY_CAST(q3 AS DOUBLE) AS q3) FROM responses)
"""


def numeric(spark, folder):
    return responses(spark, folder).withColumns({q: F.col(q).try_cast("double") for q in ("q1", "q2", "q3")})


@query(
    "daily_scores",
    f"""WITH {RESPONSES_SQL}, {NUMERIC_SQL}
    SELECT channel, event_date, {AVERAGES_SQL}, DATE '2024-02-01' AS processing_date
    FROM numeric GROUP BY channel, event_date""",
)
def _daily_scores(spark, folder):
    return rounded(daily_scores(numeric(spark, folder), RUN_DATE))


CUMULATIVE_SQL = f"""{AVERAGES_SQL}, min(event_date) AS event_start_date, max(event_date) AS event_end_date,
       DATE '2001-08-15' AS calculated_date FROM history WHERE year(event_date) = 2001"""
YAGO_SQL = f"""CAST(month(event_date) AS INTEGER) AS month,
       CASE WHEN year(event_date) = 2001 THEN 'current' ELSE 'yago' END AS year_label,
       {AVERAGES_SQL}, count(*) AS record_count, DATE '2001-08-15' AS calculated_date
FROM history WHERE year(event_date) IN (2000, 2001) AND month(event_date) <= 8"""


@query("cumulative_scores", f"WITH {ORDERS_SQL} SELECT {CUMULATIVE_SQL}")
def _cumulative_scores(spark, folder):
    return rounded(cumulative_scores(history(spark, folder), AS_OF))


@query("cumulative_scores_by_channel", f"WITH {ORDERS_SQL} SELECT channel, {CUMULATIVE_SQL} GROUP BY channel")
def _cumulative_by_channel(spark, folder):
    return rounded(cumulative_scores(history(spark, folder), AS_OF, "channel"))


@query("monthly_yago", f"WITH {ORDERS_SQL} SELECT {YAGO_SQL} GROUP BY month(event_date), year(event_date)")
def _monthly_yago(spark, folder):
    return rounded(monthly_yago(history(spark, folder), AS_OF))


@query(
    "monthly_yago_by_channel",
    f"WITH {ORDERS_SQL} SELECT channel, {YAGO_SQL} GROUP BY channel, month(event_date), year(event_date)",
)
def _monthly_yago_by_channel(spark, folder):
    return rounded(monthly_yago(history(spark, folder), AS_OF, "channel"))


# --- sinks ----------------------------------------------------------------------------


@query(
    "write_final",
    f"""WITH {RESPONSES_SQL}
    SELECT contact_record_id, event_date, channel,
           CASE WHEN campaign = 'Main' THEN 'second' ELSE 'first' END AS written_by
    FROM responses WHERE campaign = 'Main' OR (event_date, channel) NOT IN
      (SELECT event_date, channel FROM responses WHERE campaign = 'Main')
    ORDER BY ALL""",
)
def _write_final(spark, folder):
    """Everything is written, then the partitions of the main campaign are overwritten with its rows."""
    root = scratch_path(spark, "final")
    r = responses(spark, folder).select("contact_record_id", "event_date", "channel", "campaign")
    columns = ("contact_record_id", "event_date", "channel", "written_by")
    overwrite_partitions(r.withColumn("written_by", F.lit("first")).select(*columns), root, BATCH)
    second = r.filter(F.col("campaign") == "Main").withColumn("written_by", F.lit("second")).select(*columns)
    overwrite_partitions(second, root, BATCH)
    overwrite_partitions(second, root, BATCH)
    return spark.read.schema(second.schema).parquet(root).select(*columns)


@query(
    "write_removed_csv",
    f"""WITH {RESPONSES_SQL}, {COMMENT_RANK_SQL}
    SELECT CAST(contact_record_id AS VARCHAR) AS contact_record_id, cas_account_number, removal_reason,
           event_date AS removed_date FROM comment_removed""",
)
def _write_removed_csv(spark, folder):
    from surveylake.operators.dedup import removed_by_comment

    root = scratch_path(spark, "removed")
    removed = removed_by_comment(responses(spark, folder), F.col("comment"), BATCH)
    columns = ("contact_record_id", "cas_account_number", "removal_reason")
    write_removed_csv(removed.select(*columns, F.col("event_date").alias("removed_date")), root)
    written = spark.read.schema(", ".join(f"{c} string" for c in columns) + ", removed_date date")
    return written.option("header", True).csv(root)


@query("export_csv", "SELECT * FROM orders")
def _export_csv(spark, folder):
    target = scratch_path(spark, "csv")
    export_csv(spark, f"{folder}/orders.parquet", target)
    return spark.read.schema(table(spark, folder, "orders").schema).option("header", True).csv(target)


NEW_RECORDS_SQL = f"""{FINAL_CTE},
    stored AS (SELECT channel, event_date, count(*) AS n FROM responses WHERE campaign = 'Main' GROUP BY ALL),
    incoming AS (SELECT channel, event_date, count(*) AS n FROM final GROUP BY ALL),
    checked AS (
      SELECT channel, event_date, coalesce(i.n, 0) AS new_count, coalesce(s.n, 0) AS existing_count,
             coalesce(i.n, 0) > coalesce(s.n, 0) AS new_records_found
      FROM incoming i FULL JOIN stored s USING (channel, event_date))"""


def _new_records(spark, folder):
    stored = responses(spark, folder).filter(F.col("campaign") == "Main")
    return new_records_check(final(spark, folder), stored)


@query("new_records_check", f"{NEW_RECORDS_SQL} SELECT * FROM checked")
def _new_records_check(spark, folder):
    return _new_records(spark, folder)


@query(
    "availability",
    f"""{FINAL_CTE}, channels AS (SELECT DISTINCT channel FROM responses)
    SELECT channel, count(f.event_date) AS final_rows, count(f.event_date) > 0 AS available
    FROM channels LEFT JOIN final f USING (channel) GROUP BY channel""",
)
def _availability(spark, folder):
    return availability(final(spark, folder), responses(spark, folder).select("channel").distinct())


def _flags_sql(condition: str) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE channel = '{name}' AND {condition}) > 0 AS {spec.tracker_prefix}_available"
        for name, spec in SPECS.items()
    )


@query(
    "tracker_upsert",
    f"""{NEW_RECORDS_SQL},
    flags AS (SELECT {_flags_sql("true")} FROM final)
    SELECT DATE '2024-02-01' AS execution_date, flags.*,
           (SELECT count(DISTINCT event_date) FROM checked WHERE channel = 'ivr')::INTEGER AS dates,
           (SELECT count(*) FROM checked WHERE channel = 'ivr')::INTEGER AS reports,
           (SELECT count(*) FROM checked WHERE channel = 'ivr' AND new_records_found)::INTEGER AS found
    FROM flags""",
)
def _tracker_upsert(spark, folder):
    """A full run, then an ivr-only run: the other flags keep their values, the report is the second one's."""
    root = scratch_path(spark, "tracker")
    _new_records(spark, folder).write.parquet(f"{root}-reports")
    reports = spark.read.parquet(f"{root}-reports")
    present = run_availability(reports)
    upsert_tracker(spark, root, tracker_update(present, reports, RUN_DATE, CHANNEL_NAMES))
    ivr = reports.filter(F.col("channel") == "ivr")
    upsert_tracker(spark, root, tracker_update(present, ivr, RUN_DATE, ["ivr"]))
    stored = scan_table(spark, root, TRACKER)
    found = F.filter("source_new_records", lambda r: r["new_records_found"])
    return stored.select(
        "execution_date",
        *[c for c in stored.columns if c.endswith("_available")],
        F.size("dates_processed").alias("dates"),
        F.size("source_new_records").alias("reports"),
        F.size(found).alias("found"),
    )


@query(
    "channel_gate",
    f"""WITH {RESPONSES_SQL},
    wanted AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {i})" for i, c in enumerate(SCORING_ORDER, 1))})
               AS t(channel, position)),
    seen AS (SELECT channel, true AS available FROM responses WHERE campaign IS NULL AND channel <> 'sms_relational'
             AND channel <> 'ivr' GROUP BY channel)
    SELECT channel, CAST(position AS INTEGER) AS position, coalesce(available, false) AS available,
           coalesce(available, false) OR channel = 'ivr' AS run
    FROM wanted LEFT JOIN seen USING (channel)""",
)
def _channel_gate(spark, folder):
    """A tracker row in which ivr is false and sms relational was never set."""
    r = responses(spark, folder)
    seen = r.filter(F.col("campaign").isNull()).select("channel").distinct()
    present = seen.select("channel", (F.col("channel") != "ivr").alias("available"))
    report = new_records_check(r, r)
    processed = [c for c in CHANNEL_NAMES if c != "sms_relational"]
    state = spark.createDataFrame([], TRACKER)
    tracker = merge_tracker(state, tracker_update(present, report, RUN_DATE, processed))
    return channel_gate(tracker, scoring_order(spark), RUN_DATE)


@query(
    "reporting_load",
    f"""WITH {ORDERS_SQL},
    a AS (SELECT channel AS "table", 'aggregate' AS "schema", count(DISTINCT channel) AS rows_loaded
          FROM history WHERE year(event_date) = 2001 GROUP BY channel),
    m AS (SELECT channel, 'monthly_yago', count(DISTINCT month(event_date) * 10000 + year(event_date))
          FROM history WHERE year(event_date) IN (2000, 2001) AND month(event_date) <= 8 GROUP BY channel)
    SELECT *, 'SUCCESS' AS status, 'SUCCESS' AS lookup_status FROM (FROM a UNION ALL FROM m)""",
)
def _reporting_load(spark, folder):
    """Ten reporting tables, one per rollup and channel, refreshed and counted."""
    root = scratch_path(spark, "reporting")
    by_channel = {
        "aggregate": cumulative_scores(history(spark, folder), AS_OF, "channel"),
        "monthly_yago": monthly_yago(history(spark, folder), AS_OF, "channel"),
    }
    frames = {}
    for schema, rollup in by_channel.items():
        overwrite_partitions(rollup, f"{root}/{schema}-all", ["channel"])
        stored = spark.read.parquet(f"{root}/{schema}-all")
        frames |= {(schema, c): stored.filter(F.col("channel") == c).drop("channel") for c in CHANNEL_NAMES}
    results = load_reporting(spark, frames, lambda df, s, t: refresh_saved_table(df, s, t, root))
    status = load_status(results).scalar()
    return results.select("schema", "table", "rows_loaded", "status", status.alias("lookup_status"))


# --- incremental ----------------------------------------------------------------------


@query(
    "append_missing",
    f"""WITH {ORDERS_SQL} SELECT event_date, contact_record_id FROM history
    WHERE event_date NOT IN (SELECT event_date FROM history WHERE month(event_date) % 2 = 0)""",
)
def _append_missing(spark, folder):
    h = history(spark, folder)
    loaded = h.filter(F.month("event_date") % 2 == 0)
    return append_missing(h, loaded).select("event_date", "contact_record_id")


@query(
    "append_missing_records",
    f"""WITH {ORDERS_SQL} SELECT event_date, contact_record_id FROM history WHERE contact_record_id NOT IN
    (SELECT contact_record_id FROM history WHERE month(event_date) % 2 = 0 AND channel <> 'ivr')""",
)
def _append_missing_records(spark, folder):
    h = history(spark, folder)
    loaded = h.filter((F.month("event_date") % 2 == 0) & (F.col("channel") != "ivr"))
    return append_missing(h, loaded, "contact_record_id").select("event_date", "contact_record_id")


@query(
    "load_manifest",
    f"""WITH {ORDERS_SQL},
    missing AS (SELECT * FROM history WHERE month(event_date) % 2 <> 0),
    n AS (SELECT count(DISTINCT event_date) AS selected_date_count FROM missing)
    SELECT event_date, count(*) AS rows, selected_date_count,
           CASE WHEN selected_date_count = 0 THEN 'SKIP' ELSE 'CONTINUE' END AS instruction
    FROM missing, n GROUP BY ALL""",
)
def _load_manifest(spark, folder):
    h = history(spark, folder)
    manifest = selected_dates(append_missing(h, h.filter(F.month("event_date") % 2 == 0)))
    gate = load_instruction(manifest)
    return manifest.select(
        "event_date",
        "rows",
        gate.select("selected_date_count").scalar().alias("selected_date_count"),
        gate.select("instruction").scalar().alias("instruction"),
    )


# --- enrichment -------------------------------------------------------------------------


@query("latest_snapshot", f"WITH {SNAPSHOTS_SQL} SELECT account_number, current_balance, insert_date FROM latest")
def _latest_snapshot(spark, folder):
    """Both snapshots are written by insert date; only the last folder is read back."""
    root = scratch_path(spark, "snapshots")
    s = snapshots(spark, folder).select("account_number", "current_balance", "insert_date")
    overwrite_partitions(s, root, ["insert_date"])
    return scan_latest_snapshot(spark, root, s.schema).select(*s.columns)


@query(
    "latest_snapshot_frame",
    f"WITH {SNAPSHOTS_SQL} SELECT account_number, current_balance, segment, insert_date FROM latest",
)
def _latest_snapshot_frame(spark, folder):
    columns = ("account_number", "current_balance", "segment", "insert_date")
    return latest_snapshot(snapshots(spark, folder)).select(*columns)


# The join column of a batch: the customer account if any row of the batch has one.
JOIN_KEY_SQL = """
batches AS (SELECT channel, event_date, count(customer_account_number) > 0 AS use_customer
            FROM two_accounts GROUP BY ALL),
keyed AS (SELECT t.*, CASE WHEN use_customer THEN customer_account_number ELSE cas_account_number END AS account
          FROM two_accounts t JOIN batches USING (channel, event_date))
"""
ENRICH_CTE = f"WITH {RESPONSES_SQL}, {TWO_ACCOUNTS_SQL}, {SNAPSHOTS_SQL}, {JOIN_KEY_SQL}"
ENRICH_ROWS = ("channel", "contact_record_id", "cas_account_number", "customer_account_number")


@query(
    "enrich_arrears",
    f"""{ENRICH_CTE}
    SELECT {", ".join(f"k.{c}" for c in ENRICH_ROWS)}, l.current_balance AS arrears_current_balance,
           l.segment AS arrears_tariff_rate_code,
           CASE WHEN l.account_number IS NOT NULL THEN 'A' END AS arrears_agreement_status_code
    FROM keyed k LEFT JOIN latest l ON k.account = CAST(l.account_number AS VARCHAR)""",
)
def _enrich_arrears(spark, folder):
    reference = reference_columns(latest_snapshot(arrears_snapshots(spark, folder)), ARREARS_COLUMNS)
    enriched = enrich(two_accounts(spark, folder), reference, batch=BATCH)
    added = ("arrears_current_balance", "arrears_tariff_rate_code", "arrears_agreement_status_code")
    return enriched.select(*ENRICH_ROWS, *added)


@query(
    "enrich_account",
    f"""{ENRICH_CTE}
    SELECT {", ".join(f"k.{c}" for c in ENRICH_ROWS)}, l.segment AS cas_current_credit_history_code,
           CAST(l.nation AS VARCHAR) AS cas_division
    FROM keyed k LEFT JOIN latest l ON k.account = CAST(l.account_number AS VARCHAR)""",
)
def _enrich_account(spark, folder):
    reference = reference_columns(latest_snapshot(account_snapshots(spark, folder)), ACCOUNT_COLUMNS)
    enriched = enrich(two_accounts(spark, folder), reference, batch=BATCH)
    return enriched.select(*ENRICH_ROWS, "cas_current_credit_history_code", "cas_division")


OUTAGE_SQL = """
outages AS (SELECT o_custkey AS account_number, max(o_orderdate) AS restored, min(o_orderdate) AS off
            FROM orders GROUP BY 1)
"""


@query(
    "enrich_outage",
    f"""{ENRICH_CTE}, {OUTAGE_SQL}
    SELECT {", ".join(f"k.{c}" for c in ENRICH_ROWS)}, o.restored AS cf_ma_rtm_ami_lost_power_restored_datetm,
           o.off AS cf_ma_rtm_ami_lost_power_off_datetm
    FROM keyed k LEFT JOIN outages o ON k.account = CAST(o.account_number AS VARCHAR)""",
)
def _enrich_outage(spark, folder):
    reference = reference_columns(outages(spark, folder), OUTAGE_COLUMNS)
    return enrich(two_accounts(spark, folder), reference, batch=BATCH).select(*ENRICH_ROWS, *OUTAGE_COLUMNS.values())


@query(
    "enrich_all",
    f"""{ENRICH_CTE}, {OUTAGE_SQL}
    SELECT {", ".join(f"k.{c}" for c in ENRICH_ROWS)}, l.current_balance AS arrears_current_balance,
           CAST(l.nation AS VARCHAR) AS cas_division, o.off AS cf_ma_rtm_ami_lost_power_off_datetm
    FROM keyed k LEFT JOIN latest l ON k.account = CAST(l.account_number AS VARCHAR)
                 LEFT JOIN outages o ON k.account = CAST(o.account_number AS VARCHAR)""",
)
def _enrich_all(spark, folder):
    """All three references in one pass over the responses."""
    reference = account_reference(
        arrears_snapshots(spark, folder), account_snapshots(spark, folder), outages(spark, folder)
    )
    enriched = enriched_responses(two_accounts(spark, folder), reference, BATCH)
    added = ("arrears_current_balance", "cas_division", "cf_ma_rtm_ami_lost_power_off_datetm")
    return enriched.select(*ENRICH_ROWS, *added)


# Queries whose join sides grow with the tables; tests run them without any broadcast too.
QUERY_NAMES_WITH_JOINS = ("dedup_removed", "intent_mapping", "enrich_all", "append_missing_records")
