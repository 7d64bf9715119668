"""Queries on stored states, the run log, the batch ledger and the daily run as a whole."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from surveylake.channels import CHANNEL_NAMES
from surveylake.operators.corrections import BATCH_SIZE, RANDOM_SEED, reprocess_batches
from surveylake.operators.ledger import (
    answered_events,
    append_events,
    ledger_summary,
    next_batches,
    read_events,
    record_states,
    sent_events,
)
from surveylake.operators.states import content_check, cumulative_from_states, monthly_from_states, score_states
from surveylake.plans.daily import Catalog, run_availability, run_daily
from surveylake.session import scratch_path
from surveylake.sinks.states import stored_states, update_states
from surveylake.sinks.tracker import append_run, fold_log, read_log

from .adapters import AS_OF, INTENT_MAP_SQL, ORDERS_SQL, RESPONSES_SQL, RUN_DATE, SPECS, history, intent_map, raw_channels
from .registry import ORACLES, query
from .rollups import CUMULATIVE_SQL, FINAL_CTE, YAGO_SQL, _new_records, numeric, rounded
from .text import BATCHES_CTE, low


def _history_states(spark, folder):
    """States of the history, written with half of one month's rows first, then with that month's dates replaced."""
    h, root = history(spark, folder), scratch_path(spark, "score-states")
    late = F.date_format("event_date", "yyyy-MM") == f"{AS_OF:%Y-%m}"
    days = [row.event_date for row in h.select("event_date").distinct().collect()]  # the calendar
    update_states(spark, root, score_states(h.filter(~late | (F.col("contact_record_id") % 2 == 0)), "channel"), days)
    month = [d for d in days if (d.year, d.month) == (AS_OF.year, AS_OF.month)]
    update_states(spark, root, score_states(h.filter(late), "channel"), month)
    return stored_states(spark, root)


@query(
    "rollups_from_states",
    f"WITH {ORDERS_SQL} SELECT channel, {YAGO_SQL} GROUP BY channel, month(event_date), year(event_date)",
)
def _rollups_from_states(spark, folder):
    return rounded(monthly_from_states(_history_states(spark, folder), AS_OF, "channel"))


@query("cumulative_from_states", f"WITH {ORDERS_SQL} SELECT channel, {CUMULATIVE_SQL} GROUP BY channel")
def _cumulative_from_states(spark, folder):
    return rounded(cumulative_from_states(_history_states(spark, folder), AS_OF, "channel"))


@query(
    "content_check",
    f"""WITH {RESPONSES_SQL},
    sides AS (
      SELECT channel, event_date, contact_record_id % 50 = 0 AND channel = 'sms_relational' AS altered,
             channel = 'ivr' AND event_date = DATE '2024-01-08' AS absent,
             channel = 'api_relational' AND contact_record_id % 4 = 0 AS fewer
      FROM responses)
    SELECT channel, event_date, count(*) AS new_count, count(*) FILTER (NOT absent AND NOT fewer) AS existing_count,
           count(*) > count(*) FILTER (NOT absent AND NOT fewer) AS new_records_found,
           bool_or(altered OR absent OR fewer) AS content_changed
    FROM sides GROUP BY channel, event_date""",
)
def _content_check(spark, folder):
    """The stored side lacks a date and some rows, and has other rows in equal number for one channel."""
    new = numeric(spark, folder)
    gone = (F.col("channel") == "ivr") & (F.col("event_date") == date(2024, 1, 8))
    fewer = (F.col("channel") == "api_relational") & (F.col("contact_record_id") % 4 == 0)
    altered = (F.col("channel") == "sms_relational") & (F.col("contact_record_id") % 50 == 0)
    comment = F.when(altered, F.concat(F.coalesce("comment", F.lit("")), F.lit("!"))).otherwise(F.col("comment"))
    old = new.filter(~gone & ~fewer).withColumn("comment", comment)
    return content_check(*[score_states(df, "channel", digest=new.columns) for df in (new, old)])


@query("tracker_from_log", ORACLES["tracker_upsert"])
def _tracker_from_log(spark, folder):
    """A full run and an ivr-only run that both add to the log; the tracker is what the log adds up to."""
    root = scratch_path(spark, "run-log")
    _new_records(spark, folder).write.parquet(f"{root}-reports")
    reports = spark.read.parquet(f"{root}-reports")
    present = run_availability(reports)
    append_run(spark, root, present, reports, RUN_DATE, CHANNEL_NAMES, "run-1")
    append_run(spark, root, present, reports.filter(F.col("channel") == "ivr"), RUN_DATE, ["ivr"], "run-2")
    state = fold_log(read_log(spark, root))
    found = F.filter("source_new_records", lambda r: r["new_records_found"])
    return state.select(
        "execution_date",
        *[c for c in state.columns if c.endswith("_available")],
        F.size("dates_processed").alias("dates"),
        F.size("source_new_records").alias("reports"),
        F.size(found).alias("found"),
    )


NOW = datetime(2024, 2, 3, 12)


def _ledger(spark, folder):
    """A first run sent everything but ivr; even batches were answered, and every third batch was sent too long ago."""
    root = scratch_path(spark, "ledger")
    found = low(spark, folder)
    path = scratch_path(spark, "sent")
    reprocess_batches(found.filter(F.col("channel") != "ivr")).select("record_id", "batch_index").write.parquet(path)
    sent = spark.read.parquet(path)
    old = F.col("batch_index") % 3 == 0
    append_events(sent_events(sent.filter(old), "run-0", NOW - timedelta(days=2)), root)
    append_events(sent_events(sent.filter(~old), "run-1", NOW - timedelta(hours=1)), root)
    append_events(answered_events(sent.filter(F.col("batch_index") % 2 == 0), "run-1-answers", NOW - timedelta(minutes=5)), root)
    return found, record_states(read_events(spark, root), NOW)


LEDGER_CTE = f"""{BATCHES_CTE.replace("FROM low)", "FROM low WHERE channel <> 'ivr')")},
states AS (
  SELECT record_id, CASE WHEN batch_index % 2 = 0 THEN 'answered' WHEN batch_index % 3 = 0 THEN 'expired' ELSE 'sent' END AS state
  FROM batches
  UNION ALL SELECT record_id, 'open' FROM low WHERE channel = 'ivr')"""


@query(
    "reprocess_second_run",
    f"""{LEDGER_CTE}
    SELECT record_id, CAST((row_number() OVER (ORDER BY md5(record_id || '{RANDOM_SEED}'), record_id) - 1) // {BATCH_SIZE}
                           AS BIGINT) AS batch_index
    FROM states WHERE state IN ('open', 'expired')""",
)
def _reprocess_second_run(spark, folder):
    """What the second run sends: records never sent and those without an answer in time."""
    return next_batches(*_ledger(spark, folder)).select("record_id", "batch_index")


@query("ledger_summary", f"{LEDGER_CTE} SELECT state, count(*) AS records FROM states GROUP BY state")
def _ledger_summary(spark, folder):
    return ledger_summary(*_ledger(spark, folder))


# --- the daily run as a whole --------------------------------------------------------------

DAYS = (date(2024, 1, 8), date(2024, 1, 22), date(2030, 1, 1))


def _run(spark, folder, times):
    """Two dates with rows and one without, run over files so many times."""
    root = scratch_path(spark, "lake")
    for name, df in raw_channels(spark, folder).items():
        df.write.partitionBy("event_date").parquet(f"{root}/curated/{name}")
    intent_map(spark, folder).write.option("header", True).csv(f"{root}/lookup")
    catalog = Catalog(f"{root}/curated", f"{root}/out", f"{root}/lookup")
    return catalog, [run_daily(spark, catalog, RUN_DATE, DAYS, specs=SPECS) for _ in range(times)]


@query(
    "run_daily_final",
    f"""{FINAL_CTE}, {INTENT_MAP_SQL}
    SELECT channel, event_date, contact_record_id, cas_account_number, coalesce(m.mapped, f.intent) AS intent, q1, q2, q3
    FROM final f LEFT JOIN clean_map m ON lower(trim(f.intent)) = m.intent_key
    WHERE event_date IN (DATE '2024-01-08', DATE '2024-01-22')""",
)
def _run_daily_final(spark, folder):
    """The final tables the daily run leaves, read back."""
    catalog, _ = _run(spark, folder, 1)

    def final(spec):
        scores = [F.col(c).alias(f"q{i}") for i, c in enumerate(spec.score_columns, 1)]
        stored = spark.read.parquet(catalog.path("final", spec.name))
        return stored.select(F.lit(spec.name).alias("channel"), "event_date", "contact_record_id", "cas_account_number", "intent", *scores)

    tables = [final(spec) for spec in SPECS.values()]
    every = tables[0]
    for part in tables[1:]:
        every = every.unionByName(part)
    return every


@query(
    "run_daily_report",
    f"""{FINAL_CTE}, days AS (SELECT unnest([DATE '2024-01-08', DATE '2024-01-22', DATE '2030-01-01']) AS event_date),
    channels AS (SELECT DISTINCT channel FROM responses),
    counted AS (SELECT channel, event_date, count(f.event_date) AS n
                FROM channels CROSS JOIN days LEFT JOIN final f USING (channel, event_date) GROUP BY ALL)
    SELECT run, channel, event_date, n AS new_count, CASE WHEN run = 1 THEN 0 ELSE n END AS existing_count,
           run = 1 AND n > 0 AS new_records_found, run = 1 AND n > 0 AS content_changed
    FROM counted, (SELECT unnest([1, 2])::INTEGER AS run)""",
)
def _run_daily_report(spark, folder):
    """The reports of both runs: the first finds new records, the second neither more nor other rows."""
    first, second = _run(spark, folder, 2)[1]
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
