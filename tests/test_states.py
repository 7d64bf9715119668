"""Stored states against full scans, overlapping runs in the log, and the batch ledger."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.adapters import SPECS, intent_map, raw_channels
from surveylake.operators.ledger import answered_events, ledger_summary, next_batches, record_states, sent_events
from surveylake.operators.rollups import cumulative_scores, daily_scores, monthly_yago
from surveylake.operators.states import (
    content_check,
    cumulative_from_states,
    daily_from_states,
    merged,
    monthly_from_states,
    score_states,
)
from surveylake.plans.daily import Catalog, channel_states, run_daily
from surveylake.schemas import SCORE_STATES, TRACKER
from surveylake.session import scratch_path
from surveylake.sinks.states import catch_up, stored_states, update_states
from surveylake.sinks.tracker import append_run, fold_log, read_log, refresh_tracker
from surveylake.sources.tables import scan_table

D = date
ROWS = [
    ("ivr", D(2023, 1, 31), 1.0, None, 5.0), ("ivr", D(2023, 2, 1), 2.0, 4.0, None), ("ivr", D(2024, 1, 5), None, None, None),
    ("ivr", D(2024, 1, 5), 3.0, 8.0, None), ("ivr", D(2024, 2, 7), 0.1, 0.2, 0.3), ("ivr", D(2024, 2, 8), 0.7, 0.2, 0.3),
    ("sms", D(2024, 2, 7), 9.0, 1.0, 2.0), ("sms", D(2024, 11, 7), 4.0, 1.0, 2.0), ("sms", D(2022, 2, 7), 4.0, 1.0, 2.0),
]
SCHEMA = "channel string, event_date date, q1 double, q2 double, q3 double"


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    columns = sorted(left.columns)
    a, b = (sorted(map(tuple, df.select(*columns).collect()), key=repr) for df in (left, right))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert u == v or (isinstance(u, float) and math.isclose(u, v, rel_tol=1e-12)), (x, y)


@pytest.mark.parametrize("as_of", [D(2024, 2, 10), D(2023, 12, 31), D(2030, 6, 1)])
def test_rollups_equal_the_full_scan(spark, as_of):
    df, root = frame(spark), scratch_path(spark, "states")
    update_states(spark, root, score_states(df, "channel"), {r[1] for r in ROWS})
    states = stored_states(spark, root)
    same(cumulative_from_states(states, as_of), cumulative_scores(df, as_of))
    same(cumulative_from_states(states, as_of, "channel"), cumulative_scores(df, as_of, "channel"))
    same(monthly_from_states(states, as_of), monthly_yago(df, as_of))
    same(monthly_from_states(states, as_of, "channel"), monthly_yago(df, as_of, "channel"))
    same(daily_from_states(states, as_of), daily_scores(df, as_of))


def test_states_add_up_in_any_order(spark):
    df = frame(spark)
    whole = merged(score_states(df, digest=df.columns))
    parts = [score_states(df.filter(c), digest=df.columns) for c in ("q1 > 2", "NOT coalesce(q1 > 2, false)")]
    same(merged(parts[1].unionByName(parts[0])), whole)


def test_digest_tells_rows_not_their_order(spark):
    def digest(rows, schema="channel string, event_date date, q1 double, q2 double, q3 double, a string, b string"):
        df = spark.createDataFrame(rows, schema)
        return score_states(df, "channel", digest=df.columns)

    def row(a, b):
        return ("ivr", D(2024, 1, 1), 1.0, 1.0, 1.0, a, b)

    def changed(new, old):
        return content_check(digest(new), digest(old)).first().content_changed

    assert not changed([row("x", "y"), row("u", None)], [row("u", None), row("x", "y")])
    assert changed([row("x", "y"), row("x", "y")], [row("u", "v"), row("u", "v")])
    assert changed([row("x", None)], [row(None, "x")])
    assert changed([row("x", "y")], [row("x", "y"), row("x", "y")])


def test_replaced_and_emptied_dates(spark):
    root = scratch_path(spark, "states")
    df = frame(spark)
    update_states(spark, root, score_states(df, "channel"), {r[1] for r in ROWS})
    newer = [("ivr", D(2024, 1, 5), 5.0, 5.0, 5.0)]
    update_states(spark, root, score_states(frame(spark, newer), "channel"), [D(2024, 1, 5), D(2024, 2, 8)])
    expected = frame(spark, [r for r in ROWS if r[1] not in (D(2024, 1, 5), D(2024, 2, 8))] + newer)
    same(stored_states(spark, root), score_states(expected, "channel").select(*SCORE_STATES.fieldNames()))
    update_states(spark, root, stored_states(spark, root).limit(0), [D(2024, 1, 5)])
    assert stored_states(spark, root).filter(F.col("event_date") == D(2024, 1, 5)).count() == 0
    update_states(spark, scratch_path(spark, "none"), stored_states(spark, root), [])


def test_catch_up_reads_missing_dates_only(spark):
    table, root = scratch_path(spark, "final"), scratch_path(spark, "states")
    frame(spark).write.partitionBy("event_date").parquet(table)
    asked = []

    def build(dates):
        asked.append(dates)
        return score_states(spark.read.parquet(table).filter(F.col("event_date").isin(dates)), "channel")

    assert catch_up(spark, table, root, build) == sorted({r[1] for r in ROWS}) and len(asked) == 1
    assert catch_up(spark, table, root, build) == [] and len(asked) == 1
    update_states(spark, root, stored_states(spark, root).limit(0), [D(2024, 2, 7)])
    stale = frame(spark, [("ivr", D(2021, 3, 3), 1.0, 1.0, 1.0)])
    update_states(spark, root, score_states(stale, "channel"), [D(2021, 3, 3)])
    assert catch_up(spark, table, root, build) == [D(2024, 2, 7), D(2021, 3, 3)] and asked[1] == [D(2024, 2, 7)]
    same(stored_states(spark, root), score_states(frame(spark), "channel").select(*SCORE_STATES.fieldNames()))


@pytest.fixture(scope="module")
def lake(spark, small):
    root = scratch_path(spark, "lake")
    for name, df in raw_channels(spark, small).items():
        df.write.partitionBy("event_date").parquet(f"{root}/curated/{name}")
    intent_map(spark, small).write.option("header", True).csv(f"{root}/lookup")
    return Catalog(f"{root}/curated", f"{root}/out", f"{root}/lookup")


def test_a_run_with_one_date_reads_no_other_date(spark, lake):
    days = [D(2024, 1, 8), D(2024, 1, 15)]
    run_daily(spark, lake, D(2024, 1, 31), days, ["ivr"])
    # The other date's files are made unreadable: whatever still opens them fails.
    folder = lake.path("final", "ivr")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/event_date=2024-01-08")
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(hadoop):
        if status.getPath().getName().startswith("part-"):
            out = files.create(status.getPath(), True)
            out.writeBytes("not parquet")
            out.close()
    report = run_daily(spark, lake, D(2024, 1, 31), [D(2024, 1, 15)], ["ivr"]).collect()
    assert [(r.new_count == r.existing_count > 0, r.content_changed) for r in report] == [(True, False)]
    aggregate = spark.read.parquet(lake.path("aggregate", "ivr")).first()
    assert (aggregate.event_start_date, aggregate.event_end_date) == tuple(days)
    with pytest.raises(Exception):
        spark.read.schema(spark.read.parquet(f"{folder}/event_date=2024-01-15").schema).parquet(f"{folder}/event_date=2024-01-08").collect()
    # Written again, the date is whole.
    run_daily(spark, lake, D(2024, 1, 31), [D(2024, 1, 8)], ["ivr"])
    scores = [F.col(c).alias(f"q{i}") for i, c in enumerate(SPECS["ivr"].score_columns, 1)]
    history = spark.read.parquet(folder).select("event_date", *scores)
    same(spark.read.parquet(lake.path("aggregate", "ivr")), cumulative_scores(history, D(2024, 1, 31)))
    same(spark.read.parquet(lake.path("monthly_yago", "ivr")), monthly_yago(history, D(2024, 1, 31)))


def test_changed_rows_of_equal_number_are_reported(spark, lake):
    day, root = D(2024, 1, 22), lake.curated_path("sms_relational")
    run_daily(spark, lake, D(2024, 1, 31), [day], ["sms_relational"])
    raw = spark.read.parquet(f"{root}/event_date={day}")
    altered, path = raw.withColumn("q2_satisfaction_value_sms", F.lit("1")), scratch_path(spark, "altered")
    altered.write.parquet(path)
    spark.read.parquet(path).write.mode("overwrite").parquet(f"{root}/event_date={day}")
    (row,) = run_daily(spark, lake, D(2024, 1, 31), [day], ["sms_relational"]).collect()
    assert row.new_count == row.existing_count and not row.new_records_found and row.content_changed


def test_states_of_a_table_older_than_they_are(spark, lake):
    name = "api_transactional"
    run_daily(spark, lake, D(2024, 1, 31), [D(2024, 1, 8), D(2024, 1, 15)], [name])
    states = channel_states(spark, lake, SPECS[name])
    expected = sorted(map(str, states.select(*sorted(states.columns)).collect()))
    root = lake.path("score_states", name)
    update_states(spark, root, states.limit(0), [D(2024, 1, 8), D(2024, 1, 15)])
    again = channel_states(spark, lake, SPECS[name])
    assert sorted(map(str, again.select(*sorted(again.columns)).collect())) == expected != []


# --- run log ---------------------------------------------------------------------------------

DAY = D(2024, 5, 1)


def report(spark, channel, found, days=(DAY,)):
    return spark.createDataFrame([(channel, d, found) for d in days], "channel string, event_date date, new_records_found boolean")


def present(spark, **flags):
    return spark.createDataFrame(list(flags.items()), "channel string, available boolean")


def test_overlapping_runs_lose_nothing(spark):
    root, copy = scratch_path(spark, "log"), scratch_path(spark, "tracker")

    def run(name):
        append_run(spark, root, present(spark, **{name: True}), report(spark, name, True), DAY, [name], f"run-{name}")
        refresh_tracker(spark, root, f"{copy}-{name}", DAY)

    names = ["ivr", "sms_relational", "api_relational"]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(run, names))
    row = fold_log(read_log(spark, root)).first()
    assert row.ivr_available and row.sms_web_relational_available and row.api_web_relational_available
    assert row.sms_web_transactional_available is None
    refresh_tracker(spark, root, copy, DAY)
    assert scan_table(spark, copy, TRACKER).first().asDict() == row.asDict()


def test_latest_run_decides_its_flags_and_the_lists(spark):
    root = scratch_path(spark, "log")
    both = present(spark, ivr=True, sms_relational=True)
    append_run(spark, root, both, report(spark, "ivr", True), DAY, ["ivr", "sms_relational"], "a")
    append_run(spark, root, present(spark, ivr=False), report(spark, "ivr", False, [DAY, D(2024, 5, 2)]), DAY, ["ivr"], "b")
    append_run(spark, root, present(spark, ivr=True), report(spark, "ivr", True), D(2024, 6, 1), ["ivr"], "c")
    rows = {r.execution_date: r for r in fold_log(read_log(spark, root)).collect()}
    first = rows[DAY]
    assert (first.ivr_available, first.sms_web_relational_available) == (False, True)
    assert first.dates_processed == [DAY, D(2024, 5, 2)] and len(first.source_new_records) == 2
    assert rows[D(2024, 6, 1)].ivr_available


def test_a_repeated_run_counts_once(spark):
    root = scratch_path(spark, "log")
    for found in (True, False):
        append_run(spark, root, present(spark, ivr=found), report(spark, "ivr", found), DAY, ["ivr"], "same")
    row = fold_log(read_log(spark, root)).first()
    assert row.ivr_available is False and [r.new_records_found for r in row.source_new_records] == [False]


# --- batch ledger ----------------------------------------------------------------------------

NOW = datetime(2024, 5, 1, 12)


def ids(df):
    return sorted(r.record_id for r in df.collect())


def test_ledger_over_three_runs(spark):
    low = spark.createDataFrame([(i,) for i in range(10)], "record_id long")
    batches = low.withColumn("batch_index", F.expr("record_id div 3"))
    none = spark.createDataFrame([], "record_id string, state string")
    assert ids(next_batches(low, none)) == list(range(10))
    first = sent_events(batches, "run-1", NOW - timedelta(hours=30))
    answers = answered_events(batches.filter("batch_index = 0"), "run-1", NOW - timedelta(hours=29))
    recent = sent_events(batches.filter("batch_index = 1"), "run-2", NOW - timedelta(hours=2))
    states = record_states(first.unionByName(answers).unionByName(recent), NOW)
    got = {r.record_id: (r.state, r.times_sent) for r in states.collect()}
    assert got == {
        **{str(i): ("answered", 1) for i in (0, 1, 2)}, **{str(i): ("sent", 2) for i in (3, 4, 5)},
        **{str(i): ("expired", 1) for i in (6, 7, 8, 9)},
    }
    more = low.unionByName(spark.createDataFrame([(77,)], "record_id long"))
    assert ids(next_batches(more, states)) == [6, 7, 8, 9, 77]
    assert ids(next_batches(more, states, retry_expired=False)) == [77]
    assert {r.state: r.records for r in ledger_summary(more, states).collect()} == {"answered": 3, "sent": 3, "expired": 4, "open": 1}


def test_a_late_answer_settles_and_equal_times_favour_the_answer(spark):
    one = spark.createDataFrame([(1, 0)], "record_id long, batch_index long")
    late = sent_events(one, "a", NOW - timedelta(days=3)).unionByName(answered_events(one, "a", NOW - timedelta(days=2)))
    again = late.unionByName(sent_events(one, "b", NOW - timedelta(days=1)))
    assert record_states(again, NOW).first().state == "answered"
    tie = sent_events(one, "a", NOW).unionByName(answered_events(one, "a", NOW))
    assert record_states(tie, NOW).first().state == "answered"
