"""Writers and the daily run, end to end on files: results, re-runs and failures."""

from __future__ import annotations

import csv
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.adapters import SPECS, intent_map, raw_channels
from surveylake.channels import CHANNEL_NAMES
from surveylake.plans.daily import Catalog, run_daily
from surveylake.plans.text_run import corrected_dashboards, final_output, prepare
from surveylake.schemas import TRACKER, curated_schema
from surveylake.session import scratch_path
from surveylake.sinks.objects import copy_failures, copy_objects, copy_report
from surveylake.sinks.tables import (
    export_csv,
    load_reporting,
    load_status,
    overwrite_partitions,
    replace_partitions,
    reporting_column_types,
    write_parts,
    write_removed_csv,
)
from surveylake.sinks.tracker import channel_gate, lookup_status, merge_tracker, scoring_order
from surveylake.sources.objects import list_objects
from surveylake.sources.tables import latest_partition, requested_dates, resolve_dates, scan_partition, scan_table

AS_OF = date(2024, 1, 31)
WEEKS = [date(2024, 1, d) for d in (1, 8, 15, 22, 29)]


@pytest.fixture(scope="module")
def catalog(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for name, df in raw_channels(spark, small).items():
        # An extra column no specification knows must reach the final table.
        df.withColumn("agent_id", F.lit("x")).write.partitionBy("event_date").parquet(f"{root}/curated/{name}")
    intent_map(spark, small).write.option("header", True).csv(f"{root}/lookup")
    control = ", ".join(f'"{d}"' for d in WEEKS)
    (root / "event_dates.json").write_text('{"2024-01-30": "2024-01-01",\n "2024-01-31": [' + control + "]}")
    return Catalog(f"{root}/curated", f"{root}/out", f"{root}/lookup", f"{root}/event_dates.json")


def snapshot(spark, catalog):
    tables = {}
    for table in ("final", "daily_scores"):
        for name in CHANNEL_NAMES:
            df = spark.read.parquet(catalog.path(table, name))
            tables[table, name] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
    for name in CHANNEL_NAMES:
        removed = spark.read.option("header", True).csv(catalog.path("removed_records", name))
        tables["removed", name] = sorted(map(str, removed.collect()))
    return tables


def test_daily_run(spark, small, catalog):
    report = run_daily(spark, catalog, AS_OF)
    assert report.count() == 5 * len(WEEKS)
    assert report.filter(~F.col("new_records_found")).count() == 0
    for name, raw in raw_channels(spark, small).items():
        final = spark.read.parquet(catalog.path("final", name))
        removed = spark.read.option("header", True).csv(catalog.path("removed_records", name))
        assert final.count() + removed.count() == raw.count()
        assert "new_intent" not in final.columns and "agent_id" in final.columns
        aggregate = spark.read.parquet(catalog.path("aggregate", name)).first()
        assert aggregate.event_start_date == WEEKS[0] and aggregate.calculated_date == AS_OF
        assert not spark.read.parquet(catalog.path("monthly_yago", name)).isEmpty()
    tracker = scan_table(spark, catalog.tracker, TRACKER).first()
    assert tracker.ivr_available and tracker.dates_processed == WEEKS and len(tracker.source_new_records) == 25

    first = snapshot(spark, catalog)
    again = run_daily(spark, catalog, AS_OF)
    assert again.filter("new_records_found").count() == 0
    assert snapshot(spark, catalog) == first


def test_partial_run_touches_only_its_channel(spark, catalog):
    before = scan_table(spark, catalog.tracker, TRACKER).first()
    missing = date(2030, 1, 1)
    report = run_daily(spark, catalog, AS_OF, [missing], ["ivr"]).collect()
    assert [(r.channel, r.new_count, r.new_records_found) for r in report] == [("ivr", 0, False)]
    after = scan_table(spark, catalog.tracker, TRACKER).first()
    assert before.ivr_available and not after.ivr_available
    assert after.sms_web_relational_available == before.sms_web_relational_available
    assert after.dates_processed == [missing]


def test_control_file(spark, catalog, tmp_path):
    assert sorted(requested_dates(spark, catalog.control)) == WEEKS
    (tmp_path / "one.json").write_text('{"k1": ["2026-01-01"], "k2": "2026-02-03"}')
    assert [r.event_date for r in resolve_dates(spark, str(tmp_path / "one.json")).collect()] == [date(2026, 2, 3)]


def test_scan_reads_only_existing_dates(spark, catalog):
    schema = curated_schema(SPECS["ivr"])
    root = catalog.curated_path("ivr")
    some = scan_partition(spark, root, [WEEKS[0], date(2030, 1, 1)], schema)
    assert [r.event_date for r in some.select("event_date").distinct().collect()] == [WEEKS[0]]
    assert scan_partition(spark, root, [date(2030, 1, 1)], schema).schema == schema
    assert scan_table(spark, f"{root}-absent", schema).count() == 0
    broken = Path(root).parent / "broken"
    broken.mkdir()
    (broken / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        scan_table(spark, str(broken), schema).count()


def test_overwrite_replaces_only_its_partitions(spark):
    root = scratch_path(spark, "t")
    schema = "event_date date, v int"
    a, b = date(2026, 1, 1), date(2026, 1, 2)
    overwrite_partitions(spark.createDataFrame([(a, 1), (a, 2), (b, 3)], schema), root)
    for _ in range(2):
        overwrite_partitions(spark.createDataFrame([(a, 9)], schema), root)
    rows = spark.read.schema(schema).parquet(root).collect()
    assert sorted((r.event_date, r.v) for r in rows) == [(a, 9), (b, 3)]
    replace_partitions(spark.createDataFrame([(a, 7)], schema), root, [a, b])
    assert [(r.event_date, r.v) for r in spark.read.schema(schema).parquet(root).collect()] == [(a, 7)]


def test_csv_keeps_texts(spark, tmp_path):
    texts = ["a,b", "  lead and trail  ", 'says "no"', "two\nlines", "back\\slash", ' "', None]
    df = spark.createDataFrame(list(enumerate(texts)), "x int, s string")
    source, target = f"{tmp_path}/out.parquet", f"{tmp_path}/csv"
    for _ in range(2):
        write_parts(df, source)
    assert export_csv(spark, source, target) == (len(texts), 2)
    rows = []
    for part in Path(target).glob("part-*.csv"):
        with open(part, newline="") as handle:
            rows += list(csv.reader(handle))[1:]
    assert sorted(rows) == [[str(i), t or ""] for i, t in enumerate(texts)]


def test_removed_csv_keeps_other_dates(spark):
    root = scratch_path(spark, "removed")
    schema = "removed_date date, contact_record_id string"
    write_removed_csv(spark.createDataFrame([(date(2026, 1, 1), "1"), (date(2026, 1, 2), "2")], schema), root)
    write_removed_csv(spark.createDataFrame([(date(2026, 1, 2), "3")], schema), root)
    rows = spark.read.option("header", True).csv(root).collect()
    assert sorted(r.contact_record_id for r in rows) == ["1", "3"]


def test_reporting_load_reports_each_table(spark):
    good, bad = spark.range(3), spark.range(2)

    def write(df, schema, table):
        if table == "bad":
            raise OSError("refused")
        df.write.format("noop").mode("overwrite").save()

    results = load_reporting(spark, {("s", "good"): good, ("s", "bad"): bad}, write)
    assert {(r.table, r.rows_loaded, r.status) for r in results.collect()} == {("good", 3, "SUCCESS"), ("bad", 0, "FAILED")}
    assert load_status(results).first().lookup_status == "FAILED"
    assert load_status(results.filter("status = 'SUCCESS'")).first().lookup_status == "SUCCESS"


def test_reporting_types(spark):
    df = spark.sql("select true b, 1 i, 1L l, 1.0d d, current_timestamp() t, current_date() a, 'x' s")
    assert reporting_column_types(df) == (
        "`b` BOOLEAN, `i` BIGINT, `l` BIGINT, `d` DOUBLE, `t` TIMESTAMP, `a` DATE"
    )
    odd = df.select(F.col("i").alias("a `b` c"))
    for frame in (df, odd):
        assert set(StructType.fromDDL(reporting_column_types(frame)).names) <= set(frame.columns)


def test_gate_without_tracker_row(spark):
    empty = spark.createDataFrame([], TRACKER)
    gate = {r.channel: (r.available, r.run) for r in channel_gate(empty, scoring_order(spark), AS_OF).collect()}
    assert gate["ivr"] == (False, True) and gate["sms_relational"] == (False, False) and len(gate) == 5
    assert lookup_status(empty, AS_OF).first().lookup_status == "NOT_FOUND"


def test_tracker_merge_keeps_unset_flags(spark):
    state = spark.createDataFrame([(AS_OF, True, True, None, None, None, [AS_OF], [])], TRACKER)
    update = spark.createDataFrame([(AS_OF, False)], "execution_date date, ivr_available boolean")
    row = merge_tracker(state, update).first()
    assert (row.ivr_available, row.sms_web_transactional_available, row.dates_processed) == (False, True, [AS_OF])
    assert lookup_status(state, AS_OF).first().lookup_status == "FOUND"


def test_copy_lists_hidden_files_and_reports_failures(spark, tmp_path):
    source, target = tmp_path / "src", tmp_path / "dst"
    (source / "a" / "deep" / "er").mkdir(parents=True)
    (source / "empty").mkdir()
    for name, text in {"a/one": "1", "a/_SUCCESS": "", "a/deep/er/.hid": "22", "a/deep/two": "333"}.items():
        (source / name).write_text(text)
    target.mkdir()
    inventory = list_objects(spark, f"file://{source}", ["a", "a/deep", "empty", "absent"], partitions=2)
    listed = sorted((r.prefix, r.path, r.length) for r in inventory.collect())
    assert listed == [
        ("a", "a/_SUCCESS", 0), ("a", "a/deep/er/.hid", 2), ("a", "a/deep/two", 3), ("a", "a/one", 1),
        ("a/deep", "a/deep/er/.hid", 2), ("a/deep", "a/deep/two", 3),
    ]
    dry = copy_objects(inventory, f"file://{source}", f"file://{target}", 2, dry_run=True)
    assert dry.filter("ok").count() == 6 and not list(target.iterdir())
    ghost = spark.createDataFrame([("a", "a/ghost", 5)], inventory.schema)
    outcome = scratch_path(spark, "outcome")
    copy_objects(inventory.union(ghost), f"file://{source}", f"file://{target}", 2).write.parquet(outcome)
    results = spark.read.parquet(outcome)
    report = {r.prefix: (r.objects, r.succeeded, r.failed) for r in copy_report(results).collect()}
    assert report == {"a": (5, 4, 1), "a/deep": (2, 2, 0)}
    assert [r.failed_key for r in copy_failures(results).collect()] == ["a/ghost"]
    copied = {str(p.relative_to(target)): p.read_text() for p in target.rglob("*") if p.is_file()}
    assert copied == {"a/one": "1", "a/_SUCCESS": "", "a/deep/er/.hid": "22", "a/deep/two": "333"}


def test_latest_partition(spark, tmp_path):
    for value in ("2024-01-09", "2024-01-10"):
        (tmp_path / f"insert_date={value}").mkdir()
    (tmp_path / "other=9").mkdir()
    assert latest_partition(spark, str(tmp_path)) == "2024-01-10"
    assert latest_partition(spark, str(tmp_path / "none")) is None


def test_text_run_pieces(spark, small):
    spec = SPECS["sms_relational"]
    raw = raw_channels(spark, small)["sms_relational"]
    texts = prepare(raw, spec)
    assert texts.filter("model_family <> 'sms_web'").count() == 0
    assert texts.count() == raw.filter(F.col("q5_comment_sms").isNotNull()).count()
    topics = "overall_sentiment level2_category level3_subcategory level4_team is_actionable is_urgent".split()
    scored = texts.select("record_id", *[F.lit("p").alias(t) for t in topics])
    output = final_output(raw, scored)
    assert output.count() == raw.count()
    one = texts.limit(1).select(F.col("record_id").alias("contact_record_id"), F.lit(0).alias("batch_index"))
    every, trimmed = corrected_dashboards(output, one.withColumn("is_urgent", F.lit("yes")), "contact_record_id")
    assert every.filter("is_urgent = 'yes'").count() == 1 and trimmed.columns == ["contact_record_id", *topics]


def test_load_modes(spark):
    from surveylake.operators.incremental import rows_to_load

    days = [date(2026, 1, d) for d in (1, 2, 3)]
    source = spark.createDataFrame([(d,) for d in days], "event_date date")
    loaded = source.filter(F.col("event_date") == days[0])
    assert rows_to_load(source, loaded).count() == 2
    assert rows_to_load(source, loaded, "APPEND_MISSING", days[:2]).count() == 1
    assert rows_to_load(source, loaded, "FULL_REPLACE").count() == 3
    with pytest.raises(ValueError):
        rows_to_load(source, loaded, "OTHER")


def test_training_run_moves_its_baseline(spark, small):
    from checks.adapters import texts
    from surveylake.operators.scoring import TOPICS
    from surveylake.plans.training_run import last_trained_count, run_training

    folder = scratch_path(spark, "training")
    base = texts(spark, small).filter("labelled").select("record_id", "text", "channel", *TOPICS)
    base = base.withColumn("is_synthetic", F.lit(False))
    corrected = base.filter("is_actionable = 'true'")
    n = corrected.count()
    gate, metrics = run_training(spark, base, corrected, folder, minimum=n + 1)
    assert gate.first().instruction == "SKIP" and metrics is None
    gate, metrics = run_training(spark, base, corrected, folder, minimum=n)
    assert gate.first().should_train and metrics.filter("topic = 'is_actionable'").count() == 2
    assert last_trained_count(spark, f"{folder}/training_record_baseline") == n
    gate, _ = run_training(spark, base, corrected, folder, minimum=1)
    assert gate.first().new_records_since_training == 0 and gate.first().instruction == "SKIP"


def test_date_emptied_by_a_later_run_loses_its_partition(spark):
    root = scratch_path(spark, "emptied")
    schema = "event_date date, campaign string, v int"
    day = date(2026, 1, 1)
    replace_partitions(spark.createDataFrame([(day, "Main", 1)], schema), root, [day])
    assert spark.read.schema(schema).parquet(root).count() == 1
    from surveylake.functions.grouping import keep_first

    gone = spark.createDataFrame([(day, "Other", 1)], schema).filter("campaign = 'Main'")
    replace_partitions(keep_first(gone, ["event_date"], F.struct("v")), root, [day])
    assert not Path(f"{root.removeprefix('file:')}/event_date={day}").exists()
