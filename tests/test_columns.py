"""The registry of a table's columns by date, run statistics and the enrichment run on small stored tables."""

from __future__ import annotations

import os
from datetime import date
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructType

from checks.adapters import SPECS, intent_map, raw_channels
from surveylake.operators.enrich import ACCOUNT_COLUMNS, ARREARS_COLUMNS
from surveylake.plans.daily import Catalog, process_channel, read_statistics, write_statistics
from surveylake.plans.enrichment import ReferencePaths, run_enrichment
from surveylake.schemas import DATE_COLUMNS
from surveylake.sinks.tables import overwrite_partitions
from surveylake.sources.columns import scan_registered
from surveylake.sources.tables import scan_lookup_csv, scan_partition

SCHEMA = StructType().add("id", LongType()).add("campaign", StringType()).add("event_date", DateType())
EARLY, LATE = "2024-01-01", "2024-02-01"


@pytest.fixture
def stored(spark, tmp_path):
    """One date without `campaign`, one with it."""
    root = str(tmp_path / "t")
    rows = spark.range(6).withColumn("event_date", F.lit(EARLY).cast("date"))
    overwrite_partitions(rows, root)
    overwrite_partitions(rows.withColumn("campaign", F.lit("Main")).withColumn("event_date", F.lit(LATE).cast("date")), root)
    return root, str(tmp_path / "columns")


def spoil(folder):
    """Same names, sizes and times, no footer."""
    for file in Path(folder).rglob("*.parquet"):
        before = file.stat()
        file.write_bytes(b"\0" * before.st_size)
        os.utime(file, ns=(before.st_atime_ns, before.st_mtime_ns))
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def test_columns_of_the_dates_asked_for(spark, stored):
    root, registry = stored
    assert scan_registered(spark, root, [EARLY], SCHEMA, registry).columns == ["id", "event_date"]
    both = scan_registered(spark, root, [EARLY, LATE, "2030-01-01"], SCHEMA, registry)
    assert both.columns == ["id", "campaign", "event_date"] and both.schema["event_date"].dataType == DateType()
    assert {(r.event_date.month, r.campaign) for r in both.collect()} == {(1, None), (2, "Main")}
    assert sorted(map(str, both.collect())) == sorted(map(str, scan_partition(spark, root, [EARLY, LATE], SCHEMA).select(*both.columns).collect()))
    assert spark.read.schema(DATE_COLUMNS).parquet(registry).count() == 2
    nothing = scan_registered(spark, root, ["2030-01-01"], SCHEMA, registry)
    assert nothing.isEmpty() and nothing.schema == SCHEMA
    assert scan_registered(spark, f"{root}-none", [EARLY], SCHEMA, registry).isEmpty()


def test_known_dates_are_not_opened(spark, stored):
    root, registry = stored
    scan_registered(spark, root, [EARLY, LATE], SCHEMA, registry)
    spoil(f"{root}/event_date={LATE}")
    assert scan_registered(spark, root, [EARLY, LATE], SCHEMA, registry).columns == ["id", "campaign", "event_date"]
    with pytest.raises((Py4JJavaError, PySparkException), match="CANNOT_READ_FILE_FOOTER"):
        scan_partition(spark, root, [EARLY, LATE], SCHEMA).columns


def test_changed_dates_are_opened_again(spark, stored):
    root, registry = stored
    scan_registered(spark, root, [EARLY], SCHEMA, registry)
    rows = spark.range(3).withColumns({"note": F.lit("x"), "event_date": F.lit(EARLY).cast("date")})
    overwrite_partitions(rows, root)
    again = scan_registered(spark, root, [EARLY], SCHEMA, registry)
    assert again.columns == ["id", "note", "event_date"] and again.count() == 3
    assert spark.read.schema(DATE_COLUMNS).parquet(registry).count() == 2


def test_a_column_of_two_types_names_its_dates(spark, stored):
    root, registry = stored
    rows = spark.range(1).select(F.col("id").cast("string"), F.lit(EARLY).cast("date").alias("event_date"))
    overwrite_partitions(rows, root)
    with pytest.raises(ValueError, match=f"id is string on {EARLY} and bigint on {LATE}"):
        scan_registered(spark, root, [EARLY, LATE], SCHEMA, registry)


@pytest.fixture(scope="module")
def lake(spark, small, tmp_path_factory):
    """Final tables of one channel on two dates."""
    root, days = tmp_path_factory.mktemp("lake"), [date(2024, 1, 8), date(2024, 1, 22)]
    raw = raw_channels(spark, small)["sms_relational"].filter(F.col("event_date").isin(days))
    raw.write.partitionBy("event_date").parquet(f"{root}/curated/sms_relational")
    intent_map(spark, small).write.option("header", True).csv(f"{root}/lookup")
    catalog = Catalog(f"{root}/curated", f"{root}/out", f"{root}/lookup")
    process_channel(spark, catalog, SPECS["sms_relational"], scan_lookup_csv(spark, catalog.lookup), days, days[1])
    return catalog, days


def test_statistics_of_a_date_are_replaced(spark, lake):
    catalog, days = lake
    for _ in range(2):
        write_statistics(spark, catalog, SPECS, days, ["sms_relational"])
    rows = {r.event_date: r for r in read_statistics(spark, catalog, ["sms_relational"]).collect()}
    raw = spark.read.parquet(catalog.curated_path("sms_relational"))
    assert {d: r.received for d, r in rows.items()} == {d: raw.filter(F.col("event_date") == d).count() for d in days}
    assert all(r.passed == r.received == r.total_before and r.campaign_removed == 0 for r in rows.values())
    # A date asked for that has no raw rows keeps no statistics and harms no other.
    write_statistics(spark, catalog, SPECS, [date(2030, 1, 1)], ["sms_relational"])
    assert read_statistics(spark, catalog, ["sms_relational", "ivr"]).count() == 2


def test_enrichment_run_without_references(spark, lake, tmp_path):
    catalog, days = lake
    done = run_enrichment(spark, catalog, ReferencePaths(str(tmp_path / "none")), days, SPECS, ["sms_relational", "ivr"])
    assert done == {"sms_relational": True, "ivr": False}
    final, enriched = (spark.read.parquet(catalog.path(t, "sms_relational")) for t in ("final", "enriched"))
    assert enriched.count() == final.count() and sorted(enriched.columns) == sorted(final.columns)


def test_enrichment_run_reads_the_latest_snapshot_only(spark, lake, tmp_path):
    catalog, days = lake
    final = spark.read.parquet(catalog.path("final", "sms_relational"))
    accounts = final.select(F.col("cas_account_number").alias("account_number")).distinct().dropna()
    for day, value in (("2024-01-01", "old"), ("2024-02-01", "new")):
        row = accounts.withColumns({c: F.lit(value) for c in ACCOUNT_COLUMNS} | {"insert_date": F.lit(day).cast("date")})
        overwrite_partitions(row, str(tmp_path / "accounts"), ["insert_date"])
    spoil(tmp_path / "accounts" / "insert_date=2024-01-01")
    paths = ReferencePaths(None, str(tmp_path / "accounts"), str(tmp_path / "none"))
    run_enrichment(spark, catalog, paths, days, SPECS, ["sms_relational"])
    enriched = spark.read.parquet(catalog.path("enriched", "sms_relational"))
    assert enriched.count() == final.count()
    assert {r.cas_division for r in enriched.filter("cas_account_number IS NOT NULL").collect()} == {"new"}
    assert not set(ARREARS_COLUMNS.values()) & set(enriched.columns)
