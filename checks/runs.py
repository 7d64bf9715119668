"""Queries that run the plans on stored tables and read back what they wrote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.channels import CHANNEL_NAMES
from surveylake.plans.daily import Catalog, read_statistics, run_daily
from surveylake.plans.enrichment import ReferencePaths, run_enrichment
from surveylake.session import scratch_path
from surveylake.sinks.tables import overwrite_partitions
from surveylake.sources.columns import scan_registered

from .adapters import (
    INTENT_MAP_SQL,
    MAPPED_SQL,
    RESPONSES_SQL,
    RUN_DATE,
    SNAPSHOTS_SQL,
    SPECS,
    account_snapshots,
    arrears_snapshots,
    intent_map,
    raw_channels,
    responses,
)
from .registry import query
from .responses import COMMENT_RANK_SQL
from .rollups import FINAL_CTE


def _lake(spark, folder) -> tuple[Catalog, list]:
    """The raw channels written by date, the lookup beside them; their catalog and all dates (the calendar)."""
    root = scratch_path(spark, "lake")
    for name, raw in raw_channels(spark, folder).items():
        # The identity columns as the declared schema has them.
        typed = raw.withColumns({c: F.col(c).cast("timestamp") for c in ("event_ts", "queue_time")})
        overwrite_partitions(typed, f"{root}/curated/{name}")
    written = intent_map(spark, folder).write.option("header", True).option("quoteAll", True)
    written.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/lookup")
    days = sorted(r.event_date for r in responses(spark, folder).select("event_date").distinct().collect())
    return Catalog(f"{root}/curated", f"{root}/out", f"{root}/lookup"), days


@query(
    "run_statistics",
    f"""WITH {RESPONSES_SQL}, {INTENT_MAP_SQL}, {MAPPED_SQL}, {COMMENT_RANK_SQL},
    profile AS (
      SELECT channel, event_date, count(*) AS received, count(comment) AS with_verbatim,
             count(*) FILTER (WHERE channel = 'ivr' AND campaign IS DISTINCT FROM 'Main') AS campaign_removed,
             count(*) FILTER (WHERE channel <> 'ivr' OR campaign = 'Main') AS passed
      FROM responses GROUP BY ALL),
    matched AS (
      SELECT channel, event_date, count(*) AS total_count, count(mapped_intent) AS matched_count,
             count(*) - count(mapped_intent) AS unmatched_count,
             round(count(mapped_intent) * 100.0 / count(*), 6)::DOUBLE AS match_rate
      FROM mapped WHERE channel <> 'ivr' OR campaign = 'Main' GROUP BY ALL),
    cases AS (
      SELECT channel, event_date,
             count(*) FILTER (WHERE removal_reason = 'DEDUP_CASE_1') AS case_1,
             count(*) FILTER (WHERE removal_reason = 'DEDUP_CASE_2') AS case_2,
             count(*) FILTER (WHERE removal_reason = 'DEDUP_CASE_3') AS case_3
      FROM comment_removed WHERE channel <> 'ivr' GROUP BY ALL),
    sizes AS (
      SELECT channel, event_date, count(*) AS total_before, count(comment) AS with_comment,
             count(*) - count(comment) AS without_comment, count(*) FILTER (WHERE rn = 1) AS total_after
      FROM comment_ranked WHERE channel <> 'ivr' GROUP BY ALL)
    SELECT p.*, m.* EXCLUDE (channel, event_date), s.* EXCLUDE (channel, event_date),
           CASE WHEN s.channel IS NOT NULL THEN coalesce(case_1, 0) END AS case_1,
           CASE WHEN s.channel IS NOT NULL THEN coalesce(case_2, 0) END AS case_2,
           CASE WHEN s.channel IS NOT NULL THEN coalesce(case_3, 0) END AS case_3
    FROM profile p LEFT JOIN matched m USING (channel, event_date)
         LEFT JOIN sizes s USING (channel, event_date) LEFT JOIN cases c USING (channel, event_date)""",
)
def _run_statistics(spark, folder):
    """What a stored run says of its input, per channel and date."""
    catalog, days = _lake(spark, folder)
    run_daily(spark, catalog, RUN_DATE, days, specs=SPECS)
    return read_statistics(spark, catalog).withColumn("match_rate", F.round("match_rate", 6))


@query(
    "run_enrichment",
    f"""{FINAL_CTE}, {SNAPSHOTS_SQL}
    SELECT channel, event_date, contact_record_id, l.current_balance AS arrears_current_balance,
           CAST(l.nation AS VARCHAR) AS cas_division
    FROM final f LEFT JOIN latest l ON f.cas_account_number = CAST(l.account_number AS VARCHAR)""",
)
def _run_enrichment(spark, folder):
    """A stored run, then the enrichment from stored snapshots of two references; the third isn't there."""
    catalog, days = _lake(spark, folder)
    run_daily(spark, catalog, RUN_DATE, days, specs=SPECS)
    root = scratch_path(spark, "references")
    overwrite_partitions(arrears_snapshots(spark, folder), f"{root}/arrears", ["insert_date"])
    overwrite_partitions(account_snapshots(spark, folder), f"{root}/accounts", ["insert_date"])
    run_enrichment(spark, catalog, ReferencePaths(f"{root}/arrears", f"{root}/accounts", f"{root}/outages"), days, SPECS)
    columns = ("event_date", "contact_record_id", "arrears_current_balance", "cas_division")
    parts = [
        spark.read.parquet(catalog.path("enriched", name)).select(F.lit(name).alias("channel"), *columns)
        for name in CHANNEL_NAMES
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "scan_registered",
    f"""WITH {RESPONSES_SQL}
    SELECT event_date, channel, contact_record_id, comment,
           CASE WHEN event_date >= DATE '2024-01-15' THEN q3 END AS q3
    FROM responses WHERE event_date <> DATE '2024-01-08'""",
)
def _scan_registered(spark, folder):
    """A table whose later dates have one column more, read by its registry: first some dates, then all but one."""
    root, registry = scratch_path(spark, "curated"), scratch_path(spark, "columns")
    r = responses(spark, folder).select("event_date", "channel", "contact_record_id", "comment", "q3")
    late = F.col("event_date") >= F.lit("2024-01-15").cast("date")
    overwrite_partitions(r.filter(~late).drop("q3"), root)
    overwrite_partitions(r.filter(late), root)
    days = [str(d.event_date) for d in r.select("event_date").distinct().collect()]
    scan_registered(spark, root, days[:2], r.schema, registry)
    wanted = sorted(d for d in days if d != "2024-01-08")
    return scan_registered(spark, root, wanted, r.schema, registry).select(*r.columns)
