"""The daily run: curated channels to final tables, reports, rollups and tracker.

Every requested date of a channel goes through one lazy plan; the actions are
the writes. Counts, daily scores and rollups come from the stored states of the
final tables, so a run reads no date of the history but its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..channels import CHANNEL_NAMES, Channel, channel_specs
from ..operators.dedup import (
    dedup_by_comment,
    dedup_by_keys,
    dedup_report,
    dedup_responses,
    removed_by_comment,
    removed_by_keys,
)
from ..operators.intent import intent_match_rate, map_intent
from ..operators.normalize import comment_value, common_view, normalize
from ..operators.quality import CAMPAIGN_REASON, DEDUP_REASON, campaign_keep, campaign_removed, input_profile, removed_report
from ..operators.rollups import availability
from ..operators.states import content_check, cumulative_from_states, daily_from_states, monthly_from_states, score_states
from ..schemas import RUN_STATISTICS, curated_schema
from ..sinks.states import catch_up, stored_states, update_states
from ..sinks.tables import overwrite_partitions, replace_partitions, write_parts, write_removed_csv
from ..sinks.tracker import append_run, refresh_tracker
from ..sources.columns import scan_registered
from ..sources.tables import path_exists, requested_dates, scan_lookup_csv, scan_partition, scan_table


@dataclass(frozen=True)
class Catalog:
    """Where the tables live: one root for what is read, one for what is written."""

    curated: str
    output: str
    lookup: str
    control: str | None = None

    def curated_path(self, channel: str) -> str:
        return f"{self.curated}/{channel}"

    def path(self, table: str, channel: str) -> str:
        return f"{self.output}/{table}/{channel}"

    @property
    def tracker(self) -> str:
        return f"{self.output}/tracker"

    @property
    def run_log(self) -> str:
        return f"{self.output}/run_log"


def final_responses(raw: DataFrame, channel: Channel, lookup: DataFrame) -> DataFrame:
    """One channel's final table: campaign filter, normalization, intent, de-duplication."""
    main = campaign_keep(raw) if channel.campaign_filter else raw
    mapped = map_intent(normalize(main, channel), lookup)
    if channel.key_dedup:
        return dedup_by_keys(mapped)
    return dedup_by_comment(mapped, comment_value(mapped, channel))


def removed_responses(raw: DataFrame, channel: Channel) -> DataFrame:
    """Everything ``final_responses`` leaves out, with the reason.

    What is removed does not depend on scores or intents, so this reads only the
    key and report columns of the raw table.
    """
    main = campaign_keep(raw) if channel.campaign_filter else raw
    parts = []
    if channel.campaign_filter:
        parts.append((campaign_removed(raw), F.lit(CAMPAIGN_REASON)))
    if channel.key_dedup:
        parts.append((removed_by_keys(main), F.lit(DEDUP_REASON)))
    else:
        dropped = removed_by_comment(main, comment_value(main, channel))
        parts.append((dropped, F.col("removal_reason")))
    return removed_report(parts, F.lit(channel.survey_type), F.col("event_date"))


def unified_responses(raw: Mapping[str, DataFrame], specs: Mapping[str, Channel], lookup: DataFrame) -> DataFrame:
    """All channels as one de-duplicated common view, in one shuffle for all of them."""

    def view(name: str) -> DataFrame:
        main = campaign_keep(raw[name]) if specs[name].campaign_filter else raw[name]
        return common_view(normalize(main, specs[name]), specs[name])

    stacked = reduce(DataFrame.unionByName, [view(name) for name in raw])
    return dedup_responses(map_intent(stacked, lookup))


def final_states(spark: SparkSession, catalog: Catalog, channel: Channel, dates: list[date]) -> DataFrame:
    """States of these dates of a channel's stored final table, which must be there; the digests cover every column.

    Only the folders of these dates are listed and read.
    """
    final = scan_partition(spark, catalog.path("final", channel.name), dates, curated_schema(channel))
    scores = {f"q{i}": F.col(c) for i, c in enumerate(channel.score_columns, start=1)}
    named = final.withColumns({**scores, "channel": F.lit(channel.name)})
    return score_states(named, "channel", digest=final.columns)


def channel_states(spark: SparkSession, catalog: Catalog, channel: Channel) -> DataFrame | None:
    """The stored states in step with the channel's final table, or None when that has never been written."""
    root = catalog.path("final", channel.name)
    if not path_exists(spark, root):
        return None
    states = catalog.path("score_states", channel.name)
    catch_up(spark, root, states, lambda dates: final_states(spark, catalog, channel, dates))
    return stored_states(spark, states)


def scan_raw(spark: SparkSession, catalog: Catalog, channel: Channel, dates: Iterable[date]) -> DataFrame:
    """These dates of a channel's curated table; their columns come from the registry beside the output."""
    registry = catalog.path("column_registry", channel.name)
    return scan_registered(spark, catalog.curated_path(channel.name), dates, curated_schema(channel), registry)


def _received(raw: DataFrame, dates: list[date]) -> list[date]:
    """The requested dates that have rows: one value per date of the run."""
    if not dates:
        return []
    present = raw.filter(F.col("event_date").isin(dates)).select("event_date").distinct().collect()
    arrived = {row["event_date"] for row in present}
    return [d for d in dates if d in arrived]


def process_channel(
    spark: SparkSession, catalog: Catalog, channel: Channel, lookup: DataFrame, dates: list[date], as_of: date
) -> list[tuple]:
    """Write one channel's final, removed and daily-score tables; one report row per date."""
    name = channel.name
    raw = scan_raw(spark, catalog, channel, dates)
    states = catalog.path("score_states", name)
    known = channel_states(spark, catalog, channel)
    # The states before the run, as values: their files are about to be replaced. One row per date.
    columns = ["channel", "event_date", "rows", "digest_a", "digest_b"]
    old = known.filter(F.col("event_date").isin(dates)).select(*columns).collect() if known is not None and dates else []
    arrived = _received(raw, dates)
    if old:
        # Without a state a date counts as unknown: if this run breaks off, the next one makes the state anew.
        update_states(spark, states, known.limit(0), arrived)
    replace_partitions(final_responses(raw, channel, lookup), catalog.path("final", name), arrived)
    if arrived:
        write_removed_csv(removed_responses(raw, channel), catalog.path("removed_records", name), arrived)
        left = [d for d in arrived if path_exists(spark, f"{catalog.path('final', name)}/event_date={d}")]
        new = final_states(spark, catalog, channel, left) if left else stored_states(spark, states).limit(0)
        update_states(spark, states, new, arrived)
    run_states = stored_states(spark, states).filter(F.col("event_date").isin(arrived)) if arrived else None
    if run_states is not None and not run_states.isEmpty():
        overwrite_partitions(daily_from_states(run_states, as_of).drop("channel"), catalog.path("daily_scores", name))
    before = spark.createDataFrame(old, stored_states(spark, states).select(*columns).schema)
    now = run_states if run_states is not None else before.limit(0)
    checked = {row["event_date"]: row for row in content_check(now, before).collect()}
    report = []
    for day in dates:
        row = checked.get(day)
        counts = (row["new_count"], row["existing_count"]) if row else (0, 0)
        report.append((name, day, *counts, counts[0] > counts[1], bool(row and row["content_changed"] and day in arrived)))
    return report


def run_daily(
    spark: SparkSession,
    catalog: Catalog,
    as_of: date,
    dates: Iterable[date] | None = None,
    channels: Iterable[str] = CHANNEL_NAMES,
    specs: Mapping[str, Channel] | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Process the dates (by default those of the control file) for the given channels.

    Channels do not depend on each other, so their jobs are submitted side by
    side. Returns the new-records report. Running it again with the same input
    leaves every table as it was, but for one more entry in the run log.
    """
    specs = specs or channel_specs()
    dates = list(dates) if dates is not None else requested_dates(spark, catalog.control)
    channels = list(channels)
    lookup = scan_lookup_csv(spark, catalog.lookup)
    with ThreadPoolExecutor(max_workers=len(CHANNEL_NAMES)) as pool:
        done = pool.map(lambda n: process_channel(spark, catalog, specs[n], lookup, dates, as_of), channels)
        report = [row for rows in done for row in rows]
    write_rollups(spark, catalog, specs, as_of)
    write_statistics(spark, catalog, specs, dates, channels)
    new_records = spark.createDataFrame(
        report,
        "channel string, event_date date, new_count bigint, existing_count bigint, new_records_found boolean,"
        " content_changed boolean",
    )
    present = run_availability(new_records)
    append_run(spark, catalog.run_log, present, new_records, as_of, channels, run_id or uuid.uuid4().hex)
    refresh_tracker(spark, catalog.run_log, catalog.tracker, as_of)
    return new_records


def channel_statistics(raw: DataFrame, channel: Channel, lookup: DataFrame) -> DataFrame:
    """Input profile, intent match rate and, where a channel is de-duplicated by comment, the de-duplication report, per date."""
    main = campaign_keep(raw) if channel.campaign_filter else raw
    parts = [input_profile(raw, channel, "event_date")]
    if not channel.campaign_filter:
        # Without the filter nothing is removed by campaign, whatever the column holds.
        none_removed = {"campaign_removed": F.lit(0).cast("long"), "passed": F.col("received")}
        parts = [parts[0].withColumns(none_removed)]
    parts.append(intent_match_rate(main, lookup, "event_date"))
    if not channel.key_dedup:
        parts.append(dedup_report(main, comment_value(main, channel)))
    joined = reduce(lambda a, b: a.join(b, "event_date", "left"), parts)
    there = set(joined.columns)
    return joined.select(
        *[
            F.lit(channel.name).alias("channel") if f.name == "channel"
            else (F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RUN_STATISTICS.fields
        ]
    )


def write_statistics(
    spark: SparkSession, catalog: Catalog, specs: Mapping[str, Channel], dates: Iterable[date], channels: Iterable[str] = CHANNEL_NAMES
) -> None:
    """Store the statistics of these dates, a partition per date; dates without raw rows lose theirs."""
    lookup, dates = scan_lookup_csv(spark, catalog.lookup), list(dates)

    def write(name: str) -> None:
        raw = scan_raw(spark, catalog, specs[name], dates)
        found = channel_statistics(raw, specs[name], lookup)
        replace_partitions(found, catalog.path("run_statistics", name), dates)

    with ThreadPoolExecutor(max_workers=len(CHANNEL_NAMES)) as pool:
        list(pool.map(write, channels))


def read_statistics(spark: SparkSession, catalog: Catalog, channels: Iterable[str] = CHANNEL_NAMES) -> DataFrame:
    """The stored statistics of all dates of the channels."""
    parts = [scan_table(spark, catalog.path("run_statistics", name), RUN_STATISTICS) for name in channels]
    return reduce(DataFrame.unionByName, parts)


def run_availability(new_records: DataFrame) -> DataFrame:
    """A channel is available when any date of the run left rows."""
    present = new_records.filter(F.col("new_count") > 0)
    return availability(present, new_records.select("channel").distinct())


def write_rollups(spark: SparkSession, catalog: Catalog, specs: Mapping[str, Channel], as_of: date) -> None:
    """Cumulative and monthly scores of every channel with history, whatever this run processed, from its states."""

    def write(spec: Channel) -> None:
        states = channel_states(spark, catalog, spec)
        if states is not None:
            write_parts(cumulative_from_states(states, as_of), catalog.path("aggregate", spec.name))
            write_parts(monthly_from_states(states, as_of), catalog.path("monthly_yago", spec.name))

    with ThreadPoolExecutor(max_workers=len(CHANNEL_NAMES)) as pool:
        list(pool.map(write, specs.values()))
