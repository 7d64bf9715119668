"""Enrichment of final responses with account reference data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import (
    ACCOUNT_COLUMNS,
    ARREARS_COLUMNS,
    OUTAGE_COLUMNS,
    combine_references,
    enrich,
    latest_snapshot,
    reference_columns,
)
from ..channels import CHANNEL_NAMES
from ..schemas import curated_schema
from ..sinks.tables import overwrite_partitions
from ..sources.columns import scan_registered
from ..sources.tables import latest_partition, path_exists
from .daily import Catalog


def account_reference(
    arrears: DataFrame | None, accounts: DataFrame | None, outages: DataFrame | None, on_duplicate: str = "raise"
) -> DataFrame | None:
    """The references that exist, latest snapshots only, one row per account."""
    parts = []
    if arrears is not None:
        parts.append(reference_columns(latest_snapshot(arrears), ARREARS_COLUMNS, on_duplicate=on_duplicate))
    if accounts is not None:
        parts.append(reference_columns(latest_snapshot(accounts), ACCOUNT_COLUMNS, on_duplicate=on_duplicate))
    if outages is not None:
        parts.append(reference_columns(outages, OUTAGE_COLUMNS, on_duplicate=on_duplicate))
    return combine_references(parts) if parts else None


def enriched_responses(
    final: DataFrame, reference: DataFrame | None, batch: Sequence[str] = ("event_date",)
) -> DataFrame:
    """Final responses with all reference columns, shuffled once for all references.

    A reference of which the responses already have a column is left out; the others are added.
    """
    if reference is None:
        return final
    present = [set(columns.values()) for columns in (ARREARS_COLUMNS, ACCOUNT_COLUMNS, OUTAGE_COLUMNS)]
    there = set().union(*(added for added in present if added & set(final.columns)))
    missing = reference.drop(*there)
    return enrich(final, missing, batch=batch) if len(missing.columns) > 1 else final


@dataclass(frozen=True)
class ReferencePaths:
    """Where the references lie: snapshot tables by ``insert_date`` for the first two, a flat table for the outages."""

    arrears: str | None = None
    accounts: str | None = None
    outages: str | None = None


def read_snapshot(spark: SparkSession, root: str | None, key: str = "insert_date") -> DataFrame | None:
    """The latest snapshot folder of a reference, all of its columns; None for no path, no folder or no snapshot.

    Only the folder names are listed to find it, and only that folder is read.
    """
    latest = latest_partition(spark, root, key) if root else None
    if latest is None:
        return None
    return spark.read.option("basePath", root).parquet(f"{root}/{key}={latest}")


def stored_reference(spark: SparkSession, paths: ReferencePaths, on_duplicate: str = "raise") -> DataFrame | None:
    """One row per account from the references that are there."""
    flat = spark.read.parquet(paths.outages) if paths.outages and path_exists(spark, paths.outages) else None
    return account_reference(read_snapshot(spark, paths.arrears), read_snapshot(spark, paths.accounts), flat, on_duplicate)


def run_enrichment(
    spark: SparkSession,
    catalog: Catalog,
    paths: ReferencePaths,
    dates: Iterable[date],
    specs,
    channels: Iterable[str] = CHANNEL_NAMES,
) -> dict[str, bool]:
    """Read the final tables of these dates, add the references that are there and write `enriched`; which channels had rows.

    A missing reference, or a channel without these dates, is left out; any other read error is raised. Running it again
    with the same input gives the same tables.
    """
    reference, days = stored_reference(spark, paths), list(dates)

    def write(name: str) -> bool:
        root, schema = catalog.path("final", name), curated_schema(specs[name])
        if not path_exists(spark, root):
            return False
        final = scan_registered(spark, root, days, schema, catalog.path("final_columns", name))
        if final.isEmpty():
            return False
        write_enriched(enriched_responses(final, reference), catalog.path("enriched", name))
        return True

    names = list(channels)
    with ThreadPoolExecutor(max_workers=len(CHANNEL_NAMES)) as pool:
        return dict(zip(names, pool.map(write, names)))


def write_enriched(enriched: DataFrame, root: str) -> None:
    overwrite_partitions(enriched, root)
