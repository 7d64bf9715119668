"""Loading what is not loaded yet."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import only_dates


APPEND_MISSING = "APPEND_MISSING"
FULL_REPLACE = "FULL_REPLACE"


def append_missing(source: DataFrame, loaded: DataFrame, grain: str = "event_date") -> DataFrame:
    """Source rows whose date, or record id, is not loaded.

    At date grain the loaded side is one row per calendar date, small however
    large the tables, and is broadcast; rows arriving late for a loaded date are
    missed. Record grain finds them at the price of comparing ids. [The grain is
    our choice; the contract names only the mode.]
    """
    known = loaded.select(grain)
    if dict(source.dtypes)[grain] == "date":
        known = F.broadcast(known.distinct())
    return source.join(known, grain, "left_anti")


def rows_to_load(
    source: DataFrame, loaded: DataFrame, mode: str = APPEND_MISSING, dates: Iterable[date | str] = ()
) -> DataFrame:
    """The rows a load takes: everything, or what is missing, of the dates asked for (none named: all)."""
    dates = list(dates)
    wanted = only_dates(source, dates) if dates else source
    if mode == FULL_REPLACE:
        return wanted
    if mode == APPEND_MISSING:
        return append_missing(wanted, loaded)
    raise ValueError(f"unknown load mode {mode!r}")


def selected_dates(missing: DataFrame, date_column: str = "event_date") -> DataFrame:
    """Dates of the rows to load, with their row counts: the load manifest."""
    return missing.groupBy(date_column).agg(F.count(F.lit(1)).alias("rows"))


def load_instruction(manifest: DataFrame) -> DataFrame:
    """SKIP when no date was selected, else CONTINUE."""
    return manifest.agg(F.count(F.lit(1)).alias("selected_date_count")).select(
        "selected_date_count",
        F.when(F.col("selected_date_count") == 0, "SKIP").otherwise("CONTINUE").alias("instruction"),
    )
