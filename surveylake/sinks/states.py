"""The stored states of a channel's final table, kept in step with it date by date."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.states import STATE_MONTH
from ..schemas import SCORE_STATES
from ..session import scratch_path
from ..sources.tables import partition_values, scan_table
from .tables import drop_partitions, overwrite_partitions


def stored_states(spark: SparkSession, root: str) -> DataFrame:
    return scan_table(spark, root, SCORE_STATES)


def update_states(spark: SparkSession, root: str, states: DataFrame, dates: Iterable[date]) -> None:
    """Replace the states of ``dates`` by those given; a date without one loses its state.

    Only the months of these dates are read and written, 31 rows each. They are
    written to a scratch table first, since a partition can't be read while it is replaced.
    """
    dates = sorted(set(dates))
    if not dates:
        return
    months = sorted({f"{d:%Y-%m}" for d in dates})
    columns = SCORE_STATES.fieldNames()
    month = stored_states(spark, root).filter(F.col(STATE_MONTH).isin(months))
    kept = month.filter(~F.col("event_date").isin(dates))
    staged = scratch_path(spark, "states")
    new = states.filter(F.col("event_date").isin(dates)).select(*[F.col(f.name).cast(f.dataType) for f in SCORE_STATES])
    kept.select(*columns).unionByName(new).write.parquet(staged)
    merged = spark.read.schema(SCORE_STATES).parquet(staged)
    left = {row[0] for row in merged.select(STATE_MONTH).distinct().collect()}
    if left:
        overwrite_partitions(merged, root, [STATE_MONTH])
    drop_partitions(spark, root, STATE_MONTH, set(months) - left)


def catch_up(
    spark: SparkSession, table: str, root: str, build: Callable[[list[date]], DataFrame]
) -> list[date]:
    """Bring the states in step with the table's folders; returns the dates that were wrong.

    Dates of the table without a state get one, states of dates that are gone are
    dropped. Both sides are listed, not read; ``build`` reads the missing dates only,
    so this costs a scan of the history once, for a table older than its states.
    """
    present = {date.fromisoformat(v) for v in partition_values(spark, table, "event_date")}
    known = {row.event_date for row in stored_states(spark, root).select("event_date").distinct().collect()}
    missing, gone = sorted(present - known), sorted(known - present)
    if missing:
        update_states(spark, root, build(missing), [*missing, *gone])
    elif gone:
        update_states(spark, root, spark.createDataFrame([], SCORE_STATES), gone)
    return missing + gone
