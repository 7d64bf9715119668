"""The run tracker: one row per execution date, merged run by run."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..channels import SCORING_ORDER, channel_specs
from ..schemas import RUN_LOG, TRACKER
from ..sources.tables import scan_table
from .tables import overwrite_partitions

FLAGS = {name: f"{spec.tracker_prefix}_available" for name, spec in channel_specs().items()}


def tracker_update(
    available: DataFrame, new_records: DataFrame, execution_date: date, channels: Iterable[str]
) -> DataFrame:
    """The row a run writes: flags of the channels it processed, its dates and its new-records report.

    ``available`` has ``channel, available``; ``new_records`` has ``channel,
    event_date, new_records_found``, one row per batch of the run.
    """
    processed = list(channels)
    flags = available.filter(F.col("channel").isin(processed)).agg(
        *[F.bool_or(F.when(F.col("channel") == c, F.col("available"))).alias(FLAGS[c]) for c in FLAGS]
    )
    entry = F.struct("event_date", "channel", "new_records_found")
    report = new_records.agg(
        F.sort_array(F.collect_set("event_date")).alias("dates_processed"),
        F.sort_array(F.collect_list(entry)).alias("source_new_records"),
    )
    when = F.lit(execution_date)
    # Both sides are one row; the date is their common key.
    joined = flags.withColumn("execution_date", when).join(report.withColumn("execution_date", when), "execution_date")
    return joined.select(*TRACKER.fieldNames())


def merge_tracker(state: DataFrame, update: DataFrame) -> DataFrame:
    """Upsert by execution date; a NULL in the update leaves the stored value.

    A run sets only the columns of the channels it processed, so the others keep
    what an earlier run wrote.
    """
    padded = update
    for field in state.schema.fields:
        if field.name not in update.columns:
            padded = padded.withColumn(field.name, F.lit(None).cast(field.dataType))
    joined = state.alias("old").join(
        padded.alias("new"), F.col("old.execution_date") == F.col("new.execution_date"), "full"
    )
    return joined.select(*[F.coalesce(F.col(f"new.`{c}`"), F.col(f"old.`{c}`")).alias(c) for c in state.columns])


def upsert_tracker(spark: SparkSession, root: str, update: DataFrame) -> None:
    """Merge into the stored tracker; only the execution date of the update is rewritten. Single writer.

    The update is the one row of a run, so it is fetched and used as a literal.
    """
    rows = update.collect()
    fixed = spark.createDataFrame(rows, update.schema)
    dates = [row["execution_date"] for row in rows]
    touched = scan_table(spark, root, TRACKER).filter(F.col("execution_date").isin(dates))
    overwrite_partitions(merge_tracker(touched, fixed), root, ["execution_date"])


def append_run(
    spark: SparkSession,
    root: str,
    available: DataFrame,
    new_records: DataFrame,
    execution_date: date,
    channels: Iterable[str],
    run_id: str,
) -> None:
    """Add what a run says, one row per channel it processed.

    Arguments as for ``tracker_update``. Every run writes a folder of its own, so runs
    that overlap lose nothing; one repeated under its own id replaces what it said.
    """
    names = spark.createDataFrame([(c,) for c in channels], "channel string")
    entry = F.struct("event_date", "channel", "new_records_found")
    report = new_records.groupBy("channel").agg(
        F.sort_array(F.collect_set("event_date")).alias("dates_processed"),
        F.sort_array(F.collect_list(entry)).alias("new_records"),
    )
    rows = names.join(available.select("channel", "available"), "channel", "left").join(report, "channel", "left")
    columns = [c for c in RUN_LOG.fieldNames() if c not in ("execution_date", "run_id")]
    folder = f"{root}/execution_date={execution_date}/run_id={quote(run_id, safe='')}"
    rows.withColumn("written_at", F.current_timestamp()).select(*columns).coalesce(1).write.mode("overwrite").parquet(folder)


def fold_log(log: DataFrame) -> DataFrame:
    """The tracker the run log adds up to: per flag what the latest run that set it says, lists of the latest run.

    Runs are ordered by the time of writing, then by id.
    """
    last = F.struct("written_at", "run_id").alias("_last")
    flags = {flag: F.bool_or(F.when(F.col("channel") == channel, F.col("available"))) for channel, flag in FLAGS.items()}
    runs = log.groupBy("execution_date", "run_id").agg(
        F.max("written_at").alias("written_at"),
        *[value.alias(flag) for flag, value in flags.items()],
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("dates_processed")))).alias("dates_processed"),
        F.sort_array(F.flatten(F.collect_list("new_records"))).alias("source_new_records"),
    )
    runs = runs.withColumn("_last", last)
    latest = {flag: F.max_by(flag, F.when(F.col(flag).isNotNull(), F.col("_last"))) for flag in FLAGS.values()}
    lists = {name: F.max_by(name, "_last") for name in ("dates_processed", "source_new_records")}
    folded = runs.groupBy("execution_date").agg(*[v.alias(k) for k, v in {**latest, **lists}.items()])
    return folded.select(*TRACKER.fieldNames())


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return scan_table(spark, root, RUN_LOG)


def refresh_tracker(spark: SparkSession, log_root: str, root: str, execution_date: date) -> None:
    """Write the tracker row of a date again from the log.

    The row is a copy for readers of the tracker table; the log alone decides, so a
    copy that an overlapping run wrote from an older log is mended by the next run.
    """
    log = read_log(spark, log_root).filter(F.col("execution_date") == F.lit(execution_date))
    overwrite_partitions(fold_log(log), root, ["execution_date"])


def scoring_order(spark: SparkSession) -> DataFrame:
    rows = [(name, FLAGS[name], position) for position, name in enumerate(SCORING_ORDER, start=1)]
    return spark.createDataFrame(rows, "channel string, flag string, position int")


def channel_gate(tracker: DataFrame, order: DataFrame, as_of: date) -> DataFrame:
    """Which channels the text stage runs on, in its order.

    A missing tracker row, or a flag never set, means not available. The ivr
    channel always runs.
    """
    flags = list(FLAGS.values())
    row = tracker.filter(F.col("execution_date") == F.lit(as_of))
    pairs = F.map_from_arrays(F.array(*[F.lit(c) for c in flags]), F.array(*[F.col(c) for c in flags]))
    flag_rows = row.select(F.explode(pairs).alias("flag", "is_set"))
    available = F.coalesce("is_set", F.lit(False))
    return order.join(flag_rows, "flag", "left").select(
        "channel",
        "position",
        available.alias("available"),
        (available | (F.col("channel") == "ivr")).alias("run"),
    )


def lookup_status(tracker: DataFrame, as_of: date) -> DataFrame:
    found = tracker.filter(F.col("execution_date") == F.lit(as_of)).agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.when(F.col("n") > 0, "FOUND").otherwise("NOT_FOUND").alias("lookup_status"))
