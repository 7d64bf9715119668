"""The ledger of reprocessing batches: what was sent, what was answered, and what a later run has to send again.

[choice] Only the batches themselves were known. A record is open until it is
sent, sent until it is answered, and expired when no answer came in time. Events
are only added, so runs that overlap lose nothing, and a run that broke off is resumed by the next.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BATCH_EVENTS
from ..sources.tables import path_exists
from .corrections import BATCH_SIZE, RANDOM_SEED, reprocess_batches

OPEN, SENT, ANSWERED, EXPIRED = "open", "sent", "answered", "expired"
# An answer counts before a sending of the same moment.
_ORDER = {SENT: 0, ANSWERED: 1}
TIME_TO_ANSWER = timedelta(hours=24)


def _events(rows: DataFrame, record_id: str, state: str, run_id: str, at: datetime) -> DataFrame:
    return rows.select(
        F.col(record_id).cast("string").alias("record_id"),
        F.col("batch_index").cast("bigint").alias("batch_index"),
        F.lit(state).alias("state"),
        F.lit(at).cast("timestamp").alias("happened_at"),
        F.lit(run_id).alias("run_id"),
    )


def sent_events(batches: DataFrame, run_id: str, at: datetime, record_id: str = "record_id") -> DataFrame:
    return _events(batches, record_id, SENT, run_id, at)


def answered_events(outputs: DataFrame, run_id: str, at: datetime, record_id: str = "record_id") -> DataFrame:
    """Events of the batch outputs that came back; a record that comes back twice counts as answered all the same."""
    return _events(outputs, record_id, ANSWERED, run_id, at)


def append_events(events: DataFrame, root: str) -> None:
    """Add events in a folder of their own, so that runs may write side by side."""
    events.write.parquet(f"{root}/events-{uuid.uuid4().hex}")


def read_events(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, root):
        return spark.createDataFrame([], BATCH_EVENTS)
    return spark.read.schema(BATCH_EVENTS).option("recursiveFileLookup", True).parquet(root)


def record_states(events: DataFrame, now: datetime, time_to_answer: timedelta = TIME_TO_ANSWER) -> DataFrame:
    """The state of every record with an event, its batch and run, and how often it was sent.

    An answer settles a record whenever it came, even after it was sent again.
    """
    rank = F.create_map(*[F.lit(x) for pair in _ORDER.items() for x in pair])
    latest = F.max_by(F.struct("state", "batch_index", "run_id", "happened_at"), F.struct("happened_at", rank[F.col("state")], "run_id"))
    grouped = events.groupBy("record_id").agg(
        latest.alias("_last"),
        F.bool_or(F.col("state") == ANSWERED).alias("_answered"),
        F.count_if(F.col("state") == SENT).alias("times_sent"),
    )
    late = F.col("_last.happened_at") < F.lit(now - time_to_answer).cast("timestamp")
    state = F.when(F.col("_answered"), ANSWERED).when(late, EXPIRED).otherwise(SENT)
    return grouped.select(
        "record_id", state.alias("state"), F.col("_last.batch_index").alias("batch_index"), F.col("_last.run_id").alias("run_id"), "times_sent"
    )


def open_records(
    low: DataFrame, states: DataFrame, record_id: str = "record_id", retry_expired: bool = True
) -> DataFrame:
    """Low-confidence records that a run has to send: those never sent, and expired ones."""
    settled: Column = F.col("state").isin(SENT, ANSWERED) if retry_expired else F.col("state").isNotNull()
    closed = states.filter(settled).select(F.col("record_id").alias("_closed"))
    return low.join(closed, F.col(record_id).cast("string") == F.col("_closed"), "left_anti")


def next_batches(
    low: DataFrame,
    states: DataFrame,
    record_id: str = "record_id",
    batch_size: int = BATCH_SIZE,
    seed: int = RANDOM_SEED,
    retry_expired: bool = True,
) -> DataFrame:
    """The open records in batches, numbered for this run from 0."""
    return reprocess_batches(open_records(low, states, record_id, retry_expired), record_id, batch_size, seed)


def ledger_summary(low: DataFrame, states: DataFrame, record_id: str = "record_id") -> DataFrame:
    """Records per state; low-confidence records without an event are open."""
    unseen = low.select(F.col(record_id).cast("string").alias("record_id")).join(states.select("record_id"), "record_id", "left_anti")
    every = states.select("state").unionByName(unseen.select(F.lit(OPEN).alias("state")))
    return every.groupBy("state").agg(F.count(F.lit(1)).alias("records"))
