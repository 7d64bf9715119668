"""A dashboard table in buckets of its record ids: corrections rewrite the buckets they fall into, no others.

A record's bucket is a hash of its id, so corrections tell their buckets without looking at the table. Each bucket is
published as one step (``versions``), and a bucket in which nothing changes is not written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..operators.corrections import apply_corrections
from ..operators.scoring import TOPICS
from ..session import scratch_path
from .versions import publish, read_published

BUCKET = "bucket"
# [choice] Buckets of a table; it stays with the table, since a record's bucket depends on it.
BUCKETS = 256


def record_bucket(record_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(record_id.cast("string")), F.lit(buckets)).cast("int")


def write_dashboard(df: DataFrame, root: str, record_id: str = "record_id", buckets: int = BUCKETS) -> None:
    """Publish the whole table, bucket by bucket; buckets without a record become empty."""
    publish(df.withColumn(BUCKET, record_bucket(F.col(record_id), buckets)), root, range(buckets), BUCKET)


def read_dashboard(spark: SparkSession, root: str, schema: StructType, buckets: Sequence[int] | None = None) -> DataFrame:
    return read_published(spark, root, _bucketed(schema), buckets, BUCKET).drop(BUCKET)


def _bucketed(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(BUCKET, IntegerType())


def correct_dashboard(
    spark: SparkSession,
    root: str,
    schema: StructType,
    corrections: DataFrame,
    record_id: str = "record_id",
    topics: Sequence[str] = TOPICS,
    buckets: int = BUCKETS,
) -> list[int]:
    """Lay corrections over the stored table; returns the buckets that were written.

    ``corrections`` has one row per record. Only the buckets its records fall into are read; of them only
    those with a value that really changes are written, so laying the same corrections
    over a table twice writes nothing the second time. Corrections of unknown records have no effect.
    """
    fixed = [t for t in topics if t in corrections.columns]
    if not fixed:
        return []
    staged = scratch_path(spark, "dashboard-corrections")
    own = corrections.select(record_id, *fixed).withColumn(BUCKET, record_bucket(F.col(record_id), buckets))
    own.write.parquet(staged)
    own = spark.read.schema(own.schema).parquet(staged)
    touched = [row[0] for row in own.select(BUCKET).distinct().collect()]  # at most one row per bucket
    stored = read_published(spark, root, _bucketed(schema), touched, BUCKET)
    # Joined once: the buckets with a change and their new rows both come from the stored result.
    laid = apply_corrections(stored.withColumn("_was", F.struct(*fixed)), own.drop(BUCKET), record_id, topics)
    laid = laid.withColumn("_changed", ~F.struct(*fixed).eqNullSafe(F.col("_was"))).drop("_was")
    staged = scratch_path(spark, "dashboard-corrected")
    laid.write.parquet(staged)
    laid = spark.read.schema(laid.schema).parquet(staged)
    changed = sorted(row[0] for row in laid.filter("_changed").select(BUCKET).distinct().collect())
    if changed:
        publish(laid.filter(F.col(BUCKET).isin(changed)).drop("_changed"), root, changed, BUCKET)
    return changed
