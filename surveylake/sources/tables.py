"""Partitioned tables, the lookup file, the control file and snapshots."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import INTENT_MAP


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def scan_table(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """A partitioned table, or an empty frame when its folder does not exist.

    Only a missing path counts as "not available"; any other failure is raised.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def scan_partition(
    spark: SparkSession, root: str, dates: Iterable[date | str], schema: StructType, column: str = "event_date"
) -> DataFrame:
    """The requested dates of a table, all of its columns, with the date from the folder names.

    Only the folders asked for are listed, and their schemas are merged, so a
    long history costs nothing. Dates without a folder contribute no rows; with
    none at all the result is an empty frame of the given schema.
    """
    folders = [f"{root}/{column}={d}" for d in dict.fromkeys(str(d) for d in dates)]
    present = [f for f in folders if path_exists(spark, f)]
    if not present:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", root).option("mergeSchema", True).parquet(*present)


def scan_lookup_csv(spark: SparkSession, path: str, schema: StructType = INTENT_MAP) -> DataFrame:
    """A required lookup file: header row, all columns text."""
    return spark.read.schema(schema).option("header", True).csv(path)


def resolve_dates(spark: SparkSession, control_path: str) -> DataFrame:
    """The dates to process: those of the lexically last key of the control object.

    A value is one date or a list of dates.
    """
    text = spark.read.text(control_path, wholetext=True)
    entries = text.select(F.explode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("e"))
    latest = entries.agg(F.max_by("e.value", "e.key").alias("dates"))
    listed = F.when(F.col("dates").startswith("["), F.from_json("dates", "array<string>")).otherwise(
        F.array("dates")
    )
    days = latest.filter(F.col("dates").isNotNull()).select(F.explode(listed).alias("day"))
    return days.select(F.col("day").cast("date").alias("event_date"))


def requested_dates(spark: SparkSession, control_path: str) -> list[date]:
    """The same dates as literals, for partition pruning; one ingestion's dates are few."""
    return [row.event_date for row in resolve_dates(spark, control_path).collect()]


def select_channels(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.filter(F.col("channel").isin(list(names)))


def partition_values(spark: SparkSession, root: str, key: str) -> list[str]:
    """The values of the ``key=`` folders directly under ``root``, from the listing alone; none without the folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path) if status.isDirectory()]
    return [name.split("=", 1)[1] for name in names if name.startswith(f"{key}=")]


def latest_partition(spark: SparkSession, root: str, key: str = "insert_date") -> str | None:
    """The lexically last ``key=`` folder directly under ``root``."""
    return max(partition_values(spark, root, key), default=None)


def scan_latest_snapshot(spark: SparkSession, root: str, schema: StructType, key: str = "insert_date") -> DataFrame:
    """The latest snapshot of a reference table; empty when there is none."""
    latest = latest_partition(spark, root, key)
    if latest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root).filter(F.col(key) == F.lit(latest).cast(schema[key].dataType))
