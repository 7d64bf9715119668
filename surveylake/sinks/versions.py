"""Publishing the parts of a table as one step each.

The rows of a part (a date, a bucket, the whole of a small table) are written to a folder of their
own, ``data/<column>=<value>/version=<id>``, that no reader knows. Then one empty
marker file, ``current/<value>.<number>.<id>``, is created; the marker with the highest
number names the version that counts, so creating it is the step. A reader sees the old part or
the new one as a whole, a write that fails leaves the old one, and the files of a
version stay until ``drop_superseded`` is told that nobody reads them any more.

Values of a part may not hold ``.`` or ``/``; dates, numbers and names do not. Of two writers of the same part
at the same time one wins, whole; writers of different parts do not meet.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..sources.tables import path_exists
from .tables import _hadoop, observed

VERSION = "version"
# The marker of a part without rows.
NONE = "none"
WHOLE = "whole"


def _names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    fs, path = _hadoop(spark, folder)
    if not fs.exists(path):
        return []
    return [(status.getPath().getName(), status.getModificationTime()) for status in fs.listStatus(path)]


def _markers(spark: SparkSession, root: str) -> list[tuple[str, int, str, int]]:
    """Part, number, version and time of every marker, in the order of the numbers."""
    found = []
    for name, modified in _names(spark, f"{root}/current"):
        if name.count(".") == 2 and not name.startswith("."):
            value, number, version = name.split(".")
            found.append((value, int(number), version, modified))
    return sorted(found, key=lambda marker: marker[:3])


def current_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """The version that counts of every published part; one listing, no data is read."""
    return {value: version for value, _, version, _ in _markers(spark, root)}


def _checked(values: Iterable[object]) -> list[str]:
    parts = list(dict.fromkeys(str(v) for v in values))
    for part in parts:
        if not part or set(part) & {".", "/"}:
            raise ValueError(f"{part!r} can't name a part")
    return parts


def publish(df: DataFrame, root: str, values: Iterable[object], column: str = "event_date") -> str:
    """Replace the parts ``values`` by the frame's rows; a part without rows becomes empty. Returns the version's id.

    Rows of other parts, or of none, are an error, and then nothing is published. Every part
    is one step; of several parts some may be seen before others. Publishing again is safe.
    """
    spark, parts, version = df.sparkSession, _checked(values), uuid.uuid4().hex
    if VERSION in df.columns:
        raise ValueError(f"a published table can't have a column {VERSION}")
    known = F.coalesce(F.col(column).cast("string").isin(parts), F.lit(False))
    seen = Observation()
    rows = df.observe(seen, F.count_if(~known).alias("strange")).withColumn(VERSION, F.lit(version))
    rows.hint("rebalance", column).write.mode("append").partitionBy(column, VERSION).parquet(f"{root}/data")
    strange = observed(seen).get("strange", 0)
    if strange:
        raise ValueError(f"{strange} rows are of none of the parts to publish")
    numbers = {value: number for value, number, _, _ in _markers(spark, root)}
    for part in parts:
        written = path_exists(spark, f"{root}/data/{column}={part}/{VERSION}={version}")
        name = f"{part}.{numbers.get(part, 0) + 1:09d}.{version if written else NONE}"
        fs, marker = _hadoop(spark, f"{root}/current/{name}")
        fs.create(marker, False).close()
    return version


def read_published(
    spark: SparkSession, root: str, schema: StructType, values: Iterable[object] | None = None, column: str = "event_date"
) -> DataFrame:
    """The published rows, of all parts or of ``values`` only; no other folder is listed or read."""
    current = current_versions(spark, root)
    parts = list(current) if values is None else [v for v in dict.fromkeys(str(v) for v in values) if v in current]
    folders = [f"{root}/data/{column}={v}/{VERSION}={current[v]}" for v in parts if current[v] != NONE]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(StructType([*schema.fields]).add(VERSION, StringType()))
    return stored.option("basePath", f"{root}/data").parquet(*folders).select(*[f"`{c}`" for c in schema.fieldNames()])


def publish_table(df: DataFrame, root: str) -> str:
    """Replace a whole small table, such as a rollup, as one step."""
    return publish(df.withColumn(WHOLE, F.lit("all")), root, ["all"], WHOLE)


def read_table(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The table as last published; empty before the first time."""
    return read_published(spark, root, StructType([*schema.fields]).add(WHOLE, StringType()), column=WHOLE).drop(WHOLE)


def drop_superseded(spark: SparkSession, root: str, before: datetime, column: str = "event_date") -> list[str]:
    """Delete versions that do not count and were last written before that moment; returns them as ``<value>/<version>``.

    The moment has to lie before the start of every read and write that still runs. What a failed write
    left goes the same way.
    """
    limit, dropped = before.timestamp() * 1000, []
    current = current_versions(spark, root)
    for name, _ in _names(spark, f"{root}/data"):
        value = name.removeprefix(f"{column}=")
        if value == name:
            continue
        for folder, modified in _names(spark, f"{root}/data/{name}"):
            version = folder.removeprefix(f"{VERSION}=")
            if version != current.get(value) and modified < limit:
                fs, path = _hadoop(spark, f"{root}/data/{name}/{folder}")
                fs.delete(path, True)
                dropped.append(f"{value}/{version}")
    newest = {value: (number, version) for value, number, version, _ in _markers(spark, root)}
    for value, number, version, modified in _markers(spark, root):
        if (number, version) != newest[value] and modified < limit:
            fs, path = _hadoop(spark, f"{root}/current/{value}.{number:09d}.{version}")
            fs.delete(path, False)
    return sorted(dropped)
