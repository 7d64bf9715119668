"""Which columns each date of a table has, recorded once, so that a scan opens no footer of a date it knows."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import DATE_COLUMNS
from .tables import scan_table

FOOTER_READERS = 8


def file_mark(spark: SparkSession, folder: str) -> str | None:
    """A digest of the names, sizes and times of a folder's data files; None without the folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    files = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)]
    shown = sorted(f for f in files if not f[0].startswith(("_", ".")))
    return hashlib.sha256(repr(shown).encode()).hexdigest()


def known_columns(spark: SparkSession, registry: str, marks: dict[str, str]) -> dict[str, StructType]:
    """The recorded columns of the dates whose files are still those recorded; one row per requested date."""
    if not marks:
        return {}
    rows = scan_table(spark, registry, DATE_COLUMNS).filter(F.col("partition_value").isin(list(marks)))
    found = rows.groupBy("partition_value", "files").agg(F.min("columns").alias("columns")).collect()
    return {r.partition_value: StructType.fromJson(json.loads(r.columns)) for r in found if marks[r.partition_value] == r.files}


def record_columns(spark: SparkSession, root: str, registry: str, marks: dict[str, str], column: str) -> dict[str, StructType]:
    """Read the footers of these dates' files and add a row per date; entries are only ever added, so runs may overlap."""

    def footer(value: str) -> StructType:
        return spark.read.option("mergeSchema", True).parquet(f"{root}/{column}={value}").schema

    with ThreadPoolExecutor(max_workers=FOOTER_READERS) as pool:
        found = dict(zip(marks, pool.map(footer, marks)))
    rows = [(value, marks[value], schema.json()) for value, schema in found.items()]
    spark.createDataFrame(rows, DATE_COLUMNS).coalesce(1).write.mode("append").parquet(registry)
    return found


def joined_columns(schemas: dict[str, StructType]) -> StructType:
    """All columns of the dates, in the order they first appear; a column of two types is an error that names the dates."""
    result, first = StructType(), {}
    for value, schema in schemas.items():
        for field in schema.fields:
            key = field.name.lower()
            if key not in first:
                first[key] = (value, field)
                result = result.add(field.name, field.dataType, True)
            elif first[key][1].dataType != field.dataType:
                earlier, known = first[key]
                raise ValueError(
                    f"column {field.name} is {known.dataType.simpleString()} on {earlier} and {field.dataType.simpleString()} on {value}"
                )
    return result


def scan_registered(
    spark: SparkSession, root: str, dates: Iterable[date | str], schema: StructType, registry: str, column: str = "event_date"
) -> DataFrame:
    """The requested dates of a table with the columns these dates have, as ``scan_partition`` gives them.

    The columns come from the registry; only dates that are new, or whose files
    have changed since, are opened, one footer read per date. A column that some
    of the dates lack is NULL there; one that none of them has is absent, since
    steps of a run depend on that (a frame without ``campaign`` passes whole). A
    table of which none of the dates is there gives an empty frame of ``schema``.
    """
    wanted = dict.fromkeys(str(d) for d in dates)
    marks = {v: mark for v in wanted if (mark := file_mark(spark, f"{root}/{column}={v}")) is not None}
    if not marks:
        return spark.createDataFrame([], schema)
    known = known_columns(spark, registry, marks)
    new = {v: mark for v, mark in marks.items() if v not in known}
    if new:
        known |= record_columns(spark, root, registry, new, column)
    columns = joined_columns({v: known[v] for v in marks})
    kind = schema[column].dataType
    read = spark.read.option("basePath", root).schema(columns.add(column, kind))
    return read.parquet(*[f"{root}/{column}={v}" for v in marks])
