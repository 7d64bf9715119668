"""Writers. Re-running any of them with the same input leaves the same table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# CSV keeps texts as they are: outer white space stays, a quote is doubled, null and the empty text differ.
CSV = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "escape": '"',
}


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def overwrite_partitions(
    df: DataFrame, root: str, by: Sequence[str] = ("event_date",), fmt: str = "parquet"
) -> None:
    """Replace the partitions the frame carries; other partitions stay.

    The rebalance collects each partition's rows into few files and splits a
    partition that is too large for one task.
    """
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**(CSV if fmt == "csv" else {})).partitionBy(*by).format(fmt).save(root)


def observed(seen: Observation) -> dict[str, object]:
    """The observed values; none where the frame was found empty and planned away together with its observation."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


def replace_partitions(
    df: DataFrame, root: str, values: Sequence[object], column: str = "event_date", fmt: str = "parquet"
) -> None:
    """Replace the partitions named in ``values``, also those for which the frame has no row left.

    Which of them stay empty is counted in the same pass as the write.
    """
    if not values:
        return
    seen = Observation()
    counts = [F.count_if(F.col(column) == F.lit(v)).alias(str(v)) for v in values]
    overwrite_partitions(df.observe(seen, *counts), root, [column], fmt)
    rows = observed(seen)
    drop_partitions(df.sparkSession, root, column, [v for v in values if not rows.get(str(v))])


def drop_partitions(spark: SparkSession, root: str, column: str, values: Iterable[object]) -> None:
    for value in values:
        fs, folder = _hadoop(spark, f"{root}/{column}={value}")
        fs.delete(folder, True)


def write_removed_csv(df: DataFrame, root: str, dates: Sequence[object] = ()) -> None:
    """Removed-records report: CSV with header, one folder per date, none for dates without removals.

    ``dates`` names the dates of the run, so that one without removals loses an
    earlier run's report.
    """
    if dates:
        replace_partitions(df, root, dates, "removed_date", "csv")
    else:
        overwrite_partitions(df, root, ["removed_date"], "csv")


def write_parts(df: DataFrame, folder: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").options(**(CSV if fmt == "csv" else {})).format(fmt).save(folder)


def export_csv(spark: SparkSession, source: str, target: str) -> tuple[int, int]:
    """A parquet file or folder as a folder of CSV parts with header rows; returns the rows and columns written."""
    seen = Observation()
    df = spark.read.parquet(source).observe(seen, F.count(F.lit(1)).alias("rows"))
    write_parts(df, target, "csv")
    return int(observed(seen).get("rows", 0)), len(df.columns)


# --- reporting tables ------------------------------------------------------------

# Reporting column types by Spark type, in the names that Spark's parser reads; text is left to the database's dialect.
REPORTING_TYPES = {
    "boolean": "BOOLEAN",
    "tinyint": "BIGINT",
    "smallint": "BIGINT",
    "int": "BIGINT",
    "bigint": "BIGINT",
    "float": "DOUBLE",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def reporting_column_types(df: DataFrame) -> str:
    typed = [(name.replace("`", "``"), REPORTING_TYPES.get(kind)) for name, kind in df.dtypes]
    return ", ".join(f"`{name}` {kind}" for name, kind in typed if kind)


def refresh_jdbc_table(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Full refresh of a database table: truncate and insert, keeping its definition."""
    (
        df.write.mode("overwrite")
        .option("truncate", True)
        .option("createTableColumnTypes", reporting_column_types(df))
        .jdbc(url, table, properties=properties)
    )


def refresh_saved_table(df: DataFrame, schema: str, table: str, folder: str) -> None:
    """Full refresh of a catalog table."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{folder}/{schema}'")
    df.write.mode("overwrite").option("path", f"{folder}/{schema}/{table}").saveAsTable(f"`{schema}`.`{table}`")


def load_reporting(
    spark: SparkSession,
    frames: dict[tuple[str, str], DataFrame],
    write: Callable[[DataFrame, str, str], None],
) -> DataFrame:
    """Refresh each table on its own and report per table: rows loaded and status.

    One table's failure does not stop the others. ``write(df, schema, table)``
    performs the refresh; the row count comes from the same pass.
    """
    results = []
    for (schema, table), df in frames.items():
        seen = Observation(f"{schema}.{table}")
        try:
            write(df.observe(seen, F.count(F.lit(1)).alias("rows")), schema, table)
            results.append((schema, table, int(observed(seen).get("rows", 0)), "SUCCESS", None))
        except Exception as error:  # the report carries every kind of load failure
            results.append((schema, table, 0, "FAILED", str(error)))
    return spark.createDataFrame(
        results, "schema string, table string, rows_loaded bigint, status string, error string"
    )


def load_status(results: DataFrame) -> DataFrame:
    """FAILED when any table failed, else SUCCESS."""
    ok = F.coalesce(F.bool_and(F.col("status") == "SUCCESS"), F.lit(True))
    return results.agg(F.when(ok, "SUCCESS").otherwise("FAILED").alias("lookup_status"))

