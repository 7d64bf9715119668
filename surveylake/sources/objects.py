"""Listing of the objects under prefixes, done by tasks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = "prefix string, path string, length bigint, is_folder boolean"


def list_objects(
    spark: SparkSession, root: str, prefixes: Iterable[str], partitions: int = 200, levels: int = 2
) -> DataFrame:
    """Every object under the prefixes: ``prefix``, ``path`` below the root, ``length``.

    Spark's own file sources hide names starting with ``_`` or ``.``; a copy must
    carry those too, so tasks list through ``pyarrow.fs`` instead. Folders are
    spread over tasks again after each of the first ``levels`` levels, so one
    large prefix is listed by many tasks. A missing or empty prefix gives no
    rows; an object under two overlapping prefixes is listed for each of them.
    """

    def expand(recursive: bool):
        def run(batches):
            import pyarrow as pa
            from pyarrow import fs as pafs

            store, base = pafs.FileSystem.from_uri(root)
            schema = pa.schema(
                [("prefix", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("is_folder", pa.bool_())]
            )

            def batch(rows):
                return pa.RecordBatch.from_pylist(rows, schema=schema)

            for given in batches:
                rows = given.to_pylist()
                yield batch([r for r in rows if not r["is_folder"]])
                for folder in (r for r in rows if r["is_folder"]):
                    where = f"{base}/{folder['path']}".rstrip("/")
                    found = store.get_file_info(pafs.FileSelector(where, allow_not_found=True, recursive=recursive))
                    yield batch(
                        [
                            {
                                "prefix": folder["prefix"],
                                "path": i.path[len(base):].lstrip("/"),
                                "length": i.size or 0,
                                "is_folder": i.type == pafs.FileType.Directory,
                            }
                            for i in found
                        ]
                    )

        return run

    entries = spark.createDataFrame([(p, p.strip("/"), 0, True) for p in prefixes], _ENTRY)
    for recursive in [False] * levels + [True]:
        entries = entries.repartition(partitions, "path").mapInArrow(expand(recursive), _ENTRY)
    return entries.filter(~F.col("is_folder")).drop("is_folder")


def prefix_counts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )
