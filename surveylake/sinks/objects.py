"""Distributed copy of objects and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def copy_objects(
    inventory: DataFrame, source: str, target: str, partitions: int = 200, threads: int = 10, dry_run: bool = False
) -> DataFrame:
    """Copy every listed object from the source root to the same path under the target root.

    One result row per object. The frame is lazy and copies when it is evaluated:
    write it once and read the written result, so that nothing is copied twice.
    An object listed for two prefixes is copied once and reported for both. Each
    object is streamed to a name of its own attempt and then moved into place, so
    a repeated or abandoned task leaves no half-written target.
    """
    one_each = inventory.groupBy("path", "length").agg(F.collect_set("prefix").alias("prefixes"))
    spread = one_each.repartition(partitions, "path")

    def copy(batches):
        import uuid
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow as pa
        from pyarrow import fs as pafs

        src, src_base = pafs.FileSystem.from_uri(source)
        dst, dst_base = pafs.FileSystem.from_uri(target)

        def one(item):
            if dry_run:
                return None
            final = f"{dst_base}/{item['path']}"
            attempt = f"{final}.part-{uuid.uuid4().hex}"
            try:
                dst.create_dir(final.rsplit("/", 1)[0], recursive=True)
                copied = 0
                with src.open_input_stream(f"{src_base}/{item['path']}") as reader:
                    with dst.open_output_stream(attempt) as writer:
                        while block := reader.read(8 << 20):
                            writer.write(block)
                            copied += len(block)
                if copied != item["length"]:
                    raise OSError(f"copied {copied} of {item['length']} bytes")
                dst.move(attempt, final)
            except OSError as error:
                return str(error)
            return None

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for batch in batches:
                errors = list(pool.map(one, batch.to_pylist()))
                yield batch.append_column("error", pa.array(errors, pa.string()))

    copied = spread.mapInArrow(copy, "path string, length bigint, prefixes array<string>, error string")
    return copied.select(
        F.explode("prefixes").alias("prefix"), "path", "length", F.col("error").isNull().alias("ok"), "error"
    )


def copy_report(results: DataFrame) -> DataFrame:
    """Objects, successes and failures per prefix."""
    return results.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("objects"),
        F.count_if(F.col("ok")).alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def copy_failures(results: DataFrame) -> DataFrame:
    """The failure report; any row in it means the job failed."""
    return results.filter(~F.col("ok")).select(F.col("path").alias("failed_key"), "error")
