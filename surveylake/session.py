"""Session settings the operators rely on, and where written scratch tables go."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or keep large runs healthy. Sizes and executor
# counts belong to the cluster's own configuration and are not set here.
RUN_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Timestamps as standard microseconds; the default INT96 is misread by some readers.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A re-run replaces the dates it carries and leaves the others alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot account even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_run_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUN_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "surveylake", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster use the one submitted with the job."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUN_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_run_conf(spark)


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="surveylake-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for a written intermediate table, unique per call.

    It lies under the cluster's ``spark.checkpoint.dir``, which every executor
    can read. Only a local session without that setting falls back to a
    temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_folder()
    return f"{root.rstrip('/')}/surveylake/{label}-{uuid.uuid4().hex}"


def cpu_count() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
