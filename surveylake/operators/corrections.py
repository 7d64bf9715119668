"""Low-confidence selection, reprocessing batches, correction overlay and dashboards.

Only the parameters of these steps are known, not their code; choices marked
[choice] are ours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import content_hash
from ..functions.grouping import hash_order
from .scoring import CONFIDENCE_THRESHOLDS, TOPICS, confidence

BATCH_SIZE = 25
# Batches of one output folder.
FOLDER_BATCHES = 1000
RANDOM_SEED = 42


def low_topics(thresholds: Mapping[str, float] = CONFIDENCE_THRESHOLDS) -> Column:
    """The topics of a row whose confidence is under the topic's threshold."""
    flags = [F.when(F.col(confidence(t)) < F.lit(limit), F.lit(t)) for t, limit in thresholds.items()]
    return F.array_compact(F.array(*flags))


def low_confidence(
    predictions: DataFrame,
    reviewed: DataFrame | None = None,
    thresholds: Mapping[str, float] = CONFIDENCE_THRESHOLDS,
    record_id: str = "record_id",
) -> DataFrame:
    """Records with a topic under its threshold that no one has reviewed yet.

    [choice] Reviewed means the record id occurs in the training data.
    """
    low = predictions.withColumn("low_topics", low_topics(thresholds)).filter(F.size("low_topics") > 0)
    if reviewed is None:
        return low
    return low.join(reviewed.select(record_id), record_id, "left_anti")


def reprocess_gate(low: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """How many records are low, how many batches they make, and whether there is one at all."""
    batches = F.ceil(F.col("total_low_confidence_records") / batch_size)
    counted = low.agg(F.count(F.lit(1)).alias("total_low_confidence_records"))
    return counted.select(
        "total_low_confidence_records",
        batches.cast("bigint").alias("batch_count"),
        (F.col("total_low_confidence_records") > 0).alias("run"),
    )


def reprocess_batches(
    low: DataFrame, record_id: str = "record_id", batch_size: int = BATCH_SIZE, seed: int = RANDOM_SEED
) -> DataFrame:
    """All records in numbered batches, in the hash order of the seed.

    Records are numbered inside the first digits of their hash and shifted by
    the records of the smaller ones, so no task sorts the whole table. [choice]
    The order is ours, the seed and the batch size are not.
    """
    keyed = low.withColumn("_order", hash_order(F.col(record_id), seed))
    keyed = keyed.withColumn("_prefix", F.substring("_order", 1, 4))
    # Four hexadecimal digits: 65536 rows at most, whatever the size of the table.
    before = W.orderBy("_prefix").rowsBetween(W.unboundedPreceding, -1)
    shifts = keyed.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_prefix", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift")
    )
    inside = F.row_number().over(W.partitionBy("_prefix").orderBy("_order", record_id))
    numbered = keyed.withColumn("_n", inside).join(shifts, "_prefix")
    batch = F.expr(f"(_shift + _n - 1) div {batch_size}")
    return numbered.withColumn("batch_index", batch).select(*low.columns, "batch_index")


def write_batches(batches: DataFrame, root: str) -> None:
    """JSON lines with their batch, one folder per ``FOLDER_BATCHES`` batches."""
    foldered = batches.withColumn("batch_folder", F.expr(f"batch_index div {FOLDER_BATCHES}"))
    foldered.hint("rebalance", "batch_folder").write.mode("overwrite").partitionBy("batch_folder").json(root)


def combine_corrections(outputs: DataFrame, record_id: str = "record_id", version: str = "batch_index") -> DataFrame:
    """All batch outputs as one table, the latest output per record.

    The largest version with its values combines map-side. A record's values come from one
    output as a whole; NULL topics in it stay NULL.
    """
    values = [c for c in outputs.columns if c not in (record_id, version)]
    latest = F.max(F.struct(F.col(version).alias("_version"), *values)).alias("_latest")
    return outputs.groupBy(record_id).agg(latest).select(record_id, *[f"_latest.`{c}`" for c in values])


def apply_corrections(
    predictions: DataFrame, corrections: DataFrame, record_id: str = "record_id", topics: Sequence[str] = TOPICS
) -> DataFrame:
    """Corrected values over predicted ones; a topic without correction keeps its prediction."""
    fixed = [t for t in topics if t in corrections.columns]
    joined = predictions.alias("p").join(
        corrections.select(record_id, *fixed).alias("c"), F.col(f"p.{record_id}") == F.col(f"c.{record_id}"), "left"
    )
    return joined.select(
        *[F.coalesce(f"c.{c}", f"p.{c}").alias(c) if c in fixed else F.col(f"p.`{c}`") for c in predictions.columns]
    )


def correction_metrics(
    predictions: DataFrame, corrections: DataFrame, record_id: str = "record_id", topics: Sequence[str] = TOPICS
) -> DataFrame:
    """Per topic: records corrected and values that changed."""
    fixed = [t for t in topics if t in corrections.columns]
    joined = predictions.alias("p").join(
        corrections.select(record_id, *fixed).alias("c"), F.col(f"p.{record_id}") == F.col(f"c.{record_id}"), "inner"
    )
    counts = [
        F.struct(
            F.lit(t).alias("topic"),
            F.count(f"c.{t}").alias("corrected"),
            F.count_if(F.col(f"c.{t}").isNotNull() & ~F.col(f"c.{t}").eqNullSafe(F.col(f"p.{t}"))).alias("changed"),
        ).alias(t)
        for t in fixed
    ]
    return joined.agg(*counts).select(F.inline(F.array(*fixed)))


def correction_summary(
    predictions: DataFrame, corrections: DataFrame, record_id: str = "record_id", topics: Sequence[str] = TOPICS
) -> DataFrame:
    """One row: rows, corrected rows, rows replaced by a different value, and the columns that changed."""
    fixed = [t for t in topics if t in corrections.columns]
    joined = predictions.alias("p").join(
        corrections.select(record_id, *fixed).alias("c"), F.col(f"p.{record_id}") == F.col(f"c.{record_id}"), "left"
    )
    changed = {t: F.col(f"c.{t}").isNotNull() & ~F.col(f"c.{t}").eqNullSafe(F.col(f"p.{t}")) for t in fixed}
    counted = joined.agg(
        F.count(F.lit(1)).alias("all_columns_rows"),
        F.count(f"c.{record_id}").alias("corrected_rows"),
        F.count_if(reduce(lambda a, b: a | b, changed.values())).alias("records_replaced"),
        *[F.max(flag).alias(f"_{t}") for t, flag in changed.items()],
    )
    names = F.array_compact(F.array(*[F.when(F.col(f"_{t}"), F.lit(t)) for t in fixed]))
    return counted.select(
        "all_columns_rows",
        "corrected_rows",
        "records_replaced",
        F.size(names).alias("updated_column_count"),
        F.array_join(names, ",").alias("updated_columns"),
    )


def consolidate_runs(outputs: DataFrame, record_id: str = "record_id", run: str = "run_id") -> DataFrame:
    """The outputs of several runs as one table, one row per record. [choice] The latest run wins."""
    latest = W.partitionBy(record_id).orderBy(F.col(run).desc(), content_hash(outputs))
    return outputs.withColumn("_n", F.row_number().over(latest)).filter(F.col("_n") == 1).drop("_n")


def dashboard_trimmed(final: DataFrame, extra: Sequence[str] = (), record_id: str = "record_id") -> DataFrame:
    """The dashboard's columns: id, the six topics and what the caller adds."""
    return final.select(record_id, *extra, *TOPICS)


def dashboard_union(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The dashboard tables of the source systems as one, tagged with their source."""
    tagged = [df.withColumn("source_system", F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
