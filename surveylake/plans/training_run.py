"""Retraining: gate, merge, fit, validate, and the new baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calibration import calibration_counts, calibration_table
from ..operators.scoring import TOPICS
from ..operators.text import clean_prep, model_family
from ..operators.training import (
    SYNTHETIC_ALLOWED,
    classifier_metrics,
    cross_score,
    featurize,
    train_topics,
    training_gate,
    training_merge,
)
from ..sources.tables import path_exists


def last_trained_count(spark: SparkSession, path: str) -> int:
    """Corrected records at the last training; 0 before the first."""
    if not path_exists(spark, path):
        return 0
    row = spark.read.schema("record_count bigint").json(path).first()
    return row.record_count if row else 0


def write_baseline(spark: SparkSession, path: str, record_count: int) -> None:
    spark.createDataFrame([(record_count,)], "record_count bigint").coalesce(1).write.mode("overwrite").json(path)


def training_features(merged: DataFrame) -> DataFrame:
    """Merged training rows with features; a topic's label is NULL where a synthetic row may not train it."""
    texts = clean_prep(merged, "record_id", "text", metadata=["channel", "is_synthetic", *TOPICS])
    synthetic = F.coalesce("is_synthetic", F.lit(False))
    withheld = {t: F.when(~synthetic, F.col(t)) for t in TOPICS if not SYNTHETIC_ALLOWED[t]}
    usable = texts.withColumns(withheld).withColumn("model_family", model_family(F.col("channel")))
    return featurize(usable).drop("customer_text_clean")


def run_training(
    spark: SparkSession, base: DataFrame, corrected: DataFrame, folder: str, minimum: int
) -> tuple[DataFrame, DataFrame | None]:
    """Train all topics when the gate says so. Returns the gate's row and the metrics of the new models.

    Features are written once and read by every fit. Metrics and calibration come from
    predictions on rows their models have not seen; the models themselves are then fitted on
    all rows. The baseline moves only after all of it is stored.
    """
    baseline = f"{folder}/training_record_baseline"
    gate = training_gate(corrected, last_trained_count(spark, baseline), minimum)
    decision = gate.first()
    fixed = spark.createDataFrame([decision], gate.schema)
    if decision.instruction == "SKIP":
        return fixed, None
    training_features(training_merge(base, corrected)).write.mode("overwrite").parquet(f"{folder}/features")
    featured = spark.read.parquet(f"{folder}/features")
    cross_score(featured, f"{folder}/fold_models").drop("features").write.mode("overwrite").parquet(f"{folder}/out_of_fold")
    scored = spark.read.parquet(f"{folder}/out_of_fold")
    classifier_metrics(scored).write.mode("overwrite").parquet(f"{folder}/metrics")
    calibration_table(calibration_counts(scored)).write.mode("overwrite").parquet(f"{folder}/calibration")
    train_topics(featured, f"{folder}/models")
    write_baseline(spark, baseline, decision.current_record_count)
    return fixed, spark.read.parquet(f"{folder}/metrics")
