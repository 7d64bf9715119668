"""Confidences as chances of being right: isotonic calibration per topic and channel family.

[choice] A classifier's own confidence says little about how often it is right, yet the thresholds of the
reprocessing run and of level 3 are chances. Predictions on rows a model has not seen tell the share of right
ones at each confidence; the best non-decreasing fit to these shares is the calibrated confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scoring import FAMILY_TOPICS, TOPICS, confidence

# Steps of confidence that are told apart; with them the table of a topic and family has a fixed size.
BINS = 100
TABLE = "topic string, model_family string, bin int, rows bigint, correct bigint, calibrated double"


def confidence_bin(value: Column, bins: int = BINS) -> Column:
    return F.floor(value * bins).cast("int")


def model_of(topic: str, family: str) -> Column:
    """Topics with one model for all families share one calibration."""
    return F.col(family) if topic in FAMILY_TOPICS else F.lit("default")


def calibration_counts(
    scored: DataFrame, topics: Sequence[str] = TOPICS, bins: int = BINS, family: str = "model_family"
) -> DataFrame:
    """Per topic, family and step of confidence: predictions with a known label, and how many are right."""
    cells = F.array(
        *[
            F.struct(
                F.lit(t).alias("topic"),
                model_of(t, family).alias("model_family"),
                confidence_bin(F.col(confidence(t)), bins).alias("bin"),
                (F.col(t).cast("string") == F.col(f"true_{t}").cast("string")).alias("right"),
            )
            for t in topics
        ]
    )
    rows = scored.select(F.inline(cells)).filter(F.col("right").isNotNull() & F.col("bin").isNotNull())
    counts = (F.count(F.lit(1)).alias("rows"), F.count_if("right").alias("correct"))
    return rows.groupBy("topic", "model_family", "bin").agg(*counts)


def pool_adjacent(counts: Sequence[tuple[int, int]]) -> list[float]:
    """The non-decreasing shares closest to (rows, correct) of each step, weighted by rows."""
    blocks: list[list[int]] = []  # rows, correct, steps
    for rows, correct in counts:
        blocks.append([rows, correct, 1])
        # Whole numbers: shares are compared exactly.
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return [correct / rows for rows, correct, steps in blocks for _ in range(steps)]


def calibration_table(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """The calibrated confidence of every step, also of those without predictions: they take the next lower
    step's, below the first the first one's. A group has ``bins`` + 1 rows at most."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bin")
        frame["calibrated"] = pool_adjacent(list(zip(frame["rows"].tolist(), frame["correct"].tolist())))
        grid = frame.set_index("bin").reindex(range(bins + 1))
        grid["calibrated"] = grid["calibrated"].ffill().bfill()
        grid[["rows", "correct"]] = grid[["rows", "correct"]].fillna(0).astype("int64")
        grid["topic"], grid["model_family"] = frame["topic"].iloc[0], frame["model_family"].iloc[0]
        return grid.reset_index()[["topic", "model_family", "bin", "rows", "correct", "calibrated"]]

    return counts.groupBy("topic", "model_family").applyInPandas(fit, TABLE)


def calibrate(
    scored: DataFrame, table: DataFrame, topics: Sequence[str] = TOPICS, bins: int = BINS, family: str = "model_family"
) -> DataFrame:
    """Confidences replaced by calibrated ones; a model without a calibration keeps its own.

    The table has ``bins`` + 1 rows for each of the nine models, so it enters the plan as values.
    """
    steps: dict[str, dict[str, list[float]]] = {}
    for row in table.select("topic", "model_family", "bin", "calibrated").orderBy("bin").collect():
        steps.setdefault(row.topic, {}).setdefault(row.model_family, []).append(row.calibrated)
    changed = {}
    for topic in topics:
        own = F.col(confidence(topic))
        value = own
        for name, shares in steps.get(topic, {}).items():
            step = F.least(F.greatest(confidence_bin(own, bins), F.lit(0)), F.lit(bins)) + 1
            found = F.when(own.isNotNull(), F.element_at(F.array(*[F.lit(s) for s in shares]), step))
            value = F.when(model_of(topic, family) == name, found).otherwise(value)
        changed[confidence(topic)] = value
    return scored.withColumns(changed)


def calibration_error(
    scored: DataFrame, topics: Sequence[str] = TOPICS, bins: int = 10, family: str = "model_family"
) -> DataFrame:
    """Per topic: mean distance between confidence and share of right predictions, over steps, weighted by rows."""
    cells = F.array(
        *[
            F.struct(
                F.lit(t).alias("topic"), F.col(confidence(t)).alias("confidence"),
                (F.col(t).cast("string") == F.col(f"true_{t}").cast("string")).cast("double").alias("right"),
            )
            for t in topics
        ]
    )
    rows = scored.select(F.inline(cells)).filter(F.col("right").isNotNull() & F.col("confidence").isNotNull())
    steps = rows.groupBy("topic", confidence_bin(F.col("confidence"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.abs(F.avg("confidence") - F.avg("right")).alias("gap")
    )
    return steps.groupBy("topic").agg((F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("calibration_error"))
