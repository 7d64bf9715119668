"""From final responses to scored topics, corrections and dashboards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..channels import Channel
from ..operators.calibration import calibrate
from ..operators.corrections import (
    apply_corrections,
    combine_corrections,
    dashboard_trimmed,
    low_confidence,
    reprocess_batches,
    write_batches,
)
from ..operators.scoring import TOPICS, confidence, score_topics, withhold_level3
from ..operators.text import clean_prep, model_family, scorable
from ..operators.training import featurize


def prepare(final: DataFrame, channel: Channel) -> DataFrame:
    """Cleaned texts of one channel, all that aren't empty, with their model family."""
    language = channel.language_column if channel.language_column in final.columns else None
    fallback = channel.fallback_text_column if channel.fallback_text_column in final.columns else None
    usable = scorable(final, channel.text_column, fallback)
    cleaned = clean_prep(usable, "contact_record_id", channel.text_column, fallback, language)
    return cleaned.withColumn("model_family", model_family(F.lit(channel.name)))


def score(
    texts: DataFrame, models: Mapping[str, tuple[Transformer, list[str]]], calibration: DataFrame | None = None
) -> DataFrame:
    """Topic labels and confidences per record; map-only over the texts.

    With the training run's calibration table the confidences, and so all thresholds on them, are
    chances of being right.
    """
    scored = score_topics(featurize(texts), models)
    if calibration is not None:
        scored = calibrate(scored, calibration, [t for t in TOPICS if t in scored.columns])
    scored = withhold_level3(scored)
    return scored.select("record_id", *TOPICS, *[confidence(t) for t in TOPICS])


def final_output(raw: DataFrame, scored: DataFrame, record_id: str = "contact_record_id") -> DataFrame:
    """Raw rows with their predictions; rows without a scorable text keep NULLs."""
    return raw.join(scored.withColumnRenamed("record_id", record_id), record_id, "left")


def reprocessing_input(output: DataFrame, reviewed: DataFrame | None, root: str, record_id: str) -> None:
    """Write the batches of records to look at again."""
    low = low_confidence(output, reviewed, record_id=record_id)
    write_batches(reprocess_batches(low, record_id), root)


def corrected_dashboards(
    output: DataFrame, batch_outputs: DataFrame, record_id: str
) -> tuple[DataFrame, DataFrame]:
    """All-columns and trimmed dashboard with the combined corrections laid over."""
    corrected = apply_corrections(output, combine_corrections(batch_outputs, record_id), record_id)
    return corrected, dashboard_trimmed(corrected, record_id=record_id)
