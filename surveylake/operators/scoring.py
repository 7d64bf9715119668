"""Topic scoring of cleaned text with Spark ML models.

The services that scored texts are replaced by classifiers trained here
(``training``): one per topic, and for the three category levels one more for
the sms/web channels.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six topics and the thresholds of the reprocessing run.
TOPICS = (
    "overall_sentiment",
    "level2_category",
    "level3_subcategory",
    "level4_team",
    "is_actionable",
    "is_urgent",
)
CONFIDENCE_THRESHOLDS = {topic: 0.5 for topic in TOPICS}

# Topics whose model depends on the channel family.
FAMILY_TOPICS = ("level2_category", "level3_subcategory", "level4_team")
FAMILIES = ("default", "sms_web")
LEVEL3_CONFIDENCE_THRESHOLD = 0.75


def model_key(topic: str, family: str) -> str:
    return f"{topic}_{family}" if topic in FAMILY_TOPICS and family != "default" else topic


def confidence(topic: str) -> str:
    return f"{topic}_confidence"


def score_topic(featured: DataFrame, topic: str, model: Transformer, labels: list[str]) -> DataFrame:
    """Add the topic's label and its confidence; a map-only step."""
    columns = featured.columns
    scored = model.transform(featured)
    probability = vector_to_array(F.col("probability"))
    best = F.array_position(probability, F.array_max(probability)).cast("int")
    names = F.array(*[F.lit(name) for name in labels])
    return scored.select(
        *columns,
        F.element_at(names, best).alias(topic),
        F.array_max(probability).alias(confidence(topic)),
    )


def withhold_level3(df: DataFrame, threshold: float = LEVEL3_CONFIDENCE_THRESHOLD) -> DataFrame:
    """[choice] A level-3 label under its confidence threshold becomes NULL."""
    topic = "level3_subcategory"
    return df.withColumn(topic, F.when(F.col(confidence(topic)) >= threshold, F.col(topic)))


def score_topics(
    featured: DataFrame, models: Mapping[str, tuple[Transformer, list[str]]], family: str = "model_family"
) -> DataFrame:
    """Score every topic that has a model, each row with the models of its family.

    Rows are split by family so that every row passes each of its models once. A
    family without a model for a topic gets NULLs there.
    """
    topics = [t for t in TOPICS if any(model_key(t, f) in models for f in FAMILIES)]

    def scored(name: str) -> DataFrame:
        part = featured.filter(F.col(family) == name)
        for topic in topics:
            if model_key(topic, name) in models:
                part = score_topic(part, topic, *models[model_key(topic, name)])
            else:
                empty = {topic: F.lit(None).cast("string"), confidence(topic): F.lit(None).cast("double")}
                part = part.withColumns(empty)
        return part

    return reduce(DataFrame.unionByName, [scored(name) for name in FAMILIES])


def to_long(df: DataFrame, record_id: str = "record_id") -> DataFrame:
    """One row per record and topic: topic, label, confidence."""
    topics = F.array(
        *[
            F.struct(
                F.lit(t).alias("topic"),
                F.col(t).cast("string").alias("label"),
                F.col(confidence(t)).alias("confidence"),
            )
            for t in TOPICS
        ]
    )
    return df.select(record_id, F.inline(topics))


def assemble_predictions(raw: DataFrame, predictions: DataFrame, record_id: str = "record_id") -> DataFrame:
    """Put the long predictions of all topics side by side on the raw rows.

    One conditional aggregation, combined map-side, and one left join replace a
    join per topic.
    """

    def of(topic: str, value: str) -> Column:
        return F.max(F.when(F.col("topic") == topic, F.col(value)))

    wide = predictions.groupBy(record_id).agg(
        *[of(t, "label").alias(t) for t in TOPICS], *[of(t, "confidence").alias(confidence(t)) for t in TOPICS]
    )
    return raw.join(wide, record_id, "left")
