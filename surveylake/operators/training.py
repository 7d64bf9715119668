"""Training data, training gate, classifier training and validation.

Only the parameters of these steps are known, not their code; choices marked
[choice] are ours. The trained services become Spark ML models.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveylake.session import scratch_path

from . import topic_model
from .scoring import FAMILIES, FAMILY_TOPICS, TOPICS, confidence, model_key, score_topics

MIN_TEXT_LENGTH = 3
MIN_NEW_RECORDS = 100
RANDOM_SEED = 42
FEATURES = 1 << 14
# Least steps of a topic model, the share by which its perplexity may still change when the passes are doubled, and the
# number of passes as a safeguard only.
LDA_STEPS = 20
LDA_TOLERANCE = 1e-2
LDA_MAX_ITERATIONS = 320
# Columns in which a topic model counts words: what the driver holds of it, times the topics.
TOPIC_COLUMNS = 1 << 14
# A classifier's fit ends when its loss changes by this share or less; the number of iterations is a safeguard only.
FIT_TOLERANCE = 1e-3
FIT_ITERATIONS = 500
# Parts of the training rows, each scored by models that have not seen it.
FOLDS = 5

# May a topic's training set use synthetic rows? (Sentiment had no trained model there; [choice] no.)
SYNTHETIC_ALLOWED = {
    "level2_category": True,
    "level3_subcategory": True,
    "level4_team": True,
    "is_actionable": False,
    "is_urgent": False,
    "overall_sentiment": False,
}


def training_merge(
    base: DataFrame, corrected: DataFrame, record_id: str = "record_id", min_length: int = MIN_TEXT_LENGTH
) -> DataFrame:
    """Base training rows and corrected rows; a corrected record replaces its base row."""
    kept = base.join(corrected.select(record_id).distinct(), record_id, "left_anti")
    merged = kept.unionByName(corrected, allowMissingColumns=True)
    return merged.filter(F.length(F.trim("text")) >= min_length)


def topic_training_rows(
    merged: DataFrame, allowed: Mapping[str, bool] = SYNTHETIC_ALLOWED, record_id: str = "record_id"
) -> DataFrame:
    """Long form: one row per record and labelled topic, synthetic rows only where allowed."""
    present = [t for t in TOPICS if t in merged.columns]
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("topic"), F.col(t).cast("string").alias("label"), F.lit(allowed[t]).alias("_synth"))
            for t in present
        ]
    )
    rows = merged.select(record_id, "text", "is_synthetic", F.inline(cells))
    usable = F.col("label").isNotNull() & (F.col("_synth") | ~F.coalesce("is_synthetic", F.lit(False)))
    return rows.filter(usable).drop("_synth")


def training_gate(corrected: DataFrame, last_trained_count: int, minimum: int = MIN_NEW_RECORDS) -> DataFrame:
    """Retrain when enough corrected records came in since the last training."""
    new = F.col("current_record_count") - F.col("last_trained_record_count")
    return (
        corrected.agg(F.count(F.lit(1)).alias("current_record_count"))
        .withColumn("last_trained_record_count", F.lit(last_trained_count).cast("bigint"))
        .withColumn("new_records_since_training", new)
        .withColumn("should_train", F.col("new_records_since_training") >= minimum)
        .withColumn("instruction", F.when(F.col("should_train"), "CONTINUE").otherwise("SKIP"))
    )


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def featurize(texts: DataFrame, text: str = "customer_text_clean", features: int = FEATURES) -> DataFrame:
    """Add hashed word counts as ``features``.

    Nothing is fitted, so one pass over the texts is enough; the classifiers
    standardize the counts themselves.
    """
    hashing = HashingTF(inputCol="_words", outputCol="features", numFeatures=features)
    return hashing.transform(texts.withColumn("_words", words(F.col(text)))).drop("_words")


def fit_partitions(partitions: int, cores: int, parallel: int) -> int:
    """Partitions of one fit's rows, where `parallel` fits share the cores and the rows are read in so many `partitions`.

    Each iteration shuffles a whole gradient per partition, so a fit takes two rounds of its share of the cores, not a
    partition per core. Rows that are read in more partitions than there are cores keep what is over, so none grows without end.
    """
    return min(partitions, max(math.ceil(2 * cores / parallel), partitions - cores))


def train_topics(
    featured: DataFrame, folder: str, topics: Sequence[str] = TOPICS, family: str = "model_family", parallel: int = 6
) -> dict[str, tuple[Transformer, list[str]]]:
    """One classifier per topic, and per channel family where the topic has two.

    The fits run side by side as Spark jobs over the same stored features. Each
    model is saved under ``folder`` and the saved one is returned: a fitted model
    still holds its training data's session, a loaded one is plain weights. A
    topic with fewer than two labels in its rows gets no model; a family without
    one has no prediction for that topic.
    """
    jobs = []
    for topic in topics:
        if topic in FAMILY_TOPICS:
            jobs += [(model_key(topic, f), topic, featured.filter(F.col(family) == f)) for f in FAMILIES]
        else:
            jobs.append((topic, topic, featured))

    def fit(job):
        key, topic, rows = job
        labelled = rows.filter(F.col(topic).isNotNull()).select("features", F.col(topic).cast("string").alias(topic))
        index = StringIndexer(inputCol=topic, outputCol="label", stringOrderType="alphabetAsc").fit(labelled)
        if len(index.labels) < 2:
            return None
        rows = index.transform(labelled).select("features", "label")
        cores = rows.sparkSession.sparkContext.defaultParallelism
        rows = rows.coalesce(max(1, fit_partitions(rows.rdd.getNumPartitions(), cores, parallel)))
        classifier = LogisticRegression(
            maxIter=FIT_ITERATIONS, tol=FIT_TOLERANCE, regParam=0.01, featuresCol="features", labelCol="label"
        )
        classifier.fit(rows).write().overwrite().save(f"{folder}/{key}")
        return key, (LogisticRegressionModel.load(f"{folder}/{key}"), list(index.labels))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(fitted for fitted in pool.map(fit, jobs) if fitted)


def fold_of(record_id: Column, folds: int = FOLDS, seed: int = RANDOM_SEED) -> Column:
    """The part a record belongs to, by a digest of its id: all rows of a record are in one part, in every run."""
    digest = F.md5(F.concat(record_id.cast("string"), F.lit(f"/{seed}")))
    return F.coalesce(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % folds, F.lit(0)).cast("int")


def cross_score(
    featured: DataFrame,
    folder: str,
    topics: Sequence[str] = TOPICS,
    folds: int = FOLDS,
    record_id: str = "record_id",
    family: str = "model_family",
) -> DataFrame:
    """All rows with predictions of models fitted on the other parts only, and their ``fold``.

    The known labels move to ``true_<topic>``. A topic, or a family's topic, without a model in
    some part has NULL predictions there. ``featured`` should be stored: every fit reads it.
    """
    parted = featured.withColumn("fold", fold_of(F.col(record_id), folds))
    parts = []
    for part in range(folds):
        models = train_topics(parted.filter(F.col("fold") != part), f"{folder}/fold-{part}", topics, family)
        rows = parted.filter(F.col("fold") == part).withColumnsRenamed({t: f"true_{t}" for t in topics})
        if models:
            rows = score_topics(rows.drop(*[t for t in TOPICS if t not in topics]), models, family)
        missing = [t for t in topics if t not in rows.columns]
        rows = rows.withColumns({t: F.lit(None).cast("string") for t in missing})
        parts.append(rows.withColumns({confidence(t): F.lit(None).cast("double") for t in missing}))
    return reduce(DataFrame.unionByName, parts)


def topic_column(word: Column, columns: int = TOPIC_COLUMNS) -> Column:
    """The column of the topic model that a word counts in; words may share one."""
    return F.pmod(F.xxhash64(word), F.lit(columns)).cast("int")


def topic_word_counts(texts: DataFrame, text: str = "customer_text_clean", columns: int = TOPIC_COLUMNS) -> DataFrame:
    """Every word with its column, occurrences and the texts that hold it; combined map-side, kept by Spark.

    A word enters once per occurrence and once per text, so no text's words are compared with each other.
    """
    found = words(F.col(text))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def cells(values: Column, occurrences: Column, holders: Column) -> Column:
        return F.transform(values, lambda w: F.struct(w.alias("term"), occurrences.alias("o"), holders.alias("t")))

    rows = texts.select(F.inline(F.concat(cells(found, one, none), cells(F.array_distinct(found), none, one))))
    counted = rows.groupBy("term").agg(F.sum("o").alias("occurrences"), F.sum("t").alias("texts"))
    return counted.select("term", topic_column(F.col("term"), columns).alias("term_index"), "occurrences", "texts")


def discover_topics(
    texts: DataFrame,
    text: str = "customer_text_clean",
    k: int = 8,
    terms: int = 10,
    columns: int = TOPIC_COLUMNS,
    max_iterations: int = LDA_MAX_ITERATIONS,
) -> DataFrame:
    """Topics found without labels, as weighted terms. [choice] LDA over every word of every text.

    Words are counted in hashed columns, so the model, and with it the driver, holds `k` times `columns` weights
    whatever the vocabulary. The words come back by a join: a column's weight is shared out among its words by
    their occurrences. Each pass takes every text once; passes go on until doubling their number changes the
    perplexity of all texts no more, or `max_iterations` are done.
    """
    spark = texts.sparkSession
    numbered = F.transform(F.coalesce(words(F.col(text)), F.array()), lambda w: topic_column(w, columns))
    model = topic_model.fit(
        texts.select(numbered.alias("columns")), "columns", columns, k, RANDOM_SEED, LDA_TOLERANCE, LDA_STEPS, max_iterations
    )
    path = scratch_path(spark, "topic-words")
    topic_word_counts(texts, text, columns).write.parquet(path)
    vocabulary = spark.read.parquet(path)
    totals = vocabulary.groupBy("term_index").agg(F.sum("occurrences").alias("_total"))
    rows = [(topic, weights.tolist()) for topic, weights in enumerate(model.described())]
    described = spark.createDataFrame(rows, "topic int, weights array<double>").select(
        "topic", F.posexplode("weights").alias("termIndices", "termWeights")
    )
    weights = described.join(totals, F.col("termIndices") == F.col("term_index")).select(
        "topic", "term_index", (F.col("termWeights") / F.col("_total")).alias("_each")
    )
    shared = vocabulary.join(weights, "term_index").withColumn("weight", F.col("_each") * F.col("occurrences"))
    order = W.partitionBy("topic").orderBy(F.col("weight").desc(), "term")
    ranked = shared.withColumn("position", F.row_number().over(order) - 1).filter(F.col("position") < terms)
    return ranked.select("topic", "position", "term", "term_index", "weight", "occurrences", "texts")


def classifier_metrics(scored: DataFrame, topics: Sequence[str] = TOPICS) -> DataFrame:
    """Per topic and label: support, predicted, correct, precision, recall; one aggregation.

    ``scored`` holds the known label as ``true_<topic>`` and the predicted one as
    ``<topic>``.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(t).alias("topic"),
                F.col(f"true_{t}").cast("string").alias("actual"),
                F.col(t).cast("string").alias("predicted"),
            )
            for t in topics
        ]
    )
    pairs = (
        scored.select(F.inline(cells))
        .filter(F.col("actual").isNotNull())
        .groupBy("topic", "actual", "predicted")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    hit = F.col("actual") == F.col("predicted")
    sides = pairs.select(
        "topic",
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted_rows"),
                    F.when(hit, F.col("n")).otherwise(0).alias("correct"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("predicted_rows"),
                    F.lit(0).cast("bigint").alias("correct"),
                ),
            )
        ),
    )
    totals = (
        sides.filter(F.col("label").isNotNull())
        .groupBy("topic", "label")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted_rows").alias("predicted_rows"),
            F.sum("correct").alias("correct"),
        )
    )
    return totals.withColumn("precision", F.try_divide("correct", "predicted_rows")).withColumn(
        "recall", F.try_divide("correct", "support")
    )
