"""Features, scoring, metrics and topic discovery against brute force on small rows."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from surveylake.operators import topic_model
from surveylake.operators.calibration import (
    calibrate,
    calibration_counts,
    calibration_error,
    calibration_table,
    pool_adjacent,
)
from surveylake.operators.scoring import TOPICS, model_key, score_topics, withhold_level3
from surveylake.operators.training import (
    TOPIC_COLUMNS,
    classifier_metrics,
    cross_score,
    discover_topics,
    featurize,
    fit_partitions,
    fold_of,
    topic_column,
    topic_training_rows,
    topic_word_counts,
    train_topics,
    words,
)
from surveylake.session import scratch_path

ROWS = [
    (i, text, "sms_web" if i % 2 else "default", label)
    for i, (text, label) in enumerate(
        [("great quick help", "good"), ("slow rude agent", "bad"), ("Great, great service", "good"),
         ("rude and slow", "bad"), ("quick service!", "good"), ("slow slow slow", "bad"),
         ("great help", "good"), ("rude service", "bad")]
    )
]


@pytest.fixture(scope="module")
def featured(spark):
    df = spark.createDataFrame(ROWS, "record_id int, customer_text_clean string, model_family string, is_urgent string")
    path = scratch_path(spark, "model-test")
    # The sms/web rows know one category only, so that family gets no model for it.
    level2 = F.when(F.col("model_family") == "default", F.col("is_urgent")).otherwise("only")
    level2 = F.when(F.col("record_id") == 0, "other").otherwise(level2)
    featurize(df.withColumn("level2_category", level2), features=64).write.parquet(path)
    return spark.read.parquet(path)


def test_features_are_word_counts(featured):
    for row in featured.collect():
        counts = Counter(w for w in re.split(r"[^a-z0-9]+", row.customer_text_clean.lower()) if w)
        assert sum(row.features.values) == sum(counts.values())
        assert row.features.numNonzeros() <= len(counts)


@pytest.fixture(scope="module")
def models(spark, featured):
    return train_topics(featured, scratch_path(spark, "models"), ["is_urgent", "level2_category"])


def test_one_model_per_topic_and_family(models):
    assert set(models) == {"is_urgent", "level2_category"}
    assert models["is_urgent"][1] == ["bad", "good"]
    assert model_key("level2_category", "sms_web") == "level2_category_sms_web"
    assert model_key("is_urgent", "sms_web") == "is_urgent"


def test_scores_are_the_models_probabilities(featured, models):
    model, labels = models["is_urgent"]
    renamed = featured.withColumnsRenamed({t: f"true_{t}" for t in ("is_urgent", "level2_category")})
    scored = {r.record_id: r for r in score_topics(renamed, models).collect()}
    assert len(scored) == len(ROWS)
    for row in featured.collect():
        margin = float(model.coefficients.dot(row.features)) + model.intercept
        good = 1 / (1 + math.exp(-margin))
        assert scored[row.record_id].is_urgent == ("good" if good > 0.5 else "bad") == row.is_urgent
        assert scored[row.record_id].is_urgent_confidence == pytest.approx(max(good, 1 - good))
        has_model = row.model_family == "default"
        assert (scored[row.record_id].level2_category is not None) == has_model


def test_level3_below_threshold_is_withheld(spark):
    df = spark.createDataFrame([("a", 0.75), ("b", 0.7499), ("c", None)], "level3_subcategory string, level3_subcategory_confidence double")
    assert [r[0] for r in withhold_level3(df).select("level3_subcategory").collect()] == ["a", None, None]


def test_metrics_by_hand(spark):
    pairs = [("x", "x"), ("x", "y"), ("y", "y"), ("y", "y"), (None, "x"), ("z", None)]
    df = spark.createDataFrame(pairs, "true_is_urgent string, is_urgent string")
    rows = {r.label: r for r in classifier_metrics(df, ["is_urgent"]).collect()}
    assert (rows["x"].support, rows["x"].predicted_rows, rows["x"].correct, rows["x"].precision) == (2, 1, 1, 1.0)
    assert rows["y"].precision == pytest.approx(2 / 3) and rows["y"].recall == 1.0
    assert rows["z"].precision is None and rows["z"].recall == 0.0


def test_synthetic_rows_train_only_some_topics(spark):
    df = spark.createDataFrame(
        [(1, "text", "l2", "yes", True), (2, "text", "l2", "no", False), (3, "text", None, "no", None)],
        "record_id int, text string, level2_category string, is_urgent string, is_synthetic boolean",
    )
    rows = {(r.record_id, r.topic) for r in topic_training_rows(df).collect()}
    assert rows == {(1, "level2_category"), (2, "level2_category"), (2, "is_urgent"), (3, "is_urgent")}


def test_discovered_topics_have_ranked_terms(spark):
    texts = [("bill payment charge " * 3,), ("power outage storm " * 3,)] * 10
    df = spark.createDataFrame(texts, "customer_text_clean string")
    rows = discover_topics(df, k=2, terms=3).orderBy("topic", "position").collect()
    assert len(rows) == 6 and {r.term for r in rows} <= {"bill", "payment", "charge", "power", "outage", "storm"}
    for topic in (0, 1):
        weights = [r.weight for r in rows if r.topic == topic]
        assert weights == sorted(weights, reverse=True)


def test_topics_are_found_over_every_word(spark):
    texts = [("no ok",), ("bill payment charge",), ("power outage storm",)] * 5 + [("onceonly",)]
    df = spark.createDataFrame(texts, "customer_text_clean string")
    rows = discover_topics(df, k=2, terms=20).collect()
    assert {r.term for r in rows} == {"no", "ok", "bill", "payment", "charge", "power", "outage", "storm", "onceonly"}


def test_topic_order():
    assert len(TOPICS) == 6 and TOPICS[0] == "overall_sentiment"


# --- parts, calibration, hashed topics --------------------------------------------------------


def test_no_row_is_scored_by_its_own_model(spark, featured):
    topics, folder = ["is_urgent"], scratch_path(spark, "folds")
    scored = cross_score(featured, folder, topics, folds=3)
    rows = {r.record_id: r for r in scored.collect()}
    assert sorted(rows) == [r[0] for r in ROWS]
    parted = {r.record_id: r.fold for r in featured.select("record_id", fold_of(F.col("record_id"), 3).alias("fold")).collect()}
    assert {r.fold for r in rows.values()} == set(parted.values()) and len(set(parted.values())) > 1
    for part in set(parted.values()):
        others = featured.filter(F.col("record_id").isin([i for i, f in parted.items() if f != part]))
        model, labels = train_topics(others, scratch_path(spark, "other"), topics)["is_urgent"]
        for row in featured.filter(F.col("record_id").isin([i for i, f in parted.items() if f == part])).collect():
            good = 1 / (1 + math.exp(-(float(model.coefficients.dot(row.features)) + model.intercept)))
            got = rows[row.record_id]
            assert got.is_urgent_confidence == pytest.approx(max(good, 1 - good)) and got.true_is_urgent == row.is_urgent


def test_parts_without_a_model_have_no_prediction(spark, featured):
    one = featured.filter("is_urgent = 'good'")
    rows = cross_score(one, scratch_path(spark, "folds"), ["is_urgent"], folds=2).collect()
    assert len(rows) == 4 and all(r.is_urgent is None and r.is_urgent_confidence is None for r in rows)
    repeated = spark.createDataFrame([(1,), (1,), (None,)], "record_id int").select(fold_of(F.col("record_id"))).collect()
    assert repeated[0] == repeated[1] and repeated[2][0] == 0


def best_shares(counts):
    """The non-decreasing fit as the largest of the least mean shares."""
    n = len(counts)

    def share(j, k):
        return sum(c for _, c in counts[j : k + 1]) / sum(r for r, _ in counts[j : k + 1])

    return [max(min(share(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30).flatmap(lambda n: st.tuples(st.just(n), st.integers(0, n))), min_size=1, max_size=12))
def test_pooled_shares_are_the_best_ones(counts):
    fitted = pool_adjacent(counts)
    assert fitted == pytest.approx(best_shares(counts)) and fitted == sorted(fitted)


def calibration_rows(spark):
    rows = [(i, "default" if i % 2 else "sms_web", i / 200, "a", "a" if (i * 7919) % 200 < i * (1 if i % 2 else 0.5) else "b") for i in range(200)]
    rows += [(500, "default", None, None, "a"), (501, "default", 1.0, "a", None), (502, "default", 1.0, "a", "a")]
    schema = "record_id int, model_family string, level2_category_confidence double, level2_category string, true_level2_category string"
    return spark.createDataFrame(rows, schema)


def test_calibration_by_family_and_step(spark):
    scored, topics = calibration_rows(spark), ["level2_category"]
    counts = calibration_counts(scored, topics)
    assert counts.agg(F.sum("rows")).first()[0] == 201
    table = calibration_table(counts)
    fitted = {(r.model_family, r.bin): r for r in table.collect()}
    assert len(fitted) == 2 * 101
    for family in ("default", "sms_web"):
        known = sorted((r.bin, r.rows, r.correct) for (f, _), r in fitted.items() if f == family and r.rows)
        expected = best_shares([(n, c) for _, n, c in known])
        assert [fitted[family, b].calibrated for b, *_ in known] == pytest.approx(expected)
        every = [fitted[family, b].calibrated for b in range(101)]
        assert every == sorted(every)
    path = scratch_path(spark, "calibration")
    table.write.parquet(path)
    own = {r.record_id: r.level2_category_confidence for r in scored.collect()}
    for row in calibrate(scored, spark.read.parquet(path), topics).collect():
        new, old = row.level2_category_confidence, own[row.record_id]
        assert new == (None if old is None else fitted[row.model_family, math.floor(old * 100)].calibrated)


def test_calibrated_confidences_are_nearer_to_the_truth(spark):
    scored, topics = calibration_rows(spark), ["level2_category"]
    path = scratch_path(spark, "calibration")
    calibration_table(calibration_counts(scored, topics)).write.parquet(path)
    before, after = (
        calibration_error(df, topics).first().calibration_error
        for df in (scored, calibrate(scored, spark.read.parquet(path), topics))
    )
    assert after < before
    none = calibrate(scored, spark.read.parquet(path).limit(0), topics)
    assert calibration_error(none, topics).first().calibration_error == before


def test_words_come_back_from_shared_columns(spark):
    texts = [("bill payment charge bill",), ("power outage storm",), (None,), ("",)] * 5
    df = spark.createDataFrame(texts, "customer_text_clean string")
    counts = {r.term: (r.occurrences, r.texts) for r in topic_word_counts(df, columns=2).collect()}
    assert counts == {"bill": (10, 5), **{w: (5, 5) for w in ("payment", "charge", "power", "outage", "storm")}}
    rows = discover_topics(df, k=2, terms=10, columns=2, max_iterations=10).collect()
    assert {r.term for r in rows} == set(counts) and len(rows) == 12
    columns = {}
    for r in rows:
        columns.setdefault((r.topic, r.term_index), []).append((r.weight / r.occurrences))
    # Words of one column share its weight by their occurrences.
    assert all(max(each) == pytest.approx(min(each)) for each in columns.values())
    # Every column holds a word here, so nothing of a topic's weight is lost.
    assert {r.term_index for r in rows} == {0, 1}
    for topic in (0, 1):
        assert sum(r.weight for r in rows if r.topic == topic) == pytest.approx(1)


def test_every_text_enters_each_pass_once(spark, monkeypatch):
    monkeypatch.setattr(topic_model, "PART_TEXTS", 4)
    texts = [("bill payment charge bill",), ("power outage storm",), (None,), ("",)] * 10
    df = spark.createDataFrame(texts, "customer_text_clean string")
    numbered = df.select(F.transform(F.coalesce(words(F.col("customer_text_clean")), F.array()), lambda w: topic_column(w)).alias("c"))
    seen, step = [], topic_model._step

    def counted_step(counted, parts, topics, texts):
        bound, held = step(counted, parts, topics, texts)
        seen.append(held)
        return bound, held

    monkeypatch.setattr(topic_model, "_step", counted_step)
    model = topic_model.fit(numbered, "c", TOPIC_COLUMNS, 2, 42, 1e-2, 20, 64)
    # 20 texts with 70 words in five parts; the passes go on from each other, and none draws a text twice.
    passes = [sum(seen[i : i + 5]) for i in range(0, len(seen), 5)]
    assert len(seen) % 5 == 0 and model.steps <= len(seen) and set(passes) == {70}
    assert 0 < model.perplexity < math.log(TOPIC_COLUMNS)


def test_topic_functions():
    for x in (0.01, 0.5, 3.0, 2e4):
        near = np.array([x * (1 - 1e-5), x, x * (1 + 1e-5)])
        logs, psi = [math.lgamma(v) for v in near], topic_model.digamma(near)
        assert topic_model.log_gamma(near) == pytest.approx(logs, rel=1e-8, abs=1e-8)
        assert psi[1] == pytest.approx((logs[2] - logs[0]) / (near[2] - near[0]), rel=1e-4)
        assert topic_model.trigamma(near)[1] == pytest.approx((psi[2] - psi[0]) / (near[2] - near[0]), rel=1e-4)


def test_a_fit_takes_its_share_of_the_cores():
    # 12 cores, 6 fits: the partitions, each of which shuffles a gradient per iteration, do not grow with the rows.
    assert [fit_partitions(n, 12, 6) for n in (1, 3, 12, 16)] == [1, 3, 4, 4]
    assert fit_partitions(160, 12, 6) == 148 and fit_partitions(40, 8, 1) == 32


def test_training_shuffles_no_more_with_more_partitions(spark, featured, monkeypatch):
    seen, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, rows: seen.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    cores = spark.sparkContext.defaultParallelism
    train_topics(featured.repartition(cores), scratch_path(spark, "models"), ["is_urgent"], parallel=2 * cores)
    assert seen == [1]
