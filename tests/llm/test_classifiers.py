from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward
from pyspark.sql import Window
from pyspark.sql import functions as F

from surveylake.llm import language, queries, toxicity
from surveylake.llm.grams import WordGrams, sums_of_runs
from surveylake.llm.words import fitting_texts


def in_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_grams_of_a_word_do_not_depend_on_its_neighbours():
    words = ["idiot", "Idiot", "a", "", "loweiä"]
    alone = [WordGrams(pa.array([w.encode()]), (0, 2, 4), 10) for w in words]
    together = WordGrams(pa.array([w.encode() for w in words]), (0, 2, 4), 10)
    for i in range(3):
        assert together.buckets[i].tolist() == [b for g in alone for b in g.buckets[i].tolist()]
    table = np.random.default_rng(0).standard_normal((1 << 10, 3)).astype(np.float32)
    assert np.allclose(together.sums(table), np.concatenate([g.sums(table) for g in alone]), atol=1e-5)
    assert np.allclose(together.sums(table)[0], together.sums(table)[1], atol=1e-5)


def test_network_scores_are_those_of_plain_loops():
    network = toxicity.Network(3)
    texts = ["a b c d", "", "one", None, "x " * 30]
    words = toxicity.split_words(pa.array(texts))
    emb = toxicity.embed(WordGrams(words.vocabulary, toxicity.GRAMS, toxicity.BUCKET_BITS), network.E)
    got = network.logits(words, emb)
    for i in range(len(texts)):
        rows = [emb[c] for c in words.codes[words.bounds[i] : words.bounds[i + 1]]] + [np.zeros(toxicity.DIM)] * 3
        pooled, block = [], 0
        for width in toxicity.WIDTHS:
            w = [network.W[:, (block + k) * 16 : (block + k + 1) * 16] for k in range(width)]
            pooled.append(np.max([sum(rows[t + k] @ w[k] for k in range(width)) for t in range(len(rows) - width + 1)], axis=0))
            block += width
        want = np.maximum(np.concatenate(pooled) + network.b, 0) @ network.v + network.c[0]
        assert abs(got[i] - want) < 1e-3


def test_threshold_is_the_middle_of_the_gap():
    assert toxicity.threshold(np.array([1.0, 2.0, 5.0, 6.0]), np.array([0, 0, 1, 1]), np.ones(4)) == 3.5


@pytest.fixture(scope="module")
def toxic_scores(spark, medium):
    return {r.doc_id: r for r in queries.QUERIES["op8_toxicity"](spark, medium).collect()}


def test_toxicity_on_held_out_rows(spark, medium, toxic_scores):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    assert len(toxic_scores) == 1000
    for r in toxic_scores.values():
        assert r.held_out == in_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(toxic_scores[d].predicted, toxic_scores[d].score, t) for d, t in labels.items() if in_held_out(d)]
    found = sum(p == t == 1 for p, _, t in held)
    toxic, clean = ([s for _, s, t in held if t == kind] for kind in (1, 0))
    # A constant answer reaches none of these three.
    assert found / len(toxic) >= 0.6 and found / max(1, sum(p for p, _, _ in held)) >= 0.8
    assert sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean)) > 0.9


def test_held_out_labels_are_never_learned(spark, medium, toxic_scores):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", (toxicity.fold(labels.doc_id) == 0).cast("int").bitwiseXOR(labels.toxic))
    model = toxicity.train(docs, turned)
    again = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    assert all(abs(again[d] - r.score) < 1e-9 for d, r in toxic_scores.items())


def test_toxicity_awkward_rows(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score_documents(docs, toxicity.train(docs, none)).collect()} == {0.0}
    one_kind = spark.createDataFrame([(i, 0, 1) for i in range(9)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score_documents(docs, toxicity.train(docs, one_kind)).collect()} == {1.0}
    mixed = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (2, 0, 0), (6, 0, 0), (8, 0, 1), (7, 0, None), (None, 0, 1), (77, 0, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    scores = toxicity.score_documents(docs, toxicity.train(docs, mixed)).collect()
    assert len(scores) == 12 and all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if r.doc_id in (3, 4, 5)}) == 1
    empty = awkward(spark, [])
    assert toxicity.score_documents(empty, toxicity.train(empty, none)).count() == 0


def test_language_on_held_out_rows(spark, medium):
    rows = queries.QUERIES["op9_language"](spark, medium).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if in_held_out(d)}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.96


def test_families_come_first():
    assert language.family_of("en") == language.family_of("de-AT") == "germanic" and language.family_of("xx") == "only xx"
    texts = ["the and of " * 20, "der und die " * 20, "le et les " * 20, "el y los " * 20, "zzz qqq " * 20] * 4
    model = language.Predictor(language.fit(pa.array(texts), ["en", "de", "fr", "es", "xx"] * 4))
    assert model.families == ["germanic", "only xx", "romance"] and model.pairs == [[0, 1], [2, 3]]
    names, scores = model.predict(pa.array(["the of and", "el los y", "qqq", "12 34", None, "", "的"]))
    assert names[:3] == ["en", "es", "xx"] and names[3:6] == ["und"] * 3 and names[6] != "und"
    assert (scores[3:6] == 0).all()


def test_language_awkward_rows(spark):
    docs = awkward(spark)
    rows = language.identify(docs, language.train(docs)).collect()
    assert len(rows) == 12
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    single = language.identify(docs, language.train(docs.filter("lang = 'de'"))).collect()
    assert {r.lang_pred for r in single} == {"de", "und"}
    empty = awkward(spark, [])
    assert language.identify(empty, language.train(empty)).count() == 0
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}


def test_rows_that_a_fit_may_hold_are_bounded(spark):
    """A repeated id gives one text, and a group's texts stay under its share of the bytes."""
    rows = [(1, "same", "a")] * 50 + [(1, f"other {i}", "a") for i in range(50)] + [(i, "x" * 10, "b") for i in range(10)]
    rows += [(99, None, "c"), (98, "", "c"), (97, "y" * 1000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    held = fitting_texts(df, "kind", 55).collect()
    assert sorted((r.kind, r.doc_id) for r in held if r.kind != "b") == [("a", 1), ("c", 98), ("c", 99)]
    assert len([r for r in held if r.kind == "b"]) == 5
    again = fitting_texts(df.orderBy("text"), "kind", 55).collect()
    assert sorted(map(repr, held)) == sorted(map(repr, again))
    assert fitting_texts(df.limit(0), "kind", 55).count() == 0


def test_a_long_tail_of_languages_does_not_stop_the_fit(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    rows = [(i, "the and of it " * 9, "en") for i in range(60)] + [(100 + i, "der und die das " * 9, "de") for i in range(60)]
    rows += [(200 + i, "stray words here", f"q{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {(r.doc_id, r.lang_pred) for r in language.identify(docs, language.train(docs)).collect()}
    assert {name for _, name in found} == {"de", "en"}
    assert all((i, "en") in found and (100 + i, "de") in found for i in range(60))


@pytest.mark.parametrize("shard_rows", [1 << 14, 800])
def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch, shard_rows):
    """A word that only the toxic ids last by hash hold, beyond the 2500 that were learned from before."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", shard_rows, raising=False)
    ids = spark.range(8000).withColumnRenamed("id", "doc_id").filter(toxicity.fold(F.col("doc_id")) != 0)
    ids = ids.withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id")))
    word = F.when(F.col("toxic") == 0, F.lit("kindly")).when(place <= 2500, F.lit("rotten")).otherwise(F.lit("vicious"))
    rows = ids.select("doc_id", "toxic", F.concat(F.lit("they are "), word, F.lit(" people n"), F.col("doc_id") % 7).alias("text"))
    rows = rows.localCheckpoint()
    assert rows.filter("text like '%vicious%'").count() > 500
    model = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    asked = spark.createDataFrame([(1, "they are vicious people n1"), (2, "they are kindly people n1"), (3, "they are rotten people n1")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score_documents(asked, model).collect()}
    assert scores[1] >= 0.5 > scores[2] and scores[3] >= 0.5


def test_thresholds_of_counts_are_those_of_all_rows():
    rng = np.random.default_rng(2)
    labels, groups = rng.integers(0, 2, 400), rng.integers(0, 2, 400)
    logits = np.round(rng.standard_normal(400) + labels * 2, 1)
    prior = np.array([0.9, 0.1]) / np.bincount(labels)
    counts = {}
    for key in zip(groups.tolist(), labels.tolist(), logits.tolist()):
        counts[key] = counts.get(key, 0) + 1
    cuts = toxicity.thresholds([(*key, n) for key, n in sorted(counts.items())], prior)
    for g in (0, 1):
        own = groups == g
        order = np.argsort(logits[own], kind="stable")
        cut = cuts[g]
        best = max(
            2 * prior[1] * ((logits[own] > c) & (labels[own] == 1)).sum()
            / (prior[labels[own]] @ (logits[own] > c) + prior[1] * (labels[own] == 1).sum())
            for c in logits[own][order] - 0.05
        )
        got = 2 * prior[1] * ((logits[own] > cut) & (labels[own] == 1)).sum() / (prior[labels[own]] @ (logits[own] > cut) + prior[1] * (labels[own] == 1).sum())
        assert abs(got - best) < 1e-9
    assert (toxicity.thresholds([], prior) == 0).all()


def test_buckets_of_words_are_those_of_each_word_alone():
    words = [b"idiot", b"a", b"", "loweiä".encode()]
    grams = WordGrams(pa.array(words), toxicity.GRAMS, toxicity.BUCKET_BITS)
    flat, sizes = toxicity.of_words(*toxicity.bucket_lists(grams), np.array([3, 0, 2]))
    alone = [np.concatenate(WordGrams(pa.array([w]), toxicity.GRAMS, toxicity.BUCKET_BITS).buckets) for w in (words[3], words[0], words[2])]
    assert flat.tolist() == np.concatenate(alone).tolist() and sizes.tolist() == [len(a) for a in alone]


def test_texts_are_moved_once_and_mostly_with_labels(spark, monkeypatch, capsys):
    """Without broadcasts of tables, as over large ones: one exchange holds texts, and few of them lack a label."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 500)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    ids = spark.range(8000).withColumnRenamed("id", "doc_id")
    docs = ids.withColumn("text", F.concat(F.lit("some words of "), F.col("doc_id"))).localCheckpoint()
    docs = docs.union(docs.filter("doc_id < 50")).union(spark.createDataFrame([(None, "no id")], "doc_id long, text string"))
    labels = ids.filter("doc_id % 4 = 0").select("doc_id", (F.col("doc_id") % 8 == 0).cast("int").alias("toxic")).localCheckpoint()
    plans, gathered, real = [], {}, toxicity.stored

    def watched(df, label):
        if label == "toxicity-rows":
            df.explain("formatted")
            plans.append(capsys.readouterr().out)
        gathered[label] = real(df, label)
        return gathered[label]

    monkeypatch.setattr(toxicity, "stored", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.train(docs, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    exchanges = [part for part in plans[0].split("\n\n") if ") Exchange" in part.split("\n")[0]]
    assert sum("text#" in part for part in exchanges) == 1
    known = gathered["toxicity-labels"]
    n = known.count()
    want = sorted(f"some words of {r.doc_id}" for r in known.collect())
    assert sorted(r.text for r in gathered["toxicity-rows"].collect()) == want
    let_through = toxicity.perhaps_known(docs, known, n)
    assert n <= let_through.select("doc_id").distinct().count() < n + 0.2 * 8000
    monkeypatch.setattr(toxicity, "MOST_SLOTS", 64)
    kept = {r.doc_id for r in toxicity.perhaps_known(docs, known, n).collect()}
    assert kept == {r.doc_id for r in docs.filter("doc_id is not null").filter(toxicity.fold(F.col("doc_id")) != 0).collect()}


def test_sums_of_runs_are_those_of_numpy_to_the_last_bit():
    rng = np.random.default_rng(4)
    table = rng.standard_normal((500, 16)).astype(np.float32)
    counts = np.concatenate([rng.integers(1, 30, 400), rng.integers(1, 300, 40), [1, 8, 9, 16, 17, 128, 129]])
    begins, buckets = np.cumsum(counts) - counts, rng.integers(0, 500, counts.sum())
    want = np.add.reduceat(table[buckets], begins, axis=0)
    assert np.array_equal(sums_of_runs(table, buckets, begins, counts), want)
    assert sums_of_runs(table, buckets[:0], begins[:0], counts[:0]).shape == (0, 16)


def test_language_groups_are_those_of_each_word():
    place = {w.encode(): i for i, group in enumerate(toxicity.FUNCTION_WORDS.values()) for w in group}
    texts = ["The, cat and... the DOG", "der und the", "", None, "...", "chat Les; des! le?", "zzz qqq", "Été los él y K", ",en:en por", "the\x1cthe x"]
    got = toxicity.language_groups(toxicity.split_words(pa.array(texts)))
    for text, group in zip(texts, got):
        words = toxicity.split_words(pa.array([text]))
        own = [place.get(words.vocabulary[c].as_py().lower().strip(b".,;:!?")) for c in words.codes]
        counts = [own.count(i) for i in range(4)]
        assert group == (counts.index(max(counts)) if max(counts) else 4)
    assert toxicity.language_groups(toxicity.split_words(pa.array([], pa.string()))).tolist() == []
