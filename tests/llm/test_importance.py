from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from compare import compare, connect
from helpers import awkward, awkward_rows

from surveylake.llm import importance, queries


def naive(docs, target, share=10, max_n=1, buckets=10_000, min_words=20):
    """(doc_id, n_features, weight, score, rank) by joined n-grams."""

    def features(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        grams = [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
        return len(words), [crc32(g.encode()) % buckets for g in grams]

    every = [(doc_id, *features(text)) for doc_id, text in docs]
    s, t = Counter(b for *_, f in every for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    rows = []
    for doc_id, n_words, f in every:
        h = int(sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append((doc_id, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = share * len(able) // 100
    ranks = [(r[0], *r[2:], i + 1 if i < drawn else None) for i, r in enumerate(able)]
    return ranks + [(r[0], *r[2:], None) for r in rows if r[1] < min_words]


def result(found):
    return sorted(map(repr, ((r.doc.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect())))


@pytest.mark.parametrize("max_n", [1, 3])
def test_is_brute_force(spark, small, docs_small, max_n):
    target = spark.read.parquet(f"{small}/benchmark.parquet")
    found = importance.resample(docs_small, target, share=30, max_n=max_n)
    expected = naive(
        [(r.doc_id, r.text) for r in docs_small.collect()], [r.text for r in target.collect()], share=30, max_n=max_n
    )
    assert result(found) == sorted(map(repr, expected))


def test_matches_sql(spark, small):
    assert compare(queries.QUERIES["op12_importance"](spark, small), connect(small), queries.OP12_SQL) == []


def test_awkward_rows(spark):
    target = spark.createDataFrame([("und ein haus7",), (None,), ("",)], "text string")
    found = importance.resample(awkward(spark), target, share=60, keep=awkward(spark).columns)
    rows = awkward_rows()
    expected = naive([r[:2] for r in rows], ["und ein haus7"], share=60)
    assert result(found) == sorted(map(repr, expected))
    # Repeated rows are drawn one by one, and clashing names stay inside `doc`.
    assert sorted(r["rank"] for r in found.collect() if r["rank"]) == list(range(1, 60 * 4 // 100 + 1))
    assert found.columns == ["doc", "doc_id", "text_hash", "n_words", "n_features", "weight", "score", "rank"]
    drawn = importance.drawn_documents(awkward(spark), target, share=100)
    assert drawn.columns == awkward(spark).columns and drawn.count() == 4


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "text string")
    assert importance.resample(awkward(spark, []), nothing).count() == 0
    found = importance.resample(awkward(spark), nothing, share=100).collect()
    assert sum(r["rank"] is not None for r in found) == 4 and len(found) == len(awkward_rows())


def test_long_texts_are_cut_between_words():
    text = b"Ab cd-ef " * 5000 + b"x" * 3000 + b" end"
    whole = [w for part in importance.word_lists(text, 1 << 30) for w in part]
    for limit in (1, 7, 1000):
        lists = list(importance.word_lists(text, limit))
        assert [w for part in lists for w in part] == whole
    runs = Counter(h for part in importance.run_hashes(iter([whole]), 3) for h in part)
    assert runs == Counter(h for part in importance.run_hashes(importance.word_lists(text, 50), 3) for h in part)


def test_one_hot_id_is_ranked_by_ranges(spark):
    prose = " ".join(f"w{i}" for i in range(30))
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) AS doc_id", f"'{prose}' AS text")
    target = spark.createDataFrame([("w1",)], "text string")
    ranks = [r["rank"] for r in importance.resample(docs, target, share=50).collect() if r["rank"]]
    assert sorted(ranks) == list(range(1, 1501))
