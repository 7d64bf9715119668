from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, awkward_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveylake.llm import quality, queries

TEXTS = st.lists(st.none() | st.lists(st.sampled_from(["a", "bb", "#", "x|y", "é", "12", "\n", "\x0b", "  "]), max_size=60).map(" ".join), max_size=5)


def naive(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, duplicate, lines = set(), 0, 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            lines += 1
            duplicate += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_lines": lines,
        "n_dup_lines": duplicate,
        "n_repeat_words": len(repeated),
        "n_letter_words": sum(any(c.isascii() and c.isalpha() or not c.isascii() for c in w.decode()) for w in words),
    }


def failing(text):
    return sum(quality.BIT[rule.name] for rule in quality.RULES if eval(rule.fails, {}, naive(text)))


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_measurements(texts):
    found = quality.measure(pa.array(texts, pa.string()))
    assert {k: v.tolist() for k, v in found.items()} == {k: [naive(t)[k] for t in texts] for k in quality.MEASURES}


def test_query_is_brute_force(spark, small, docs_small):
    rows = {r.doc_id: r for r in queries.QUERIES["op6_quality"](spark, small).collect()}
    texts = {r.doc_id: r.text for r in docs_small.collect()}
    assert rows.keys() == texts.keys()
    for d, text in texts.items():
        want, r = naive(text), rows[d]
        base = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert all(r[k] == want[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = sum(quality.BIT[rule.name] for rule in quality.RULES if eval(rule.fails, {}, want))
        assert (r.base_failed, r.bits, r.kept) == (base, failed, not failed & quality.POLICIES[quality.CURRENT])


def test_ablation_is_what_dropping_a_rule_keeps(spark):
    rng = np.random.default_rng(1)
    rows = [(int(b),) for b in rng.integers(0, 1 << len(quality.RULES), 400)] + [(0,)] * 30 + [(4,)] * 7
    ledger = spark.createDataFrame(rows, "bits long")
    policy = quality.POLICIES[2]
    for r in quality.ablation(ledger, policy).collect():
        without = policy & ~quality.BIT[r.rule]
        assert r.kept_with == sum(b & policy == 0 for (b,) in rows)
        assert r.kept_without == sum(b & without == 0 for (b,) in rows)
        assert r.rejected == sum(b & quality.BIT[r.rule] != 0 for (b,) in rows)


def test_policies_only_add_versions():
    assert quality.POLICIES[1] == quality.BASE and quality.BIT["few_words"] == 1 and quality.BIT["repeated_windows"] == 2


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = quality.ledger(docs).collect()
    assert len(rows) == 12 and all(r.bits & 1 for r in rows if r.n_words == 0)
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    good = [i for i, r in enumerate(awkward_rows()) if not failing(r[1]) & quality.POLICIES[quality.CURRENT]]
    assert sorted(r.n_chars for r in kept.collect()) == sorted(awkward_rows()[i][4] for i in good)
    assert quality.keep_documents(awkward(spark, [])).count() == 0
    assert quality.ledger(docs, keep=("doc_id", "bits", "source")).filter(F.col("source").isNull()).count() == 3


def test_clean_prose_is_kept(spark):
    rows = [(i, " ".join(f"word{(i * 31 + j * 7) % 5003} and" for j in range(200)), "en", "s", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert quality.keep_documents(docs).count() == 20


def test_stored_ledger(spark, docs_small, tmp_path, monkeypatch):
    """Policies and ablations read the stored ledger; one that is too old for a policy is refused, a newer one takes over."""
    path = str(tmp_path / "ledger")
    stored = quality.write_ledger(docs_small, path)
    assert {r.rules for r in stored.select("rules").distinct().collect()} == {7}
    bits = [failing(r.text) for r in docs_small.collect()]
    assert sorted(r.bits for r in stored.collect()) == sorted(bits)
    monkeypatch.setattr(quality, "RULES", (*quality.RULES, quality.Rule("many_lines", "n_lines > 5")))
    monkeypatch.setitem(quality.BIT, "many_lines", 128)
    monkeypatch.setitem(quality.POLICIES, 3, quality.BASE | 128)
    with pytest.raises(ValueError, match="does not know"):
        quality.read_ledger(spark, path, 3)
    assert quality.read_ledger(spark, path, 1).count() == len(bits)
    newer = quality.write_ledger(docs_small, path)
    assert newer.filter("bits >= 128").count() == sum(naive(r.text)["n_lines"] > 5 for r in docs_small.collect())
    assert quality.read_ledger(spark, path, 3).count() == len(bits)


def test_ablation_query(spark, small, docs_small):
    bits = [failing(r.text) for r in docs_small.collect()]
    rows = queries.QUERIES["quality_ablation"](spark, small).collect()
    assert len(rows) == sum(bin(p).count("1") for p in quality.POLICIES.values())
    for r in rows:
        policy, bit = quality.POLICIES[r.policy], quality.BIT[r.rule]
        assert r.rejected == sum(b & bit != 0 for b in bits) and r.rejected_alone == sum(b & policy == bit for b in bits)
        assert r.kept_with == sum(b & policy == 0 for b in bits) and r.kept_without == sum(b & policy & ~bit == 0 for b in bits)
