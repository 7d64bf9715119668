from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import pytest
from compare import compare, connect
from helpers import awkward, awkward_rows

from surveylake.llm import phrases, queries


def naive(rows, order=5, least=100, covered=100, top=2000):
    """The rows of `collocations` by counting every phrase of every length."""
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, order + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, words), a in candidates.items():
        inside = {words[i : i + k] for k in range(2, len(words)) for i in range(len(words) - k + 1)}
        for part in inside:
            longer[lang, part] = max(longer[lang, part], a)
    out = []
    for (lang, words), a in candidates.items():
        if longer[lang, words] and 100 * longer[lang, words] >= covered * a:
            continue
        cuts = [(f[lang, words[:k]], f[lang, words[k:]], k) for k in range(1, len(words))]
        score, _, left, right = min((1000 * a * n[lang] // (x * y), k, x, y) for x, y, k in cuts)
        out.append((lang, " ".join(words), a, left, right, n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(mine[:top], 1)]
    return sorted(ranked)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"covered": 60, "top": 40}, {"order": 3}, {"slots": 1 << 10}])
def test_is_brute_force(spark, docs_small, options):
    found = phrases.collocations(docs_small, min_count=12, **options)
    plain = {k: v for k, v in options.items() if k != "slots"}
    rows = [(r.text, r.lang) for r in docs_small.collect()]
    assert rows_of(found) == naive(rows, least=12, **plain) != []


def test_matches_sql(spark, small):
    assert compare(queries.QUERIES["op13_phrases"](spark, small), connect(small), queries.OP13_SQL) == []


def test_awkward_rows(spark):
    rows = [(r[1], r[2]) for r in awkward_rows()]
    assert rows_of(phrases.collocations(awkward(spark), min_count=2)) == naive(rows, least=2)
    assert phrases.collocations(awkward(spark, [])).count() == 0


def test_odd_separators_and_null_languages(spark):
    rows = [("A b\tc.a b  c,A B c\x0ba b\x0cc\x01 d a b", None), ("a b a b a b a b; a b", "und"), ("É b É b É b", "fr"), (None, "fr")]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert rows_of(phrases.collocations(df, min_count=2)) == naive(rows, least=2) != []


def test_products_beyond_64_bits(spark):
    # 1000 * a * n passes 2 ** 63 for counts like these.
    a, n, left, right = 3 * 10**12, 9 * 10**12, 4 * 10**12, 5 * 10**12
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    big = {c: f"CAST({c} AS decimal(18,0))" for c in "alrn"}
    got = row.selectExpr(f"CAST({big['a']} * 1000 AS decimal(20,0)) * {big['n']} div ({big['l']} * {big['r']}) AS s").first().s
    assert got == 1000 * a * n // (left * right)


@pytest.mark.parametrize("limit", [5, 64, 1000])
def test_blocks_are_cut_between_pieces(limit):
    texts = [None, "", "one two. three four, five " * 20, "no break at all " * 30, "x" * 500, ".;.", "End"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * len(texts))], ["text", "lang"])

    def pieces(size):
        out = []
        for block in phrases.blocks(batch, size):
            words = block.vocabulary.to_pylist()
            groups = {}
            for code, piece in zip(block.codes, block.piece):
                groups.setdefault(piece, []).append(words[code])
            out += groups.values()
        return out

    assert pieces(limit) == pieces(1 << 30)


def test_runs_are_ruled_out_by_any_of_their_slots(spark):
    """A rare pair that shares one slot with a frequent one isn't handed on."""
    rows = [("a b. " * 100, "en")] + [(f"c{i} d{i} ; a c{i}", "en") for i in range(2000)]
    df = spark.createDataFrame(rows, "text string, lang string")
    known = phrases.frequent_slots(df, 100, 1 << 10)
    left = 0
    for batch in pa.table({"text": [r[0] for r in rows], "lang": ["en"] * len(rows)}).to_batches():
        for block in phrases.blocks(batch):
            pairs = known.may(1, phrases.run_slots(block, ["en"], known.slots)[1])
            left += int(pairs.sum())
    assert left == 100
    assert rows_of(phrases.collocations(df, slots=1 << 10)) == naive(rows) != []


def test_windows_handed_on_do_not_grow_with_the_partitions(spark, docs_small):
    """Each task hands on its windows, so texts read in many partitions are counted in a task per core."""
    cores = spark.sparkContext.defaultParallelism
    texts, plans = docs_small.repartition(cores * 5), []

    class Seen(Exception):
        pass

    def seen(texts, *_):
        plans.append(texts.rdd.getNumPartitions())
        raise Seen

    original, phrases.frequent_slots = phrases.frequent_slots, seen
    try:
        with pytest.raises(Seen):
            phrases.phrase_counts(texts)
    finally:
        phrases.frequent_slots = original
    assert plans == [cores]


def test_slots_follow_the_bytes_of_text(spark):
    row = spark.range(1).selectExpr(f"repeat('x', {1 << 22}) AS text", "1 AS n")
    assert phrases.slots_for(row) == phrases.LEAST_SLOTS
    many = row.crossJoin(spark.range(200)).select("text")
    assert phrases.slots_for(many) == 1 << 24
    assert phrases.slots_for(row.limit(0)) == phrases.LEAST_SLOTS
