from __future__ import annotations

import itertools
import json
from collections import Counter, defaultdict

from helpers import awkward
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveylake.llm import mixing, queries


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets_share_everything_below_the_limit(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    found = mixing.targets(sizes, weights)
    assert abs(sum(found) - sum(sizes)) < 1e-6 * max(1, sum(sizes))
    assert all(t <= 3 * s + 1e-9 for t, s in zip(found, sizes))
    free = [(t / w) for t, s, w in zip(found, sizes, weights) if t < 3 * s - 1e-6]
    assert not free or max(free) - min(free) < 1e-6 * max(1, max(free))


def cost(amounts, sizes):
    total = 0
    for a, s in zip(amounts, sizes):
        for r in range(3):
            total += r * r * min(max(a - r * s, 0), s)
    return total


def test_flow_is_the_cheapest_of_all():
    sizes, members, quotas = [2, 3, 1], [[0], [0, 1], [1]], [4, 5]
    flow = mixing.cheapest_flow(sizes, members, quotas)
    assert flow[0][0] + flow[1][0] == 4 and flow[1][1] + flow[2][0] == 5
    best = min(
        cost((a, b + c, d), sizes)
        for a, b, c, d in itertools.product(range(7), range(10), range(10), range(4))
        if a + b == 4 and c + d == 5 and b + c <= 9
    )
    assert cost([sum(f) for f in flow], sizes) == best


def test_cycled_weights_go_by_code_point_and_null_is_last():
    assert mixing.cycled_weights([None, "b", "B", "é", "a"]) == {"B": 5, "a": 2, "b": 1, "é": 5, None: 2}


def test_query_meets_its_targets(spark, small, docs_small):
    rows = queries.QUERIES["op3_mixing"](spark, small).collect()
    again = queries.QUERIES["op3_mixing"](spark, small).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    texts = {r.doc_id: (r.text, r.source) for r in docs_small.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        text, source = texts[r.doc_id]
        assert r.size == len(text.encode().split()) and r.source == source
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = (r.source_size, r.target)
    weights = mixing.cycled_weights(list(sizes))
    aims = dict(zip(weights, mixing.targets([sizes[s] for s in weights], list(weights.values()))))
    for source, (size, aim) in target.items():
        assert size == sizes[source] and abs(aim - aims[source]) < 1e-6
        assert abs(aim - taken[source]) <= max(60, 0.03 * aim)


def test_selection_is_the_prefix_by_hash_and_the_nearest_fill(spark):
    docs = spark.createDataFrame([(i, " ".join(["w"] * (i % 17)), "s") for i in range(400)], "doc_id long, text string, source string")
    sized = mixing.sizes_of(docs, F.array("source"), keep=["doc_id"]).cache()
    pattern = sized.first()["_pattern"]
    got = mixing.select_documents(sized, {pattern: (1, 701)}, buckets=8, rounds=3).copies(sized)
    rows = sorted((r["_key"] % (1 << 64), r["size"], r["doc_id"]) for r in sized.collect() if r["size"])
    copies, left, cut = Counter({r[2]: 1 for r in rows}), 701, 0
    while cut < len(rows) and rows[cut][1] <= left:
        left -= rows[cut][1]
        copies[rows[cut][2]] += 1
        cut += 1
    for limit in (1, 1, 1, 2):
        fitting = [(abs(size - left), copies[d], key - (1 << 64) if key >> 63 else key, size, d) for key, size, d in rows if copies[d] < 3 and left and (size <= left if limit == 1 else size < 2 * left)]
        if fitting:
            *_, size, pick = min(fitting)
            left -= size
            copies[pick] += 1
    assert abs(left) <= 1
    assert {r["doc_id"]: r["_copies"] for r in got.filter("size > 0").collect()} == copies


def test_overlapping_sources(spark):
    rows = [(i, "a b c d e", [["x"], ["y"], ["x", "y"]][i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags array<string>")
    mix = mixing.plan_mix(mixing.sizes_of(docs, F.col("tags")), weights=(3, 1))
    assert set(mix.sources) == {"x", "y"} and mix.sources["x"] == (1000, 1125.0)
    out = mixing.mix_documents(docs, F.col("tags"), weights=(3, 1))
    assert out.columns == docs.columns
    copies = Counter(r.doc_id for r in out.collect())
    assert max(copies.values()) <= 3 and abs(5 * sum(copies.values()) - 1500) <= 10


def test_awkward_rows(spark):
    docs = awkward(spark)
    mix = mixing.plan_mix(mixing.sizes_of(docs, F.array("source"), keep=["doc_id"]))
    assert list(mix.sources) == ["a", "b", "c", None] and mix.sources[None] == (0, 0.0)
    out = mixing.mix_documents(docs, F.array("source"))
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} <= {1, 2, None, 6, 7, 8, -9}
    empty = awkward(spark, [])
    assert mixing.mix_documents(empty, F.array("source")).count() == 0


@settings(max_examples=150, deadline=None)
@given(
    st.dictionaries(st.frozensets(st.integers(0, 5), min_size=1, max_size=3), st.integers(0, 40), min_size=1, max_size=7),
    st.lists(st.integers(0, 90), min_size=6, max_size=6),
)
def test_groups_planned_alone_are_the_whole_flow(patterns, quotas):
    sizes = {json.dumps({"s": sorted(map(str, names))}): size for names, size in patterns.items()}
    names = sorted({str(n) for group in patterns for n in group})
    quota_of = {n: float(quotas[int(n)]) for n in names}
    plan = mixing.pattern_plan(sizes, quota_of)
    ordered = sorted(sizes)
    members = [[names.index(n) for n in json.loads(p)["s"]] for p in ordered]
    whole = [sum(f) for f in mixing.cheapest_flow([sizes[p] for p in ordered], members, [round(quota_of[n]) for n in names])]
    planned = [plan[p][0] * sizes[p] + plan[p][1] for p in ordered]
    assert sum(planned) == sum(whole)
    assert cost(planned, [sizes[p] for p in ordered]) == cost(whole, [sizes[p] for p in ordered])


def test_many_sources_are_planned_and_joined_without_a_bound(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_PATTERNS", 3)
    rows = [(i, " ".join("w" for _ in range(1 + i % 9)), f"s{i % 700}") for i in range(4200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.sizes_of(docs, F.array("source"), keep=["doc_id", "source"])
    mix = mixing.plan_mix(sized)
    taken = {r.source: r.t for r in mix.selection.copies(sized).groupBy("source").agg(F.sum(F.col("size") * F.col("_copies")).alias("t")).collect()}
    assert len(taken) == 700 == len(mix.sources)
    assert all(abs(taken[name] - target) <= 9 for name, (_, target) in mix.sources.items())


def test_sources_of_equal_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "s")] * 50 + [(2, "a b c", "t")] * 10, "doc_id long, text string, source string")
    counts = defaultdict(int)
    for r in mixing.mix_documents(docs, F.array("source")).collect():
        counts[r.doc_id] += 1
    # 100 words of s have a target of 93, 30 of t one of 37: each is taken whole, once.
    assert counts == {1: 50, 2: 10}


def test_a_document_that_holds_a_tenth_is_passed_over(spark):
    rows = [(i, " ".join(["w"] * (5 + i % 11)), "s") for i in range(900)] + [(900, " ".join(["w"] * 1000), "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.sizes_of(docs, F.array("source"), keep=["doc_id"]).cache()
    ordered = sorted((r["_key"] % (1 << 64), r["size"], r["doc_id"]) for r in sized.collect())
    place = [d for _, _, d in ordered].index(900)
    before = sum(size for _, size, _ in ordered[:place])
    pattern = sized.first()["_pattern"]
    # The cut falls on the long document: half of its words are wanted after the documents before it.
    quota, after = before + 500, sum(size for _, size, _ in ordered[place + 1 :])
    found = mixing.select_documents(sized, {pattern: (0, quota)}).copies(sized).collect()
    # The shortest document has 5 words.
    assert abs(sum(r["size"] * r["_copies"] for r in found) - quota) < 5
    copies = {r["doc_id"]: r["_copies"] for r in found}
    assert copies[900] == 0 and max(copies.values()) <= 3 and all(copies[d] for _, _, d in ordered[:place])
    # Enough documents come later in hash order, so all but the few that close the gap are taken once.
    if after > 500:
        assert sum(n > 1 for n in copies.values()) <= mixing.FILL_ROUNDS + 1


def test_one_text_repeated_many_times_is_passed_over(spark):
    docs = spark.createDataFrame([(i, "a b c d e", "s") for i in range(500)] + [(-1, "r e p", "s")] * 100, "doc_id long, text string, source string")
    sized = mixing.sizes_of(docs, F.array("source"), keep=["doc_id"]).cache()
    pattern = sized.first()["_pattern"]
    keys = {r["doc_id"]: r["_key"] % (1 << 64) for r in sized.collect()}
    quota = 5 * sum(key < keys[-1] for key in keys.values()) + 150
    found = mixing.select_documents(sized, {pattern: (0, quota)}).copies(sized).collect()
    assert sum(r["size"] * r["_copies"] for r in found) == quota
