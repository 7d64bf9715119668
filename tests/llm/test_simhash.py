from __future__ import annotations

import random

import pytest
import xxhash
from helpers import awkward
from hypothesis import given, settings
from hypothesis import strategies as st

from surveylake.llm import queries, simhash
from surveylake.llm.components import components


def naive_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(n)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > n)


def brute_roots(values, budget=4):
    """The smallest value (as a signed long) reachable from each."""
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in set(values))
    root = {v: v for v in signed}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= budget:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {v: top(v) for v in signed}


@settings(max_examples=150, deadline=None)
@given(st.none() | st.text(alphabet="aBé \n\t\x0b漢", max_size=40))
def test_fingerprint_is_the_naive_one(text):
    assert simhash.fingerprint(text) == naive_fingerprint(text)


def test_fingerprint_of_a_long_text():
    text = " ".join(f"w{i % 1013}" for i in range(40_000))
    assert simhash.fingerprint(text) == naive_fingerprint(text)


def planted(seed, groups=40, noise=300):
    rng, values = random.Random(seed), []
    for g in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12 if g else 120)):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                value ^= 1 << bit
            values.append(value)
            if rng.random() < 0.3:
                centre = value  # chains that drift away
    return values + [rng.getrandbits(64) for _ in range(noise)] + [0, 1, 3, (1 << 64) - 1]


@pytest.mark.parametrize(("seed", "limits"), [(1, {}), (2, {"trie_rows_limit": 6, "group_rows": 50}), (3, {"blocks": 7}), (4, {"blocks": 5, "trie_rows_limit": 20, "group_rows": 100})])
def test_components_are_those_of_all_pairs(spark, seed, limits):
    values = planted(seed)
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = simhash.near_components(spark.createDataFrame(rows, "fp long"), **limits).collect()
    got = {r.fp: r.root for r in found}
    assert len(found) == len(got)
    expected = brute_roots(values)
    assert got.keys() == expected.keys()
    # Roots may be named differently; the classes must be the same.
    classes = lambda roots: {frozenset(k for k in roots if roots[k] == r) for r in set(roots.values())}
    assert classes(got) == classes(expected)


def test_trie_join_alone_finds_every_class(spark, monkeypatch):
    """Without the early links the trie join has to find all of them."""
    monkeypatch.setattr(simhash, "neighbour_links", lambda tries, budget: tries.sparkSession.createDataFrame([], "u long, v long"))
    values = planted(9, groups=25, noise=100)
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = {r.fp: r.root for r in simhash.near_components(spark.createDataFrame(rows, "fp long"), trie_rows_limit=10).collect()}
    assert got == brute_roots(values)


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5, 5), (1050, 1000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(100)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query_is_brute_force(spark, small, docs_small):
    texts = {r.doc_id: r.text for r in docs_small.collect()}
    fps = {d: naive_fingerprint(t) for d, t in texts.items()}
    roots = brute_roots(fps.values())
    of = {d: roots[f - (1 << 64) if f >> 63 else f] for d, f in fps.items()}
    least = {}
    for d in sorted(of):
        least.setdefault(of[d], d)
    found = queries.QUERIES["op2_simhash"](spark, small).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {d: (f"{fps[d]:016x}", least[of[d]]) for d in of}
    assert len(found) == len(of)


def test_awkward_rows(spark):
    found = simhash.near_duplicates(awkward(spark)).collect()
    assert len(found) == 12
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[1].component_id == by_id[2].component_id == 1
    assert by_id[3].fp == by_id[4].fp == by_id[5].fp == 0 and by_id[5].component_id == 3
    assert simhash.near_duplicates(awkward(spark, [])).count() == 0


def test_keep_first(spark):
    docs = awkward(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # 1 twice and 2 are one group; 3, 4, 5 and the row without anything another.
    assert sorted(i for i in ids if i is not None) == [-9, 1, 3, 6, 7, 8] and ids.count(None) == 1
    assert simhash.keep_first(awkward(spark, [])).count() == 0
