from __future__ import annotations

from collections import Counter

from helpers import awkward
from pyspark.sql import functions as F
from test_decontamination import brute
from test_quality import naive
from test_simhash import brute_roots, naive_fingerprint

import corpus_pipeline
from surveylake.llm import mixing, quality, sharding


def test_each_stage_is_its_brute_force(spark, small, docs_small, tmp_path):
    docs, items = docs_small, [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-dedup", "decontamination", "mixing", "sharding"]
    kept = [docs.collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        if i < 4:
            assert out.columns == docs_small.columns
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(docs.collect())
    start, good, single, clean, mixed, sharded = kept

    def bad(text):
        return any(eval(r.fails, {}, naive(text)) for r in quality.RULES if quality.BIT[r.name] & quality.POLICIES[quality.CURRENT])

    assert sorted(good) == sorted(r for r in start if not bad(r.text))
    fps = {r.doc_id: naive_fingerprint(r.text) for r in good}
    roots = brute_roots(fps.values())
    first = {}
    for r in sorted(good):
        first.setdefault(roots[fps[r.doc_id] - (1 << 64) if fps[r.doc_id] >> 63 else fps[r.doc_id]], r)
    assert sorted(single) == sorted(first.values())
    leaked = {d for d, _ in brute([(r.doc_id, r.text) for r in single], items)}
    assert leaked and sorted(clean) == sorted(r for r in single if r.doc_id not in leaked)
    copies, sizes, taken = Counter(r.doc_id for r in mixed), Counter(), Counter()
    assert max(copies.values()) <= 3 and set(mixed) <= set(clean)
    for r in clean:
        sizes[r.source] += len(r.text.encode().split())
        taken[r.source] += copies[r.doc_id] * len(r.text.encode().split())
    weights = mixing.cycled_weights(list(sizes))
    for source, aim in zip(weights, mixing.targets([sizes[s] for s in weights], list(weights.values()))):
        smallest = min(len(r.text.encode().split()) for r in clean if r.source == source)
        # The last document of a source is the one that comes nearest, so a target may be passed by a little.
        assert abs(aim - taken[source]) <= max(smallest, 0.1 * aim) + 1
    assert Counter(r.doc_id for r in sharded) == copies
    totals = Counter()
    for r in sharded:
        assert r.size == len(r.text.encode()) + sharding.RECORD_BYTES and 0 <= r.shard < 24
        totals[r.shard] += r.size
    slots = Counter()
    for r in sharded:
        slots[r.virtual_slot] += r.size
    assert max(totals.values()) - min(totals.get(s, 0) for s in range(24)) <= max(slots.values())


def test_run_has_the_rows_of_the_stages(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.count() > 50 and {"doc_id", "text", "lang", "source", "n_chars", "shard"} <= set(rows.columns)


def test_stages_on_awkward_and_empty_tables(spark, small):
    for rows in (None, []):
        docs = awkward(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, small)
            assert out.count() <= 40
            if name != "sharding":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
    only_nulls = awkward(spark).select(*[F.lit(None).cast(t).alias(c) for c, t in awkward(spark).dtypes])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, only_nulls, small).count() <= 12
