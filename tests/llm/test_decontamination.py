from __future__ import annotations

import re

from helpers import awkward

from surveylake.llm import decontamination


def shingle_set(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, items, threshold=0.8):
    found = {}
    for d, text in docs:
        have = shingle_set(text)
        for i, item in set(items):
            want = shingle_set(item)
            if want and len(want & have) / len(want) >= threshold:
                best = found.get((d, i), 0.0)
                found[d, i] = max(best, len(want & have) / len(want))
    return found


WORDS = [f"w{i}" for i in range(400)]
ITEMS = [(i, " ".join(WORDS[i * 20 : i * 20 + n])) for i, n in enumerate((5, 8, 14, 20, 3, 60, 120, 17))]


def test_matches_brute_force(spark):
    filler = " ".join(f"f{i}" for i in range(300))
    docs = [(0, filler)]
    for n, (_, text) in enumerate(ITEMS):
        words = text.split()
        for cut in (0, 1, len(words) // 6, len(words) // 3):
            docs.append((len(docs), f"{filler} {' '.join(words[cut:])}, {filler}"))
        docs.append((len(docs), f"{filler} {text.upper().replace(' ', '  ')}!"))
        docs.append((len(docs), text))
    items = [*ITEMS, ITEMS[0], (50, None), (51, ""), (52, "!!!"), (None, WORDS[300] + " a b c d e")]
    docs += [(900, None), (901, ""), (None, ITEMS[3][1]), (3, ITEMS[7][1]), (3, ITEMS[7][1])]
    doc_df = spark.createDataFrame(docs, "doc_id long, text string")
    item_df = spark.createDataFrame(items, "item_id long, text string")
    index = decontamination.item_index(item_df)
    found = {(r.doc_id, r.item_id): r.containment for r in decontamination.find_items(doc_df, index).collect()}
    assert found == brute(docs, items)
    assert len(found) > 20


def test_sketch_sizes_lose_nothing(spark):
    index = decontamination.item_index(spark.createDataFrame(ITEMS, "item_id long, text string"))
    for r in index.groupBy("item_id").agg({"item_shingles": "max", "sketch": "max"}).collect():
        assert r["max(sketch)"]
    kept = {r.item_id: r["count"] for r in index.filter("sketch").groupBy("item_id").count().collect()}
    sizes = {r.item_id: r.item_shingles for r in index.collect()}
    for item, size in sizes.items():
        may_miss = next(k for k in range(size, -1, -1) if (size - k) / size >= 0.8)
        assert kept[item] > may_miss


def test_shuffled_join_agrees(spark, docs_small, small, monkeypatch):
    index = decontamination.item_index(spark.read.parquet(f"{small}/benchmark.parquet")).cache()
    expected = sorted(map(tuple, decontamination.find_items(docs_small, index).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_SKETCHES", 0)
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, decontamination.find_items(docs_small, index).collect())) == expected


def test_clean_documents_keep_their_columns(spark):
    items = spark.createDataFrame([(1, "no id here but some words"), (2, "nothing like this at all anywhere")], "item_id long, text string")
    docs = awkward(spark)
    clean = decontamination.clean_documents(docs, decontamination.item_index(items))
    assert clean.columns == docs.columns and clean.count() == 11
    assert clean.filter("text = 'no id here but some words'").count() == 0
    none = decontamination.item_index(items.limit(0))
    assert decontamination.clean_documents(docs, none).count() == 12
    assert decontamination.clean_documents(awkward(spark, []), none).count() == 0


def test_search_goes_through_the_sketch(spark):
    """Without sketch rows nothing is found, and a part of an item under the sketch's need makes no candidate."""
    item = spark.createDataFrame([ITEMS[5]], "item_id long, text string")
    index = decontamination.item_index(item).cache()
    words = ITEMS[5][1].split()
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:12])), (3, " ".join(words[:50]))], "doc_id long, text string")
    assert {r.doc_id for r in decontamination.find_items(docs, index).collect()} == {1, 3}
    near = {r.doc_id for r in decontamination.candidates(docs, index).collect()}
    assert {1, 3} <= near
    bare = index.withColumn("sketch", index.rank < 0)
    assert decontamination.find_items(docs, bare).count() == 0
    need = {(r.item_shingles, r.need) for r in index.collect()}
    assert need == {(56, 13 - 11)}  # sizes up to 64 may miss 12, so 13 are kept; 56 may miss 11


def test_candidates_hold_every_match(spark):
    """Every way of losing as many shingles as allowed, at the sizes next to a class's ends."""
    rows = []
    for n in (1, 2, 4, 5, 8, 9, 16, 17, 32, 33):
        rows.append((n, " ".join(f"x{n}y{i}" for i in range(n + 4))))
    index = decontamination.item_index(spark.createDataFrame(rows, "item_id long, text string")).cache()
    docs = []
    for n, text in rows:
        words = text.split()
        lost = n - -(-8 * n // 10)
        for start in range(lost + 1):
            docs.append((len(docs), "a b " + " ".join(words[start : start + n + 4 - lost]) + " c d"))
    found = {(r.doc_id, r.item_id): r.containment for r in decontamination.find_items(
        spark.createDataFrame(docs, "doc_id long, text string"), index).collect()}
    assert found == brute(docs, rows) and len(found) == len(docs)
