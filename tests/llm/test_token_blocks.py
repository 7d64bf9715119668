from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from surveylake.llm import queries, token_blocks
from surveylake.llm.queries import word_vocabulary

LIBRARY = Tokenizer.from_file(word_vocabulary())
ENCODER = token_blocks.WordEncoder(word_vocabulary())
PARTS = ["don't", "it's'll", "Word", "É", "straße.", "a.b", "...", "'s", ",'re", "x<|endoftext|>y", "<|STARTOFTEXT|>", "<|", "≠", "é", ".́", "Σας", "İ", "漢字", "12", "a1b2", " ", "\n", "\x0b", "\x1c", " ", "😀", "ÿ!", "×.", " "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS) | st.text(max_size=3), max_size=8).map("".join), min_size=1, max_size=4))
def test_ids_are_those_of_whole_texts(texts):
    ids, counts = ENCODER.encode(pa.array(texts))
    whole = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in whole]
    assert ids.tolist() == [i for w in whole for i in w]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_blocks, "REMEMBERED", 3)
    own = token_blocks.WordEncoder(word_vocabulary())
    for text in ("one two three four", "five one, six", "two"):
        assert own.encode(pa.array([text]))[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 31).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(0, (1 << w) - 1), max_size=50))), st.data())
def test_packing_round_trip_and_random_access(case, data):
    width, ids = case
    payload = token_blocks.pack(np.array(ids, dtype=np.uint32), width)
    assert len(payload) == (len(ids) * width + 7) // 8
    start = data.draw(st.integers(0, len(ids)))
    count = data.draw(st.integers(0, len(ids) - start))
    assert token_blocks.unpack(payload, width, start, count).tolist() == ids[start : start + count]


@pytest.mark.parametrize(("size", "width"), [(1, 1), (2, 1), (3, 2), (49408, 16), (65536, 16), (65537, 17)])
def test_width(size, width):
    assert token_blocks.width_of(size) == width


def expected(rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_reads_back_what_the_library_gives(spark, small, docs_small):
    rows = sorted((r.doc_id, r.text) for r in docs_small.select("doc_id", "text").collect())
    found = queries.QUERIES["op7_token_blocks"](spark, small)
    assert sorted(map(tuple, found.collect())) == expected(rows)


def test_blocks_give_any_document(spark, docs_small, tmp_path):
    path = str(tmp_path / "blocks")
    token_blocks.write_blocks(docs_small, path, word_vocabulary, shards=3, block_ids=500)
    texts = {r.doc_id: r.text for r in docs_small.collect()}
    blocks = [r.asDict() for r in token_blocks.read_blocks(spark, path).collect()]
    assert {b["width"] for b in blocks} == {16} and max(b["block"] for b in blocks) > 3
    for b in blocks[::7]:
        for i in range(len(b["doc_ids"])):
            ids = [*LIBRARY.encode(texts[b["doc_ids"][i]], add_special_tokens=False).ids, 1]
            assert token_blocks.document_ids(b, i).tolist() == ids


def test_awkward_rows(spark, tmp_path):
    token_blocks.write_blocks(awkward(spark), str(tmp_path / "a"), word_vocabulary, shards=4, block_ids=100)
    found = token_blocks.read_documents(token_blocks.read_blocks(spark, str(tmp_path / "a"))).collect()
    assert len(found) == 12
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered[:-1])]).tolist()
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert all(r.n_tokens == 1 for r in found if r.doc_id in (3, 4, 5))
    token_blocks.write_blocks(awkward(spark, []), str(tmp_path / "b"), word_vocabulary, shards=4)
    assert token_blocks.read_documents(token_blocks.read_blocks(spark, str(tmp_path / "b"))).count() == 0
