from __future__ import annotations

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from surveylake.llm.words import pieces, split_words

TEXTS = st.lists(st.none() | st.text(alphabet="ab\t\n \x0b\x0c\r\x1c é漢", max_size=12), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_bytes_split(texts):
    words = split_words(pa.array(texts, pa.string()))
    vocabulary = words.vocabulary.to_pylist()
    found = [[vocabulary[c] for c in words.codes[a:b]] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    assert found == [(t or "").encode().split() for t in texts]


def test_words_of_a_slice():
    texts = pa.array(["skip", "a b", None, "c"]).slice(1)
    words = split_words(texts)
    assert words.counts().tolist() == [2, 0, 1]


def test_pieces_keep_all_rows_in_order():
    texts = ["a" * n for n in (0, 5, 50, 0, 3, 9, 70)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = list(pieces(batch, limit=10))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert len(parts) > 3 and all(p.num_rows for p in parts)
    assert list(pieces(batch.slice(0, 0))) == []
