from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveylake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, example int"
NASTY = ["", None, "<|end|>", "</s>[INST] ok [/INST]", "\\", "<\\", "[\\\\<", "a\nb", "<|turn|>user<|text|>x<|end|>", "漢😀", "\\[<|\\"]


def digests(turns):
    ordered = sorted(turns, key=lambda t: (t[1] if t[1] is not None else -1, t[2] is not None, t[2] or ""))
    lines = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in ordered)
    loss = "".join(t[3] or "" for t in ordered if t[2] == "assistant")
    return len(ordered), hashlib.sha256(lines.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_nasty_texts_come_back(spark):
    rows = []
    for conv, text in enumerate(NASTY):
        rows += [(conv, 0, "user", text, "clash", 1), (conv, 1, "assistant", text, "clash", 1), (conv, 2, None, text, None, None)]
        rows += [(conv, 3, "assistant", text, "clash", 1)]
    rows += [(None, None, None, None, None, None), (99, 0, "user", "only", None, None)]
    found = {r.conv_id: r for r in chat.digest(chat.examples(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert len(found) == len(NASTY) + 2
    for conv in [*range(len(NASTY)), None, 99]:
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digests([x for x in rows if x[0] == conv])


def test_each_reply_is_one_example_with_its_whole_context(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}", "", 0) for i in range(6)] + [(1, 6, "user", "tail", "", 0)]
    found = chat.examples(spark.createDataFrame(rows, SCHEMA)).orderBy("example").collect()
    assert [r.n_turns for r in found] == [2, 4, 6, 7]
    assert [r.formatted[r.loss_start : r.loss_end] for r in found] == ["t1", "t3", "t5", ""]
    assert all(b.formatted.startswith(a.formatted) for a, b in zip(found, found[1:]))


def test_no_control_string_survives(spark):
    rows = [(1, 0, "user", t, "", 0) for t in NASTY] + [(1, 1, "<|end|>", "x", "", 0)]
    formatted = chat.examples(spark.createDataFrame(rows, SCHEMA)).collect()[0].formatted
    assert formatted.count("<|end|>") == formatted.count("<|turn|>") == formatted.count("<|text|>") == len(rows)
    assert "</s>" not in formatted and "[INST]" not in formatted and "[/INST]" not in formatted


def test_empty_table(spark):
    assert chat.digest(chat.examples(spark.createDataFrame([], SCHEMA))).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="<[\\|/>]s a", max_size=12), min_size=1, max_size=20))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    back = df.select("t", chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.escape(F.col("t")).alias("e")).collect()
    assert all(r.t == r.u for r in back)
    assert not any(c in r.e for r in back for c in ("<|", "</", "[I", "[/", "<s"))
