"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it are context, and only
that reply is trainable. Turns after the last reply would be in no example, so a
conversation that doesn't end with a reply gets one more example without any
trainable text; the longest example of a conversation therefore holds all its turns.

A turn is written `<|turn|>` role `<|text|>` text `<|end|>`. In roles and texts a
backslash follows each `<`, `[` and backslash, so that no control string that
begins with one of them (`<|end|>`, `</s>`, `[INST]`, ...) survives in a text, and
dropping the backslash after each such character gives the text back.

Defined results: a null text or role is empty; turns are ordered by number, then role,
then text, nulls first; repeated turns stay; only the role `assistant`
is trainable; no rows give no examples; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TRAINABLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def examples(turns: DataFrame) -> DataFrame:
    """One row per example: `conv_id`, `example` (from 0), `n_turns`, `formatted`, `loss_start`, `loss_end` (code points)."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit(TURN), escape(role), F.lit(TEXT))
    body = escape(text)
    rendered = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.col("role"),
            F.col("text").isNotNull().alias("has_text"),
            F.concat(head, body, F.lit(END)).alias("piece"),
            F.char_length(body).alias("body_chars"),
            (role == TRAINABLE).alias("reply"),
        ).alias("t"),
    )
    whole = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    ends = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: F.element_at("turns", i)["reply"] | (i == F.size("turns")),
    )
    exploded = whole.select("conv_id", "turns", F.posexplode(ends).alias("example", "n_turns"))
    last = F.element_at("turns", F.col("n_turns"))
    formatted = F.array_join(F.slice("turns", F.lit(1), F.col("n_turns"))["piece"], "")
    return (
        exploded.select(
            "conv_id",
            "example",
            F.col("n_turns").cast("long").alias("n_turns"),
            formatted.alias("formatted"),
            last["reply"].alias("_reply"),
            last["body_chars"].alias("_chars"),
        )
        .withColumn("loss_end", F.when(F.col("_reply"), F.char_length("formatted") - len(END)).otherwise(0))
        .withColumn("loss_start", F.when(F.col("_reply"), F.col("loss_end") - F.col("_chars")).otherwise(0))
        .select("conv_id", "example", "n_turns", "formatted", "loss_start", "loss_end")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of an example as an array of (role, text), from its string alone."""
    parts = F.split(formatted, r"<\|end\|>", -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def parsed(turn: Column) -> Column:
        cut = F.split(F.substring(turn, len(TURN) + 1, 2_147_483_647), r"<\|text\|>", -1)
        return F.struct(unescape(cut[0]).alias("role"), unescape(cut[1]).alias("text"))

    return F.transform(turns, parsed)


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    return unescape(F.substring(formatted, start + 1, end - start))


def digest(formatted_examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read back from them."""
    loss = loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    per_conversation = formatted_examples.groupBy("conv_id").agg(
        F.max_by("formatted", "n_turns").alias("_longest"),
        F.sort_array(F.collect_list(F.struct(F.col("example"), loss.alias("loss")))).alias("_losses"),
        F.sum(F.char_length("formatted")).cast("long").alias("formatted_chars"),
    )
    turns = read_turns(F.col("_longest"))
    as_lines = F.transform(F.col("_turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        per_conversation.withColumn("_turns", turns)
        .withColumn("_loss", F.array_join(F.col("_losses")["loss"], ""))
        .select(
            "conv_id",
            F.size("_turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(as_lines, ""), 256).alias("turns_sha256"),
            F.char_length("_loss").cast("long").alias("loss_chars"),
            F.sha2("_loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
