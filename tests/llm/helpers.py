"""Rows with nulls, empty and long texts, ties, repeats and clashing extra columns."""

from __future__ import annotations

DOC_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size string, shard string, bits string, `_row` string, `_text` string, component_id string, `a.b` string"
)
PROSE = " ".join(f"wort{i % 97} und ein haus{i % 13}" for i in range(40))


def awkward_rows() -> list[tuple]:
    extra = ("x", None, "y", "r", "t", "c", "dot")
    return [
        (1, PROSE, "de", "a", 3, *extra),
        (1, PROSE, "de", "a", 3, *extra),
        (2, PROSE, "de", "b", 3, *extra),
        (3, None, None, None, None, *[None] * 7),
        (4, "", "en", "a", 0, *extra),
        (None, "no id here but some words", None, "b", 1, *extra),
        (None, None, None, None, None, *[None] * 7),
        (5, " \t\n ", "en", None, 3, *extra),
        (6, "long " + "wide words everywhere " * 30000, "en", "c", 9, *extra),
        (7, "x" * 200000, "en", "c", 9, *extra),
        (8, "Ünïcödé 漢字 emoji 😀 and\x0bvertical\x0ctabs", "fr", "c", 9, *extra),
        (-9, "1" * 50000 + " " + "a" * 50000 + "@", "fr", "c", 9, *extra),
    ]


def awkward(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOC_SCHEMA)
