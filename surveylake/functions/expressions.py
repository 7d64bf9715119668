"""Column expressions shared by the operators. All of them stay JVM-side."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score(raw: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    return raw.try_cast("double")


def leading_number(raw: Column) -> Column:
    """The number a label such as ``5 - Very Satisfied`` starts with, else NULL."""
    return F.regexp_extract(raw, r"^(\d+)", 1).try_cast("double")


def match_key(text: Column) -> Column:
    """Lower case, outer spaces removed, inner whitespace runs made one space.

    Only spaces are trimmed, so a leading tab survives as one leading space.
    """
    return F.regexp_replace(F.lower(F.trim(text)), r"\s+", " ")


def loose_match_key(text: Column) -> Column:
    """The earlier key rule: lower case and outer spaces removed only."""
    return F.lower(F.trim(text))


def first_present(df: DataFrame, candidates: Iterable[str], type_name: str = "string") -> Column:
    """First non-null value among those candidate columns the frame has, else NULL."""
    present = [F.col(name) for name in candidates if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast(type_name)


def text_or_fallback(text: Column, fallback: Column) -> Column:
    """The text, or the fallback where the text is missing or blank."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), fallback)


def clean_text(text: Column) -> Column:
    """Control characters and whitespace runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"[\p{Cntrl}\s]+", " "))


def clean_length_at_least(text: Column, minimum: int) -> Column:
    """Has the cleaned text that many characters?

    A visible run of that length in the raw text settles it; only other texts
    are cleaned for the test, since filters run before the projection.
    """
    visible = text.rlike(rf"[^\p{{Cntrl}}\s]{{{minimum}}}")
    return visible | (F.length(clean_text(text)) >= minimum)


# What counts as personal data in a comment. Only the presence of a match
# matters, so optional leading parts are left out of the patterns.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
NUMBER_PATTERN = (
    r"[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}"                 # phone number
    r"|[0-9]{3}-[0-9]{2}-[0-9]{4}"                           # social security number
    r"|[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}"      # card number
)


def has_pii(text: Column) -> Column:
    """Does the text hold an e-mail address or one of the number formats?

    The address pattern is tried only on texts with an ``@`` in them.
    """
    address = text.contains("@") & text.rlike(EMAIL_PATTERN)
    return F.coalesce(address | text.rlike(NUMBER_PATTERN), F.lit(False))


def needs_translation(language: Column, source: str = "spanish", codes: tuple[str, ...] = ("es",)) -> Column:
    return F.coalesce(F.lower(F.trim(language)).isin(source, *codes), F.lit(False))


def run_id(source: Column, started: Column) -> Column:
    """``<source>-inference-<date>-<hour>-<minute>-<second>``."""
    return F.concat(source, F.lit("-inference-"), F.date_format(started, "yyyy-MM-dd-HH-mm-ss"))


def is_match(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def content_hash(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """A tie-break over all columns: rows that share it are interchangeable."""
    skip = set(exclude)
    return F.xxhash64(*[F.col(f"`{name}`") for name in df.columns if name not in skip])


def only_dates(df: DataFrame, dates: Iterable[date | str], column: str = "event_date") -> DataFrame:
    """Rows of the given dates; on a partition column this prunes the scan."""
    return df.filter(F.col(column).isin([F.lit(str(d)).cast("date") for d in dates]))
