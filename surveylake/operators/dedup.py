"""De-duplication of responses inside one batch, what it removes, and its report.

A batch is one channel's ``event_date``; its columns lead every grouping, so all
dates and channels go through in one plan without mixing.

Two rules exist. By key: rows equal in the seven response keys. By comment:
account and comment where there is a comment (latest response kept), account and
response date where there is none.

Ties are settled by the record id, then by the remaining report columns, so a
re-run keeps the same rows. NULL keys count as equal: responses without an
account collapse, as in the jobs this follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..channels import REMOVED_COLUMNS, RESPONSE_KEYS
from ..functions.expressions import content_hash
from ..functions.grouping import keep_first, latest_first, not_first

CASE_1, CASE_2, CASE_3 = "DEDUP_CASE_1", "DEDUP_CASE_2", "DEDUP_CASE_3"


def _rank(df: DataFrame) -> Column:
    """Latest response first, then the smallest id, then the other report columns."""
    order = ("contact_record_id", "response_received_date", "customer_account_number", "cas_account_number")
    return F.struct(
        latest_first(F.col("response_received_date")).alias("recency"), *[c for c in order if c in df.columns]
    )


def _report_frame(df: DataFrame, batch: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """The columns removal is decided on and reported with, nothing wider."""
    wanted = dict.fromkeys([*batch, *[c for c in REMOVED_COLUMNS if c in df.columns], *extra])
    return df.select(*wanted)


def _null_key(df: DataFrame, null_key_is_unique: bool) -> dict[str, Column]:
    """Optional extra key that keeps responses without an account apart."""
    if not null_key_is_unique:
        return {}
    anonymous = F.col("cas_account_number").isNull() | F.col("response_received_date").isNull()
    return {"_anonymous": F.when(anonymous, F.col("contact_record_id"))}


# --- by key ---------------------------------------------------------------------


def dedup_by_keys(df: DataFrame, batch: Sequence[str] = ("event_date",)) -> DataFrame:
    """One row per response key within a batch."""
    return keep_first(df, [*batch, *RESPONSE_KEYS], _rank(df), content_hash(df))


def removed_by_keys(df: DataFrame, batch: Sequence[str] = ("event_date",)) -> DataFrame:
    """The rows ``dedup_by_keys`` drops, in report columns."""
    narrow = _report_frame(df, batch, RESPONSE_KEYS)
    report = [c for c in narrow.columns if c in (*batch, *REMOVED_COLUMNS)]
    return not_first(narrow, [*batch, *RESPONSE_KEYS], _rank(narrow)).select(*report)


# --- by comment -----------------------------------------------------------------


def _comment_groups(df: DataFrame, comment: Column, null_key_is_unique: bool) -> tuple[DataFrame, list[str]]:
    """Add the group columns that express both comment rules as one key."""
    unique = _null_key(df, null_key_is_unique)
    keyed = df.withColumns(
        {
            "_comment": comment,
            "_date_if_silent": F.when(comment.isNull(), F.col("response_received_date")),
            **{k: F.when(comment.isNull(), v) for k, v in unique.items()},
        }
    )
    return keyed, ["cas_account_number", "_comment", "_date_if_silent", *unique]


def dedup_by_comment(
    df: DataFrame, comment: Column, batch: Sequence[str] = ("event_date",), null_key_is_unique: bool = False
) -> DataFrame:
    """One row per account and comment, or per account and date where the comment is missing."""
    keyed, keys = _comment_groups(df, comment, null_key_is_unique)
    kept = keep_first(keyed, [*batch, *keys], _rank(keyed), content_hash(df))
    return kept.select(*[f"`{c}`" for c in df.columns])


def removed_by_comment(
    df: DataFrame, comment: Column, batch: Sequence[str] = ("event_date",), null_key_is_unique: bool = False
) -> DataFrame:
    """The rows ``dedup_by_comment`` drops, each with its case.

    Case 1: same account, comment and response date as the kept row. Case 2: no
    comment, same account and date. Case 3: same account and comment, other
    date. The date test is NULL-safe, so a row without a date is case 3 instead
    of vanishing from the report.
    """
    keyed, keys = _comment_groups(df, comment, null_key_is_unique)
    narrow = _report_frame(keyed, batch, keys)
    dropped = not_first(narrow, [*batch, *keys], _rank(narrow), carry=["response_received_date"])
    same_date = F.col("response_received_date").eqNullSafe(F.col("_kept_response_received_date"))
    reason = F.when(F.col("_comment").isNull(), CASE_2).when(same_date, CASE_1).otherwise(CASE_3)
    report = [c for c in narrow.columns if c in (*batch, *REMOVED_COLUMNS)]
    return dropped.select(*report, F.col("_comment").alias("comment"), reason.alias("removal_reason"))


def dedup_report(df: DataFrame, comment: Column, batch: Sequence[str] = ("event_date",)) -> DataFrame:
    """Per batch: rows in, with and without comment, duplicates per case, rows kept.

    Two nested counts give every figure without ranking a row: first per date
    inside a group, then per group, where the survivor's date is the latest.
    """
    keyed, keys = _comment_groups(df, comment, False)
    per_date = keyed.groupBy(*batch, *keys, "response_received_date").agg(F.count(F.lit(1)).alias("rows"))
    at_survivor = F.min_by(F.col("rows"), latest_first(F.col("response_received_date")))
    per_group = per_date.groupBy(*batch, *keys).agg(F.sum("rows").alias("rows"), at_survivor.alias("same_date"))
    spoken = F.col("_comment").isNotNull()

    def total(amount: Column, alias: str) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).alias(alias)

    return per_group.groupBy(*batch).agg(
        total(F.col("rows"), "total_before"),
        total(F.when(spoken, F.col("rows")), "with_comment"),
        total(F.when(~spoken, F.col("rows")), "without_comment"),
        total(F.when(spoken, F.col("same_date") - 1), "case_1"),
        total(F.when(~spoken, F.col("rows") - 1), "case_2"),
        total(F.when(spoken, F.col("rows") - F.col("same_date")), "case_3"),
        F.count(F.lit(1)).alias("total_after"),
    )


def dedup_samples(removed: DataFrame, per_case: int = 5) -> DataFrame:
    """A few removed rows of each case for the run report."""
    order = W.partitionBy("removal_reason").orderBy("contact_record_id")
    ranked = removed.withColumn("sample", F.row_number().over(order))
    return ranked.filter(F.col("sample") <= per_case)


# --- all channels in one plan ----------------------------------------------------


def dedup_responses(df: DataFrame) -> DataFrame:
    """Common-view responses of all channels, each by its own rule, in one shuffle.

    The ivr channel goes by key, the others by comment. Columns that do not take
    part in a channel's rule are NULL in its group key.
    """
    keyed, keys = _response_groups(df)
    kept = keep_first(keyed, keys, _rank(keyed), content_hash(df))
    return kept.select(*df.columns)


def _response_groups(df: DataFrame) -> tuple[DataFrame, list[str]]:
    by_key = F.col("channel") == "ivr"
    only_ivr = [c for c in RESPONSE_KEYS if c not in ("response_received_date", "cas_account_number")]
    parts = {f"_key_{c}": F.when(by_key, F.col(c)) for c in only_ivr}
    parts["_key_comment"] = F.when(~by_key, F.col("comment"))
    parts["_key_date"] = F.when(by_key | F.col("comment").isNull(), F.col("response_received_date"))
    return df.withColumns(parts), ["channel", "event_date", "cas_account_number", *parts]
