"""Account reference data: latest snapshot and left-join enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grouping import same_keys

ACCOUNT_KEY = "account_number"
SURVEY_KEYS = ("customer_account_number", "cas_account_number")

# Reference column -> column of the enriched table.
ARREARS_COLUMNS = {
    "30_day_arrears": "arrears_30_day",
    "60_day_arrears": "arrears_60_day",
    "90_day_arrears": "arrears_90_day",
    "tariff_rate_code": "arrears_tariff_rate_code",
    "current_balance": "arrears_current_balance",
    "agreement_status_code": "arrears_agreement_status_code",
    "critical_facility_code": "arrears_critical_facility_code",
}
ACCOUNT_COLUMNS = {
    "bal_billing_code": "cas_bal_billing_code",
    "current_credit_history_code": "cas_current_credit_history_code",
    "electric_rate_code": "cas_electric_rate_code",
    "Division": "cas_division",
    "zip_code": "cas_zip_code",
    "bi_directional_ind": "cas_bi_directional_ind",
}
OUTAGE_COLUMNS = {
    "ami_lost_power_restored_datetm": "cf_ma_rtm_ami_lost_power_restored_datetm",
    "ami_lost_power_off_datetm": "cf_ma_rtm_ami_lost_power_off_datetm",
}


def key_text(column: Column, type_name: str) -> Column:
    """An account key as text; floating keys go through a whole number first.

    A double would otherwise print as ``1.0E9``. One that is no whole number
    (a fraction, NaN, infinity) is no account and gives NULL.
    """
    if type_name in ("double", "float"):
        return F.when(F.rint(column) == column, column.try_cast("decimal(38,0)").cast("string"))
    return column.cast("string")


def latest_snapshot(snapshots: DataFrame, partition: str = "insert_date") -> DataFrame:
    """The rows of the latest partition.

    The maximum is a scalar subquery, evaluated first, so the second read is
    pruned to one partition. A table without partitions gives no rows.
    """
    latest = snapshots.agg(F.max(partition)).scalar()
    return snapshots.filter(F.col(partition) == latest)


def reference_columns(
    reference: DataFrame, columns: dict[str, str], key: str = ACCOUNT_KEY, on_duplicate: str = "raise"
) -> DataFrame:
    """Key as text and the renamed columns, one row per account.

    ``on_duplicate="raise"`` fails the job when an account occurs twice, instead
    of silently multiplying responses; ``"fanout"`` joins all of its rows.
    """
    if on_duplicate not in ("raise", "fanout"):
        raise ValueError(f"on_duplicate must be 'raise' or 'fanout', not {on_duplicate!r}")
    types = dict(reference.dtypes)
    picked = reference.select(
        key_text(F.col(key), types[key]).alias(key),
        *[F.col(f"`{name}`").alias(alias) for name, alias in columns.items()],
    ).filter(F.col(key).isNotNull())
    if on_duplicate == "fanout":
        return picked
    unique = picked.groupBy(key).agg(
        *[F.first(alias).alias(alias) for alias in columns.values()], F.count(F.lit(1)).alias("_rows")
    )
    duplicate = F.raise_error(F.concat(F.lit("reference account occurs more than once: "), F.col(key)))
    checked = F.when(F.col("_rows") > 1, duplicate.cast("string")).otherwise(F.col(key))
    return unique.select(checked.alias(key), *columns.values())


def survey_key(df: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Add ``_account``: the account column a batch is joined on.

    The first of the candidate columns with any value in the batch is used for
    all of its rows. The decision is one row per batch, and batches are calendar
    dates per channel: a few thousand rows however large the table, so they are
    broadcast.
    """
    types = dict(df.dtypes)
    present = [c for c in SURVEY_KEYS if c in df.columns]
    if not present:
        return df.withColumn("_account", F.lit(None).cast("string"))
    if len(present) == 1:
        return df.withColumn("_account", key_text(F.col(present[0]), types[present[0]]))
    first, second = present
    used = df.groupBy(*batch).agg((F.count(first) > 0).alias("_use_first"))
    decided = df.alias("s").join(F.broadcast(used).alias("u"), same_keys("s", "u", batch), "left")
    chosen = F.when(F.col("u._use_first"), key_text(F.col(f"s.{first}"), types[first])).otherwise(
        key_text(F.col(f"s.{second}"), types[second])
    )
    return decided.select("s.*", chosen.alias("_account"))


def combine_references(references: Sequence[DataFrame], key: str = ACCOUNT_KEY) -> DataFrame:
    """All references side by side, one row per account, so responses are shuffled once."""
    combined = references[0]
    for reference in references[1:]:
        combined = combined.join(reference, key, "full")
    return combined


def enrich(
    df: DataFrame, reference: DataFrame, key: str = ACCOUNT_KEY, batch: Sequence[str] = ("event_date",)
) -> DataFrame:
    """Left join responses with reference columns.

    A frame that already has any of the columns is returned unchanged. Responses
    without an account get a key of their own that matches nothing, so they
    spread over all tasks; AQE splits any account that is hot.
    """
    added = [c for c in reference.columns if c != key]
    if any(c in df.columns for c in added):
        return df
    keyed = survey_key(df, batch)
    nowhere = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))
    left = keyed.withColumn("_account", F.coalesce("_account", nowhere)).alias("s")
    right = reference.withColumnRenamed(key, "_account").alias("r")
    joined = left.join(right, F.col("s._account") == F.col("r._account"), "left")
    return joined.select(*[F.col(f"s.`{c}`") for c in df.columns], *[F.col(f"r.`{c}`") for c in added])
