"""Counts measured on sf0.01 in advance (FIXTURES), and invariants between results."""

from __future__ import annotations

from checks.adapters import responses, snapshots
from checks.registry import QUERIES
import checks.rollups  # noqa: F401
import checks.text  # noqa: F401


def count(spark, folder, name):
    return QUERIES[name](spark, folder).count()


def test_campaign(spark, medium):
    assert count(spark, medium, "campaign_keep") == 7000
    assert count(spark, medium, "campaign_removed") == 3000


def test_comment_dedup(spark, medium):
    assert count(spark, medium, "dedup_comment") == 9735
    reasons = QUERIES["dedup_removed"](spark, medium).groupBy("removal_reason").count().collect()
    assert {r.removal_reason: r["count"] for r in reasons} == {
        "DEDUP_CASE_1": 5, "DEDUP_CASE_2": 209, "DEDUP_CASE_3": 51,
    }


def test_key_dedup_on_ivr(spark, medium):
    kept = QUERIES["dedup_keys"](spark, medium).filter("channel = 'ivr'").count()
    removed = QUERIES["dedup_keys_removed"](spark, medium).filter("channel = 'ivr'").count()
    assert (kept, removed) == (1375, 25)


def test_rollups_and_snapshots(spark, medium):
    assert count(spark, medium, "monthly_yago") == 16
    assert snapshots(spark, medium).filter("insert_date = '2024-02-01'").count() == count(spark, medium, "latest_snapshot")


def test_rows_survive_joins(spark, medium):
    rows = responses(spark, medium).count()
    for name in ("intent_mapping", "enrich_all", "apply_corrections", "assemble_predictions"):
        assert count(spark, medium, name) == rows
