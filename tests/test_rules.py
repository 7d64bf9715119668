"""NULL and edge rules on a few inline rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from surveylake.channels import CHANNEL_NAMES, CompanyNames, channel_specs, parse_channel_list
from surveylake.functions.expressions import (
    clean_text,
    has_pii,
    leading_number,
    loose_match_key,
    match_key,
    needs_translation,
    score,
    text_or_fallback,
)
from surveylake.operators.dedup import dedup_by_comment, dedup_by_keys, dedup_report, removed_by_comment, removed_by_keys
from surveylake.operators.enrich import enrich, key_text, latest_snapshot, reference_columns
from surveylake.operators.intent import intent_match_rate, map_intent, strip_intent_suffix
from surveylake.operators.normalize import normalize
from surveylake.operators.quality import campaign_keep, campaign_removed
from surveylake.operators.rollups import cumulative_scores, daily_scores, monthly_yago, new_records_check

D = date


def values(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_campaign_keeps_and_removes_everything(spark):
    df = spark.createDataFrame([("Main",), ("Other",), (None,)], "campaign string")
    assert campaign_keep(df).count() == 1
    assert campaign_removed(df).count() == 2


def test_frame_without_campaign_passes_whole(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert campaign_keep(df).count() == 1 and campaign_removed(df).count() == 0


def test_scores_never_throw(spark):
    df = spark.createDataFrame([("5",), ("n/a",), ("",), (None,)], "s string")
    assert values(df, score(F.col("s"))) == [5.0, None, None, None]


def test_leading_number(spark):
    df = spark.createDataFrame([("5 - Very Satisfied",), ("Very",), (None,)], "s string")
    assert values(df, leading_number(F.col("s"))) == [5.0, None, None]


def test_match_keys(spark):
    df = spark.createDataFrame([("\tPayment  History ",)], "s string")
    assert values(df, match_key(F.col("s"))) == [" payment history"]
    assert values(df, loose_match_key(F.col("s"))) == ["\tpayment  history"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  ", "b"), ("a", "b"), (None, None)], "t string, f string")
    assert values(df, text_or_fallback(F.col("t"), F.col("f"))) == ["b", "a", None]
    raw = spark.createDataFrame([(" a\u0000\n\tb  c ",)], "t string")
    assert values(raw, clean_text(F.col("t"))) == ["a b c"]
    pii = spark.createDataFrame([("call 555-123-4567",), ("mail a@b.org",), ("fine",), (None,)], "t string")
    assert values(pii, has_pii(F.col("t"))) == [True, True, False, False]
    spoken = spark.createDataFrame([("Spanish ",), ("es",), ("english",), (None,)], "t string")
    assert values(spoken, needs_translation(F.col("t"))) == [True, True, False, False]


def test_intent_mapping_cases(spark):
    lookup = spark.createDataFrame(
        [(" Pay  Bill", "Payment"), ("pay bill ", "Billing"), ("outage", None), (None, "lost")],
        "old_intent string, new_intent string",
    )
    df = spark.createDataFrame([("PAY BILL",), ("Outage",), ("SignUp",), (None,)], "intent string")
    assert values(map_intent(df, lookup), "intent") == ["billing", "Outage", "SignUp", None]
    rate = intent_match_rate(df, lookup).first()
    assert (rate.total_count, rate.matched_count, rate.unmatched_count, rate.match_rate) == (4, 1, 3, 25.0)
    assert intent_match_rate(df.limit(0), lookup).first().match_rate == 0.0


def test_map_intent_adds_no_columns(spark):
    lookup = spark.createDataFrame([("a", "b")], "old_intent string, new_intent string")
    df = spark.createDataFrame([(1, "A", 2)], "x int, intent string, y int")
    assert map_intent(df, lookup).columns == ["x", "intent", "y"]


def test_suffix_cleanup(spark):
    df = spark.createDataFrame([("Outage-thankyou",), ("Outage Thank You ",), ("thankyou",), ("Outage",)], "intent string")
    assert values(strip_intent_suffix(df), "intent") == ["Outage", "Outage", "thankyou", "Outage"]


RESPONSE = (
    "event_date date, contact_record_id string, cas_account_number string, response_received_date date, comment string"
)


def responses(spark, rows):
    return spark.createDataFrame([(D(2026, 1, 5), *r) for r in rows], RESPONSE)


def test_comment_dedup_cases(spark):
    df = responses(
        spark,
        [
            ("1", "a", D(2026, 1, 2), "x"),
            ("2", "a", D(2026, 1, 2), "x"),
            ("3", "a", D(2026, 1, 1), "x"),
            ("4", "a", None, "x"),
        ],
    )
    assert values(dedup_by_comment(df, F.col("comment")), "contact_record_id") == ["1"]
    removed = removed_by_comment(df, F.col("comment")).collect()
    assert {(r.contact_record_id, r.removal_reason) for r in removed} == {
        ("2", "DEDUP_CASE_1"),
        ("3", "DEDUP_CASE_3"),
        ("4", "DEDUP_CASE_3"),
    }
    report = dedup_report(df, F.col("comment")).first()
    assert (report.total_before, report.case_1, report.case_2, report.case_3, report.total_after) == (4, 1, 0, 2, 1)


def test_anonymous_responses_collapse_unless_told_otherwise(spark):
    silent = responses(spark, [("1", None, D(2026, 1, 2), None), ("2", None, D(2026, 1, 2), None)])
    spoken = responses(spark, [("1", None, D(2026, 1, 2), "x"), ("2", None, D(2026, 1, 2), "x")])
    assert dedup_by_comment(silent, F.col("comment")).count() == 1
    assert dedup_by_comment(spoken, F.col("comment")).count() == 1
    assert dedup_by_comment(silent, F.col("comment"), null_key_is_unique=True).count() == 2
    assert removed_by_comment(silent, F.col("comment"), null_key_is_unique=True).count() == 0


def test_batches_do_not_mix(spark):
    rows = [("1", "a", D(2026, 1, 2), "x"), ("2", "a", D(2026, 1, 9), "x")]
    df = responses(spark, rows[:1]).union(responses(spark, rows[1:]).withColumn("event_date", F.lit(D(2026, 1, 12))))
    assert dedup_by_comment(df, F.col("comment")).count() == 2


KEYED = (
    "event_date date, contact_record_id string, cas_account_number string, survey_id string, survey_name string,"
    " case_type string, response_received_date timestamp, event_ts timestamp, queue_time timestamp"
)


def test_key_dedup_with_null_keys(spark):
    at = datetime(2026, 1, 2, 3)
    rows = [(D(2026, 1, 5), i, None, "s", "n", None, at, at, None) for i in ("2", "1", "3")]
    df = spark.createDataFrame(rows, KEYED)
    assert values(dedup_by_keys(df), "contact_record_id") == ["1"]
    assert sorted(values(removed_by_keys(df), "contact_record_id")) == ["2", "3"]


def test_key_dedup_needs_its_columns(spark):
    with pytest.raises(Exception, match="survey_id|UNRESOLVED"):
        dedup_by_keys(responses(spark, []))


def test_global_average_of_nothing_is_one_row(spark):
    df = spark.createDataFrame([], "channel string, event_date date, q1 double, q2 double, q3 double")
    one = cumulative_scores(df, D(2026, 3, 1)).collect()
    assert len(one) == 1 and one[0].q1_avg_csat is None and one[0].event_start_date is None
    assert daily_scores(df, D(2026, 3, 1)).count() == 0
    assert monthly_yago(df, D(2026, 3, 1)).count() == 0


def test_monthly_yago_cutoff(spark):
    days = [D(2026, 1, 3), D(2026, 4, 2), D(2025, 3, 31), D(2025, 4, 1), D(2024, 1, 1)]
    df = spark.createDataFrame([(d, 1.0, 2.0, 3.0) for d in days], "event_date date, q1 double, q2 double, q3 double")
    rows = monthly_yago(df, D(2026, 3, 15)).collect()
    assert sorted((r.month, r.year_label, r.record_count) for r in rows) == [(1, "current", 1), (3, "yago", 1)]


def test_new_records_compare_counts_only(spark):
    schema = "channel string, event_date date"
    new = spark.createDataFrame([("ivr", D(2026, 1, 1))] * 2 + [("sms", D(2026, 1, 1))], schema)
    old = spark.createDataFrame([("ivr", D(2026, 1, 1)), ("sms", D(2026, 1, 1)), ("api", D(2026, 1, 1))], schema)
    found = {r.channel: r.new_records_found for r in new_records_check(new, old).collect()}
    assert found == {"ivr": True, "sms": False, "api": False}


def test_reference_with_a_repeated_account(spark):
    ref = spark.createDataFrame([(1.0e9, "a"), (1.0e9, "b"), (None, "c")], "account_number double, v string")
    df = spark.createDataFrame([(D(2026, 1, 1), "1000000000")], "event_date date, cas_account_number string")
    with pytest.raises(Exception, match="occurs more than once"):
        enrich(df, reference_columns(ref, {"v": "ref_v"})).collect()
    assert enrich(df, reference_columns(ref, {"v": "ref_v"}, on_duplicate="fanout")).count() == 2
    with pytest.raises(ValueError):
        reference_columns(ref, {"v": "ref_v"}, on_duplicate="first")


def test_enrichment_key_is_chosen_per_batch(spark):
    df = spark.createDataFrame(
        [
            (D(2026, 1, 1), None, "1"),
            (D(2026, 1, 1), "2", "1"),
            (D(2026, 1, 2), None, "1"),
        ],
        "event_date date, customer_account_number string, cas_account_number string",
    )
    ref = spark.createDataFrame([("1", "one"), ("2", "two")], "account_number string, v string")
    reference = reference_columns(ref, {"v": "ref_v"})
    enriched = enrich(df, reference)
    assert sorted(((r.event_date.day, r.ref_v) for r in enriched.collect()), key=str) == [
        (1, "two"), (1, None), (2, "one"),
    ]
    assert enrich(enriched, reference).columns == enriched.columns


def test_snapshot_and_keys(spark):
    empty = spark.createDataFrame([], "account_number int, insert_date date")
    assert latest_snapshot(empty).count() == 0
    df = spark.createDataFrame([(1.0e9,)], "k double")
    assert values(df, key_text(F.col("k"), "double")) == ["1000000000"]


def test_channel_list():
    assert parse_channel_list("ivr,bogus") == ("ivr",)
    assert parse_channel_list("bogus") == CHANNEL_NAMES
    assert parse_channel_list("all") == CHANNEL_NAMES
    assert parse_channel_list(" API_Relational , ivr") == ("ivr", "api_relational")


def test_company_spelling_is_a_setting():
    specs = channel_specs(CompanyNames(value="acme"))
    assert specs["ivr"].score_columns[2] == "q3_csat_with_acme"
    assert specs["ivr"].scores[2].source == "q3_csat_with_acme_value"


def test_api_channels_normalize_in_place(spark):
    spec = channel_specs()["api_transactional"]
    names = [s.source for s in spec.scores] + ["q4_feedback_comment"]
    df = spark.createDataFrame([("4", "x", "3", "good")], ", ".join(f"{n} string" for n in names))
    row = normalize(df, spec).first()
    assert (row.q1_satisfaction_value, row.q2_effort_value, row.q3_overall_satisfaction) == (4.0, None, 3.0)
    assert row["how_would_you_rate_your_overall_satisfaction_with_this_visit"] == 4.0
    assert row.q3_overall_satisfaction_value == "3"


def test_dates_that_are_text_lose_no_row(spark):
    rows = [("1", "a", "2026-01-02", "x"), ("1", "a", "soon", "x"), ("1", "a", "late", "x"), ("0", "a", None, "x")]
    df = spark.createDataFrame(
        [(D(2026, 1, 5), *r) for r in rows],
        "event_date date, contact_record_id string, cas_account_number string, response_received_date string, comment string",
    )
    kept = dedup_by_comment(df, F.col("comment")).collect()
    removed = removed_by_comment(df, F.col("comment")).collect()
    assert [r.response_received_date for r in kept] == ["2026-01-02"] and len(removed) == 3


def test_texts_of_any_length_are_scored(spark):
    from surveylake.operators.text import scorable

    df = spark.createDataFrame([("ab",), ("no",), ("x" * 50_000,), (" " * 60 + "abcd",), ("  ",), ("",), (None,)], "text string")
    assert scorable(df, "text").count() == 4
    assert scorable(spark.createDataFrame([("a",)], "text string"), "text").count() == 1


def test_floating_keys_that_are_no_account(spark):
    rows = [(1e9,), (1.5,), (float("nan"),), (float("inf"),), (None,)]
    df = spark.createDataFrame(rows, "k double")
    assert values(df, key_text(F.col("k"), "double")) == ["1000000000", None, None, None, None]


def test_references_already_there_are_left_out(spark):
    from surveylake.operators.enrich import ACCOUNT_COLUMNS, ACCOUNT_KEY, ARREARS_COLUMNS, OUTAGE_COLUMNS
    from surveylake.plans.enrichment import enriched_responses

    added = [*ARREARS_COLUMNS.values(), *ACCOUNT_COLUMNS.values(), *OUTAGE_COLUMNS.values()]
    reference = spark.range(1).select(F.lit("1").alias(ACCOUNT_KEY), *[F.lit("new").alias(c) for c in added])
    there = next(iter(ARREARS_COLUMNS.values()))
    final = spark.createDataFrame([(D(2026, 1, 5), "1", "old")], f"event_date date, cas_account_number string, `{there}` string")
    row = enriched_responses(final, reference).first().asDict()
    assert row[there] == "old" and not set(list(ARREARS_COLUMNS.values())[1:]) & set(row)
    assert {row[c] for c in [*ACCOUNT_COLUMNS.values(), *OUTAGE_COLUMNS.values()]} == {"new"}
    assert enriched_responses(final, reference.select(ACCOUNT_KEY, *ARREARS_COLUMNS.values())).columns == final.columns
