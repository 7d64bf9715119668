"""Survivor selection on a table with a hot group and exact copies, against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from surveylake.functions.grouping import keep_first, not_first, repeat_rows
from surveylake.operators.dedup import dedup_by_comment, removed_by_comment
from surveylake.operators.enrich import enrich, reference_columns


def hot_rows(n=3000, seed=7):
    """A third of the rows in one group, a tenth of them copies of one row."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 10 == 0:
            rows.append((None, 0, 0))
        elif i % 3 == 0:
            rows.append((None, r.randrange(50), r.randrange(200)))
        else:
            rows.append((r.randrange(400), r.randrange(5), r.randrange(3)))
    return rows


def test_kept_and_removed_add_up(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k int, a int, b int").repartition(8)
    rank = F.struct("a", "b")
    kept = Counter(map(tuple, keep_first(df, ["k"], rank).collect()))
    removed = Counter(map(tuple, not_first(df, ["k"], rank, carry=["a"]).select("k", "a", "b").collect()))

    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    survivors = Counter(min(g, key=lambda t: t[1:]) for g in groups.values())
    assert kept == survivors
    assert kept + removed == Counter(rows)


def test_removed_rows_carry_the_survivor(spark):
    df = spark.createDataFrame(hot_rows(), "k int, a int, b int")
    wrong = not_first(df, ["k"], F.struct("a", "b"), carry=["a"]).filter(F.col("_kept_a") > F.col("a"))
    assert wrong.count() == 0


def test_copies_are_written_back(spark):
    df = spark.createDataFrame([("x", 25_001), ("y", 1)], "v string, n bigint")
    counts = {r.v: r["count"] for r in repeat_rows(df, "n", chunk=1000).groupBy("v").count().collect()}
    assert counts == {"x": 25_001, "y": 1}


def test_batches_hold_every_record_in_hash_order(spark):
    import hashlib

    from surveylake.operators.corrections import reprocess_batches

    df = spark.range(5003).withColumnRenamed("id", "record_id")
    ordered = sorted(range(5003), key=lambda i: (hashlib.md5(f"{i}42".encode()).hexdigest(), i))
    found = {r.record_id: r.batch_index for r in reprocess_batches(df, batch_size=25).collect()}
    assert found == {i: n // 25 for n, i in enumerate(ordered)}
    assert reprocess_batches(df.limit(0)).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def responses(spark, small):
    from checks.adapters import responses

    return responses(spark, small)


def test_survivors_are_limited_before_the_shuffle(spark, small):
    text = plan(dedup_by_comment(responses(spark, small), F.col("comment"), ["channel", "event_date"]))
    assert "row_number(), 1, Partial" in text and text.count("Exchange hashpartitioning") == 1


def test_removed_rows_read_narrow_columns(spark, small):
    text = plan(removed_by_comment(responses(spark, small), F.col("comment"), ["channel", "event_date"]))
    assert "Window" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all("event_type" not in line and "value" not in line.split("Batched")[0] for line in scans)


def test_big_sides_are_not_broadcast(spark, small):
    """Without room for a broadcast the joins shuffle; the results stay the same."""
    from checks.rollups import QUERY_NAMES_WITH_JOINS
    from checks.registry import QUERIES

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in QUERY_NAMES_WITH_JOINS:
        before = Counter(map(str, QUERIES[name](spark, small).collect()))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        try:
            after = QUERIES[name](spark, small)
            assert "SortMergeJoin" in plan(after)
            assert Counter(map(str, after.collect())) == before
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_responses_without_account_spread_in_the_join(spark):
    df = spark.range(1000).select(
        F.lit("2026-01-01").cast("date").alias("event_date"),
        F.col("id").alias("contact_record_id"),
        F.lit(None).cast("string").alias("cas_account_number"),
    )
    ref = spark.createDataFrame([("1", "v")], "account_number string, v string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = enrich(df, reference_columns(ref, {"v": "ref_v"}))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 1000 and max(sizes) < 300


def test_hot_group_is_split_at_run_time(spark):
    """With a third of the rows in one group, the join's hot partition is read in several pieces."""
    rows = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50_000).alias("k"),
        F.col("id").alias("a"),
        F.sha2(F.col("id").cast("string"), 256).alias("b"),
    )
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        removed = not_first(rows, ["k"], F.struct("a", "b"))
        removed.write.format("noop").mode("overwrite").save()
        counted = removed.groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in counted.collect()]
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
        hot = 66_667
        assert sum(sizes) == 200_000 - 50_000 - 1 and max(sizes) < hot / 2
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
