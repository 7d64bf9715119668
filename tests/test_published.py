"""Parts are seen old or new, failed writes change nothing, and corrections leave other buckets' files alone."""

from __future__ import annotations

import os
import threading
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from surveylake.operators.corrections import apply_corrections
from surveylake.sinks import dashboards
from surveylake.sinks.dashboards import correct_dashboard, read_dashboard, record_bucket, write_dashboard
from surveylake.sinks.versions import (
    current_versions,
    drop_superseded,
    publish,
    publish_table,
    read_published,
    read_table,
)

SCHEMA = "id long, event_date date, mark string"
A, B, C = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def frame(spark, mark, *days, rows=5):
    return spark.createDataFrame([(i, day, mark) for day in days for i in range(rows)], SCHEMA)


def marks(spark, root, days=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    return {(r.event_date, r.mark): r["count"] for r in read_published(spark, root, schema, days).groupBy("event_date", "mark").count().collect()}


def files(root):
    return {
        os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
        for at, _, names in os.walk(root) for name in names if name.startswith("part-")
    }


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path / "t")
    assert marks(spark, root) == {} and current_versions(spark, root) == {}
    publish(frame(spark, "old", A, B), root, [A, B, C])
    assert marks(spark, root) == {(A, "old"): 5, (B, "old"): 5}
    publish(frame(spark, "new", B, C, rows=3), root, [B, C])
    assert marks(spark, root) == {(A, "old"): 5, (B, "new"): 3, (C, "new"): 3}
    publish(frame(spark, "none").limit(0), root, [A])
    assert marks(spark, root) == {(B, "new"): 3, (C, "new"): 3}
    assert marks(spark, root, [C, date(2030, 1, 1)]) == {(C, "new"): 3}


def test_a_failed_write_leaves_the_old_part(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(frame(spark, "old", A, B), root, [A, B])
    broken = frame(spark, "new", A).withColumn("mark", F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("mark")))
    with pytest.raises(Exception, match="broken"):
        publish(broken, root, [A])
    with pytest.raises(ValueError, match="none of the parts"):
        publish(frame(spark, "new", A, C), root, [A])
    with pytest.raises(ValueError, match="none of the parts"):
        publish(spark.createDataFrame([(1, None, "new")], SCHEMA), root, [A])
    with pytest.raises(ValueError, match="can't name"):
        publish(frame(spark, "new"), root, ["a.b"])
    assert marks(spark, root) == {(A, "old"): 5, (B, "old"): 5}


def test_a_reader_during_rewrites_sees_one_version(spark, tmp_path):
    root, wrong, stop = str(tmp_path / "t"), [], threading.Event()
    publish(frame(spark, "0", A, rows=50), root, [A])

    def read():
        while not stop.is_set():
            seen = marks(spark, root)
            if len(seen) != 1 or set(seen.values()) != {50}:
                wrong.append(seen)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(6):
        publish(frame(spark, str(n), A, rows=50), root, [A])
    stop.set()
    reader.join()
    assert wrong == []


def test_a_planned_read_survives_the_next_version_until_old_ones_are_dropped(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(frame(spark, "old", A), root, [A])
    planned = read_published(spark, root, spark.createDataFrame([], SCHEMA).schema)
    publish(frame(spark, "new", A), root, [A])
    assert {r.mark for r in planned.collect()} == {"old"}
    assert drop_superseded(spark, root, datetime.now() - timedelta(hours=1)) == []
    time.sleep(0.1)
    assert len(drop_superseded(spark, root, datetime.now() + timedelta(seconds=5))) == 1
    assert marks(spark, root) == {(A, "new"): 5}
    assert len([f for f in os.listdir(f"{root}/current") if not f.startswith(".")]) == 1
    publish(frame(spark, "newest", A), root, [A])
    assert marks(spark, root) == {(A, "newest"): 5}


def test_a_whole_table(spark, tmp_path):
    root = str(tmp_path / "t")
    df = frame(spark, "x", A)
    assert read_table(spark, root, df.schema).count() == 0
    publish_table(df, root)
    publish_table(df.filter("id < 2"), root)
    assert sorted(read_table(spark, root, df.schema).collect()) == sorted(df.filter("id < 2").collect())


TABLE = "record_id string, topic string, other string, text string"


def test_corrections_rewrite_only_their_buckets(spark, tmp_path):
    root = str(tmp_path / "d")
    rows = [(f"r{i}", "old", None if i % 3 else "kept", f"text {i}") for i in range(400)]
    df = spark.createDataFrame(rows, TABLE)
    write_dashboard(df, root, buckets=16)
    before = files(root)
    fixes = spark.createDataFrame(
        [("r7", "new", None), ("r8", None, None), ("r9", "old", None), ("nobody", "new", None), (None, "new", None)],
        "record_id string, topic string, other string",
    )
    written = correct_dashboard(spark, root, df.schema, fixes, topics=("topic", "other"), buckets=16)
    home = df.filter("record_id = 'r7'").select(record_bucket(F.col("record_id"), 16)).first()[0]
    assert written == [home]  # the others change no value
    after = files(root)
    assert all(after[path] == changed for path, changed in before.items())
    assert {path.split("/data/")[1].split("/")[0] for path in after.keys() - before.keys()} == {f"bucket={home}"}
    want = apply_corrections(df, fixes.filter("record_id is not null"), topics=("topic", "other"))
    assert sorted(map(repr, read_dashboard(spark, root, df.schema).collect())) == sorted(map(repr, want.collect()))
    assert correct_dashboard(spark, root, df.schema, fixes, topics=("topic", "other"), buckets=16) == []


def test_empty_dashboards_and_no_corrections(spark, tmp_path):
    root = str(tmp_path / "d")
    df = spark.createDataFrame([], TABLE)
    write_dashboard(df, root, buckets=4)
    none = spark.createDataFrame([], "record_id string, topic string")
    assert correct_dashboard(spark, root, df.schema, none, topics=("topic",), buckets=4) == []
    assert read_dashboard(spark, root, df.schema).count() == 0


def test_corrections_read_the_stored_table_once(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, f"t{i % 3}") for i in range(40)], "record_id int, topic string")
    root = str(tmp_path / "d")
    write_dashboard(df, root, buckets=4)
    reads, read = [], dashboards.read_published
    monkeypatch.setattr(dashboards, "read_published", lambda *a: reads.append(a) or read(*a))
    fixes = spark.createDataFrame([(1, "new"), (2, None), (99, "unknown")], "record_id int, topic string")
    assert len(correct_dashboard(spark, root, df.schema, fixes, topics=("topic",), buckets=4)) == 1
    assert len(reads) == 1
    rows = dict(read_dashboard(spark, root, df.schema).collect())
    assert rows == {i: "new" if i == 1 else f"t{i % 3}" for i in range(40)}
