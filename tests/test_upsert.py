import pytest
from pyspark.sql import functions as F

from gridtally import session
from gridtally.functions import times
from gridtally.operators import upsert
from gridtally.sinks import files as sink

NOW = "2026-01-01 00:00:00"
TARGET = "k string, v string, stamp int, created int"
SOURCE = "k string, v string, stamp int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", "old", 5, 1), ("b", None, 5, 1), ("c", "same", 5, 1), (None, "nokey", 5, 1)], TARGET)


def merge(target, source, **kw):
    how = upsert.Merge(["k"], ["v", "stamp"], on_insert={"created": F.lit(9)}, **kw)
    return sorted(map(tuple, upsert.merge(target, source, how).collect()), key=str)


def test_newer_source_wins_and_older_is_ignored(spark, target):
    source = spark.createDataFrame([("a", "late", 4), ("b", "new", 6), ("d", "add", 1)], SOURCE)
    assert merge(target, source, guard=upsert.newer("stamp", "stamp")) == sorted(
        [("a", "old", 5, 1), ("b", "new", 6, 1), ("c", "same", 5, 1), ("d", "add", 1, 9), (None, "nokey", 5, 1)], key=str
    )


def test_equal_time_changes_only_when_allowed(spark, target):
    source = spark.createDataFrame([("a", "tie", 5)], SOURCE)
    assert ("a", "old", 5, 1) in merge(target, source, guard=upsert.newer("stamp", "stamp"))
    assert ("a", "tie", 5, 1) in merge(target, source, guard=upsert.newer("stamp", "stamp", or_equal=True))


def test_value_guard_sees_null_as_a_value(spark, target):
    source = spark.createDataFrame([("b", "now known", 1), ("c", "same", 1)], SOURCE)
    out = merge(target, source, guard=upsert.differs("v"))
    assert ("b", "now known", 1, 1) in out and ("c", "same", 5, 1) in out


def test_guard_on_null_does_not_change(spark):
    t = spark.createDataFrame([("a", "old", None, 1)], TARGET)
    s = spark.createDataFrame([("a", "new", 3)], SOURCE)
    assert merge(t, s, guard=upsert.newer("stamp", "stamp")) == [("a", "old", None, 1)]


def test_null_keys_never_match(spark, target):
    out = merge(target, spark.createDataFrame([(None, "other", 9)], SOURCE))
    assert (None, "nokey", 5, 1) in out and (None, "other", 9, 9) not in out


def test_feed_is_filtered_and_reduced_before_merging(spark, target):
    feed = spark.createDataFrame(
        [("a", "first", 6, "UPDATE"), ("a", "last", 7, "UPDATE"), ("a", "gone", 8, "DELETE"), ("n", "x", 1, "INSERT")],
        SOURCE + ", operation string",
    )
    how = upsert.Merge(["k"], ["v", "stamp"], upsert.newer("stamp", "stamp"), on_insert={"created": F.lit(9)})
    once = upsert.merge_latest(target, feed, how, "stamp", "v", operations=["INSERT", "UPDATE"])
    got = sorted(map(tuple, once.collect()), key=str)
    assert ("a", "last", 7, 1) in got and ("n", "x", 1, 9) in got and len(got) == 5
    twice = upsert.merge_latest(once, feed, how, "stamp", "v", operations=["INSERT", "UPDATE"])
    assert sorted(map(tuple, twice.collect()), key=str) == got


def test_insert_new_adds_each_unseen_key_once(spark, rows):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    s = spark.createDataFrame([("a", 2), ("b", 3), ("b", 1)], "k string, v int")
    assert rows(upsert.insert_new(t, s, ["k"], "v")) == [("a", 1), ("b", 1)]


def test_only_touched_partitions_are_rebuilt(spark, rows):
    t = spark.createDataFrame([("a", 1, "d1"), ("b", 1, "d1"), ("c", 1, "d2")], "k string, v int, day string")
    s = spark.createDataFrame([("a", 7, "d1"), ("n", 8, "d3")], "k string, v int, day string")
    how = upsert.Merge(["k"], ["v"])
    out = upsert.merge_partitions(t, s, how, "day").select("k", "v", "day")
    assert rows(out) == [("a", 7, "d1"), ("b", 1, "d1"), ("n", 8, "d3")]


def test_a_row_that_moves_to_another_day_is_stored_once(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    t = spark.createDataFrame([("a", 1, "d1"), ("b", 1, "d2"), ("c", 1, "d3")], "k string, v int, day string")
    t.write.partitionBy("day").parquet(path)
    s = spark.createDataFrame([("a", 7, "d2"), (None, 5, "d1")], "k string, v int, day string")
    for _ in range(2):
        target = spark.read.parquet(path).select("k", "v", "day")
        parts = upsert.touched(target, s, ["k"], "day")
        out = upsert.merge_partitions(target, s, upsert.Merge(["k"], ["v"]), "day")
        sink.replace_partitions(out, session.materialize(parts, "parts"), path, "day")
        assert rows(spark.read.parquet(path), "k", "v", "day") == [("a", 7, "d2"), ("b", 1, "d2"), ("c", 1, "d3")]


def test_rows_without_a_key_are_left_to_the_dead_letters(spark, rows):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    s = spark.createDataFrame([("a", 2), (None, 3), (None, 4)], "k string, v int")
    once = upsert.merge(t, s, upsert.Merge(["k"], ["v"]))
    assert rows(once) == rows(upsert.merge(once, s, upsert.Merge(["k"], ["v"]))) == [("a", 2)]
    assert rows(upsert.unkeyed(s, ["k"])) == [(None, 3), (None, 4)]


def test_every_entity_has_a_merge(spark):
    assert set(upsert.ENTITIES) == {"customer", "account", "location", "contract", "meter", "billing", "payment"}
    for entity, (keys, update) in upsert.ENTITIES.items():
        stamp = times.at("2025-01-01 00:00:00")
        columns = [*keys, *update]
        t = spark.range(1).select(*[F.lit("old").alias(c) for c in update], *[F.lit("k").alias(c) for c in keys], stamp.alias("bq_update_timestamp"), stamp.alias("bq_insert_timestamp"))
        s = spark.range(1).select(*[F.lit("new").alias(c) for c in update], *[F.lit("k").alias(c) for c in keys], times.at("2025-06-01 00:00:00").alias("event_timestamp"))
        how = upsert.entity_merge(entity, t.columns, times.at(NOW))
        row = upsert.merge(t, s, how).first()
        assert all(row[c] == "new" for c in update) and len(columns) == len(set(columns))
        assert str(row["bq_update_timestamp"]) == NOW and str(row["bq_insert_timestamp"]).startswith("2025-01-01")
