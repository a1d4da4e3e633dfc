"""What the optimizer makes of the queries, and how they bear a hot key."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gridtally.operators import dedup, integrity, ordered, quality, upsert
from gridtally.plans import marts, warehouse

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["incremental_extract"](spark, FOLDER).select("o_orderkey", "o_orderdate"))
    assert "GreaterThan(o_orderdate" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", text)
    assert "ReadSchema: struct<user_id:bigint" not in plan(QUERIES["gold_stats"](spark, FOLDER))


@needs_data
def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["dup_reading_keys"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as t")
    text = plan(dedup.latest_per_key(df, ["k"], "t"))
    assert text.count("WindowGroupLimit") == 2 and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(dedup.repeated_keys(spark.range(5).selectExpr("id as k"), ["k"]).orderBy("k").limit(3))


def test_partition_filter_prunes_files(spark, tmp_path):
    from gridtally.sinks import files as sink

    df = spark.range(40).selectExpr("cast(id as string) as account_id", "date_add(date'2024-01-01', cast(id * 5 as int)) as bill_date")
    sink.write_monthly_fact(df, str(tmp_path / "f"), "bill_date", ["account_id"], "r1")
    text = plan(spark.read.parquet(str(tmp_path / "f")).filter("month = date'2024-02-01'"))
    assert re.search(r"PartitionFilters: \[.*month.*2024-02-01|PartitionFilters: \[.*month", text)


# --- a key that holds a third of the rows ------------------------------------------------

N = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """Sixty thousand rows; a third share one key and one moment."""
    return spark.range(N, numPartitions=8).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), (F.col("id") % 5000).cast("string"))).alias("meter_id"),
        F.timestamp_add(
            "MINUTE", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 90000).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        ).alias("event_timestamp"),
        (F.col("id") % 50).cast("double").alias("consumption_kwh"),
    )


def largest_share(df, *by) -> float:
    """Largest part of the rows that one task holds after hashing on ``by``."""
    sizes = df.repartition(16, *by).groupBy(F.spark_partition_id()).count()
    total, top = sizes.agg(F.sum("count"), F.max("count")).first()
    return top / total


def test_flags_with_a_hot_key(spark, hot):
    flagged = quality.flag_readings(hot, ["n"])
    firsts = hot.groupBy("meter_id", "event_timestamp").agg(F.min("n").alias("n")).select("n")
    wrong = flagged.join(firsts.withColumn("_f", F.lit(True)), "n", "left").filter(F.col("is_unique") != F.col("_f").isNotNull())
    assert flagged.count() == N and wrong.count() == 0
    # The rows meet their flag by row id, which spreads evenly; by key they would not.
    assert largest_share(hot, "n") < 0.1 < 0.3 < largest_share(hot, "meter_id", "event_timestamp")


def test_neighbours_with_a_hot_key_spread_by_bucket(spark, hot):
    spread = hot.withColumn("event_timestamp", F.timestamp_add("MINUTE", F.col("n").cast("int"), F.col("event_timestamp")))
    timed = ordered.time_groups(spread, ["meter_id"], "event_timestamp", limit=1000)
    out = ordered.with_neighbours(timed, ["meter_id"], ["event_timestamp", "n"], ["n"], "_group", previous="was")
    assert out.count() == N
    assert out.filter(F.col("was").isNull()).count() == spread.select("meter_id").distinct().count()
    assert largest_share(timed, "_group") < 0.15 < largest_share(timed, "meter_id")


def test_orphans_with_a_hot_missing_key(spark, hot):
    parent = hot.filter("meter_id != 'hot'").select("meter_id").distinct()
    assert integrity.orphans(hot, parent, "meter_id", "meter_id").count() == N // 3
    assert integrity.orphan_count(hot, parent, "meter_id", "meter_id", "t").first()["orphan_records"] == N // 3


def test_latest_and_merge_with_a_hot_key(spark, hot):
    feed = hot.withColumn("operation", F.lit("UPDATE"))
    target = hot.groupBy("meter_id").agg(F.lit(-1.0).alias("consumption_kwh"), F.min("event_timestamp").alias("event_timestamp"))
    how = upsert.Merge(["meter_id"], ["consumption_kwh", "event_timestamp"])
    merged = upsert.merge_latest(target, feed, how, "event_timestamp", "n")
    assert merged.count() == target.count() and merged.filter("consumption_kwh < 0").count() == 0


def test_fact_keys_and_coverage_with_a_hot_key(spark, hot):
    dims = hot.select("meter_id").distinct().filter("meter_id != 'm1'").withColumn("meter_sk", F.lit(1))
    known, unknown = warehouse.resolve_keys(hot, dims, "meter_id", "meter_sk")
    assert known.count() + unknown.count() == N
    bills = hot.select("meter_id", F.lit("2024-01-01").cast("date").alias("period_start"), F.lit("2024-01-31").cast("date").alias("period_end"))
    out = marts.unbilled_readings(hot, bills, "meter_id", "event_timestamp", "consumption_kwh")
    assert out.agg(F.sum("reading_count")).first()[0] == N


def test_hot_partition_is_written_by_several_tasks(spark, hot, tmp_path):
    from gridtally.sinks import files as sink

    fact = hot.filter("meter_id = 'hot'").withColumnsRenamed({"meter_id": "source_household_id", "event_timestamp": "reading_timestamp"})
    wide = fact.withColumn("note", F.sha2(F.col("n").cast("string"), 512))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        sink.write_reading_fact(wide, str(tmp_path / "fact"), "r1")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = os.listdir(tmp_path / "fact" / "reading_date=2024-01-01" / "load_run=r1")
    assert len([f for f in files if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(str(tmp_path / "fact")).count() == N // 3
