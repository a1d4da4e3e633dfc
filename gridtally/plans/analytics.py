"""Aggregates served from gold readings.

Each takes gold readings (household_id, event_timestamp, consumption_kwh,
stdor_to_u) and groups once; sums are decimal so that they do not depend on the
order in which partitions finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtally.functions import numbers

KWH, TARIFF, HOUSEHOLD, MOMENT = "consumption_kwh", "stdor_to_u", "household_id", "event_timestamp"


def gold_stats(gold: DataFrame, digits: int = 2) -> DataFrame:
    return gold.agg(
        F.count("*").alias("total_rows"),
        F.countDistinct(HOUSEHOLD).alias("distinct_households"),
        numbers.exact_sum(F.col(KWH), digits).alias("total_consumption_kwh"),
        F.min(MOMENT).alias("from_ts"),
        F.max(MOMENT).alias("to_ts"),
    )


def snapshot_summary(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count("*").alias("total_rows"),
        F.countDistinct(HOUSEHOLD).alias("distinct_households"),
        numbers.exact_sum(F.col(KWH), 4).alias("total_consumption_kwh"),
        numbers.row_count(F.col(TARIFF) == "Std").alias("tariff_std_count"),
        numbers.row_count(F.col(TARIFF) == "ToU").alias("tariff_tou_count"),
        F.min(MOMENT).alias("from_ts"),
        F.max(MOMENT).alias("to_ts"),
    )


def columns_of(gold: DataFrame) -> list[str]:
    return list(gold.columns)


def tariff_counts(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col(TARIFF).isNotNull()).groupBy(TARIFF).agg(F.count("*").alias("readings"))


def tariff_distribution(gold: DataFrame) -> DataFrame:
    """Readings per tariff and their share; the total reuses the same shuffle."""
    counts = tariff_counts(gold)
    total = counts.agg(F.sum("readings")).scalar()
    return counts.withColumn("pct", numbers.percent(F.col("readings"), total, 1))


def tariff_breakdown(gold: DataFrame) -> DataFrame:
    return (
        gold.filter(F.col(TARIFF).isNotNull())
        .groupBy(F.col(TARIFF).alias("tariff_code"))
        .agg(
            F.countDistinct(HOUSEHOLD).alias("household_count"),
            F.count(KWH).alias("total_readings"),
            numbers.exact_sum(F.col(KWH)).alias("total_consumption_kwh"),
        )
        .orderBy(F.desc("household_count"), F.asc("tariff_code"))
    )


def daily_series(gold: DataFrame) -> DataFrame:
    return (
        gold.filter(F.col(MOMENT).isNotNull())
        .groupBy(F.col(MOMENT).cast("date").alias("day"))
        .agg(numbers.exact_sum(F.col(KWH), 4).alias("total_kwh"), F.count(KWH).alias("reading_count"))
        .orderBy("day")
    )


def recent_days(gold: DataFrame, days: int = 30) -> DataFrame:
    return (
        gold.filter(F.col(MOMENT).isNotNull())
        .groupBy(F.col(MOMENT).cast("date").alias("day"))
        .agg(numbers.exact_sum(F.col(KWH)).alias("consumption"))
        .orderBy(F.desc("day"))
        .limit(days)
    )


def top_households(gold: DataFrame, n: int = 10) -> DataFrame:
    return (
        gold.groupBy(F.col(HOUSEHOLD).alias("source_household_id"))
        .agg(numbers.exact_sum(F.col(KWH)).alias("total_consumption"), F.count(KWH).alias("reading_count"))
        .orderBy(F.desc("total_consumption"), F.asc("source_household_id"))
        .limit(n)
    )


def zone_profile(df: DataFrame, moment: str, identity: str, value: str) -> DataFrame:
    """Files, columns, rows and value ranges of one storage zone."""
    located = df.withColumn("_file", F.col("_metadata.file_path"))
    return located.agg(
        F.countDistinct("_file").alias("files"),
        F.lit(len(df.columns)).alias("column_count"),
        F.count("*").alias("row_count"),
        F.min(moment).alias("min_ts"),
        F.max(moment).alias("max_ts"),
        F.countDistinct(identity).alias("distinct_ids"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )
