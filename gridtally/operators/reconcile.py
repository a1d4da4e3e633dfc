"""Comparing what was metered, billed, sent and received."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtally.functions import numbers
from gridtally.operators import ranges

BILLED_STATUSES = ["ISSUED", "PAID"]
NO_BILL = "NO_BILL_ISSUED"
ZERO_BILL = "ZERO_BILL_WITH_CONSUMPTION"


def monthly_consumption(consumption: DataFrame, account: str, day: str, usage: str) -> DataFrame:
    return consumption.groupBy(account, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.sum(numbers.exact(F.col(usage))).alias("metered")
    )


def monthly_billing(bills: DataFrame, account: str, day: str, amount: str, status: str, bill: str) -> DataFrame:
    chosen = bills.filter(F.col(status).isin(BILLED_STATUSES))
    return chosen.groupBy(account, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.sum(numbers.exact(F.col(amount))).alias("billed"), F.count(bill).alias("bill_count")
    )


def metered_against_billed(consumption: DataFrame, billing: DataFrame, account: str) -> DataFrame:
    """Account months with consumption but no bill, or a bill of nothing.

    Both inputs are already one row per account and month, so the join has no
    repeated key on either side.
    """
    joined = consumption.join(billing, [account, "year", "month"], "left")
    unbilled = F.col("bill_count").isNull()
    zero = (F.col("billed") <= 0) & (F.col("metered") > 0)
    return joined.withColumn(
        "reconciliation_status", F.when(unbilled, NO_BILL).when(zero, ZERO_BILL)
    ).filter(F.col("reconciliation_status").isNotNull())


def billed_variance(bills: DataFrame, daily_usage: DataFrame, site: str, start: str, end: str, billed: str) -> DataFrame:
    """Billed minus metered usage of each bill whose period has readings."""
    metered = ranges.usage_in_periods(bills, daily_usage, [site], start, end, "usage", "metered")
    return bills.join(metered, [site, start, end]).withColumn("variance", F.col(billed) - F.col("metered"))


def fingerprint(df: DataFrame, key: str, bucket) -> DataFrame:
    """Row count and order-free digest of the keys per bucket.

    Equal keys cancel in an exclusive or, so the sum of the hashes stands beside it.
    """
    hashed = F.xxhash64(F.col(key).cast("string"))
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("rows"),
        F.bit_xor(hashed).alias("_xor"),
        F.sum(hashed.cast("decimal(20,0)")).alias("_sum"),
    ).select("bucket", "rows", F.struct("_xor", "_sum").alias("digest"))


def compare(source: DataFrame, target: DataFrame, key: str, source_bucket, target_bucket) -> DataFrame:
    """Buckets of source and target with their counts and whether the keys agree."""
    s = fingerprint(source, key, source_bucket).select("bucket", F.col("rows").alias("source_rows"), F.col("digest").alias("_s"))
    t = fingerprint(target, key, target_bucket).select("bucket", F.col("rows").alias("target_rows"), F.col("digest").alias("_t"))
    both = s.join(t, "bucket", "full_outer")
    return both.select(
        "bucket",
        F.coalesce("source_rows", F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).cast("bigint").alias("target_rows"),
        F.col("_s").eqNullSafe(F.col("_t")).alias("keys_match"),
    )


def stage_counts(stages: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per category in every stage, NULL categories included."""
    merged = None
    for name, (df, column) in stages.items():
        counted = df.groupBy(F.col(column).alias("category")).agg(F.count("*").alias("rows")).withColumn("stage", F.lit(name))
        merged = counted if merged is None else merged.unionByName(counted)
    return merged.select("stage", "category", "rows")
