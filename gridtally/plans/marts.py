"""Reporting tables. Two facts are each reduced to the mart's grain before they
meet, so no join multiplies rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtally.functions import numbers, times
from gridtally.operators import ranges

CANCELLED = "CANCELLED"


def monthly_revenue(star: DataFrame) -> DataFrame:
    """Revenue and bill count by month, customer type and commodity."""
    return (
        star.filter(F.col("bill_status") != CANCELLED)
        .groupBy(times.month_start(F.col("bill_date")).alias("billing_month"), "customer_type", "commodity_type")
        .agg(
            numbers.exact_sum(F.col("total_amount")).alias("total_revenue"),
            F.countDistinct("bill_id").alias("total_bills_issued"),
        )
        .orderBy(F.desc("billing_month"), "customer_type", "commodity_type")
    )


def revenue_monthly(bills: DataFrame, payments: DataFrame) -> DataFrame:
    """Billed and collected per account and month."""
    billed = bills.groupBy("account_id", times.month_start(F.col("bill_date")).alias("month")).agg(
        F.sum(numbers.exact(F.col("total_amount"))).alias("_billed"), F.count("*").alias("bill_count")
    )
    collected = (
        payments.filter(F.col("payment_status") == "CLEARED")
        .groupBy("account_id", times.month_start(F.col("payment_date")).alias("month"))
        .agg(F.sum(numbers.exact(F.col("amount"))).alias("_collected"), F.count("*").alias("payment_count"))
    )
    both = billed.join(collected, ["account_id", "month"], "full_outer")
    zero = F.lit(0).cast("decimal(28,4)")
    total, paid = F.coalesce("_billed", zero), F.coalesce("_collected", zero)
    return both.select(
        "account_id",
        "month",
        total.cast("double").alias("total_billed"),
        paid.cast("double").alias("total_collected"),
        F.when(total > 0, paid.cast("double") / total.cast("double")).alias("collection_rate"),
        F.coalesce("bill_count", F.lit(0)).cast("bigint").alias("bill_count"),
        F.coalesce("payment_count", F.lit(0)).cast("bigint").alias("payment_count"),
    )


def payment_lag(bills: DataFrame, payments: DataFrame) -> DataFrame:
    """Days from bill to first payment and to settlement; overdue if the first
    payment came after the due date."""
    first = payments.groupBy("bill_id").agg(
        F.min("payment_date").cast("date").alias("first_payment_date"),
        F.min("settled_at").cast("date").alias("settled_date"),
    )
    return bills.join(first, "bill_id", "left").select(
        "bill_id",
        "account_id",
        "bill_date",
        "due_date",
        "first_payment_date",
        "settled_date",
        F.datediff("first_payment_date", "bill_date").cast("bigint").alias("days_to_first_payment"),
        F.datediff("settled_date", "bill_date").cast("bigint").alias("days_to_settlement"),
        (F.col("first_payment_date") > F.col("due_date")).alias("is_overdue"),
    )


def unbilled_readings(
    readings: DataFrame, bills: DataFrame, site: str, moment: str, value: str, owners: DataFrame | None = None, key: str | None = None
) -> DataFrame:
    """Readings per site and day, and whether some bill covers the day.

    Readings that do not know their site are summed per ``key`` and day first, and only
    these sums meet ``owners``, which leads from the key to the site.
    """
    by = site if owners is None else key
    daily = readings.groupBy(by, F.col(moment).cast("date").alias("day")).agg(
        F.count("*").alias("reading_count"), F.sum(numbers.exact(F.col(value))).alias("total_kwh")
    )
    if owners is not None:
        daily = daily.join(owners.select(key, site), key).groupBy(site, "day").agg(
            F.sum("reading_count").alias("reading_count"), F.sum("total_kwh").alias("total_kwh")
        )
    daily = daily.withColumn("total_kwh", F.col("total_kwh").cast("double"))
    covered = ranges.covered_days(daily, bills, [site], "period_start", "period_end", "is_billed")
    return covered.select(site, F.col("day").alias("read_date"), "reading_count", "total_kwh", "is_billed")


def churn_signals(payments: DataFrame, bills: DataFrame, suspensions: DataFrame) -> DataFrame:
    """Failed payments, disputed bills and suspensions per customer and month.

    Each input has customer_id and a month; every signal is counted on its own
    and the counts are summed, so no input multiplies another.
    """
    def signal(df: DataFrame, condition, name: str) -> DataFrame:
        counted = df.filter(condition).groupBy("customer_id", "month").agg(F.count("*").alias("_n"))
        names = ("payment_failures", "disputes", "suspensions")
        return counted.select(
            "customer_id", "month", *[(F.col("_n") if n == name else F.lit(0)).cast("bigint").alias(n) for n in names]
        )

    every = (
        signal(payments, F.col("payment_status") == "FAILED", "payment_failures")
        .unionByName(signal(bills, F.col("bill_status") == "DISPUTED", "disputes"))
        .unionByName(signal(suspensions, F.lit(True), "suspensions"))
    )
    return every.groupBy("customer_id", "month").agg(
        *[F.sum(n).cast("bigint").alias(n) for n in ("payment_failures", "disputes", "suspensions")]
    )


def pipeline_health(runs: DataFrame) -> DataFrame:
    """Rows in, out and rejected per pipeline and day."""
    summed = runs.groupBy("pipeline_name", "run_date").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("rows_read", "rows_written", "rows_dlq")],
        F.sum("duration_seconds").cast("double").alias("duration_seconds"),
        numbers.row_count(F.col("status") == "FAILED").alias("_failed"),
    )
    return summed.select(
        "pipeline_name",
        "run_date",
        "rows_read",
        "rows_written",
        "rows_dlq",
        F.when(F.col("rows_read") > 0, F.col("rows_dlq") / F.col("rows_read")).alias("dlq_rate"),
        "duration_seconds",
        F.when(F.col("_failed") > 0, "FAILED").when(F.col("rows_dlq") > 0, "PARTIAL").otherwise("SUCCESS").alias("status"),
    )
