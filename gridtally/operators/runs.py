"""The run log: an append-only table of run events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridtally.functions import numbers
from gridtally.operators import dedup

FINISHED = ["SUCCESS", "FAILED"]


def current(events: DataFrame, run: str = "run_id", at: str = "event_time", tie: str = "event_id") -> DataFrame:
    """Latest state of every run; completed_at is set once it has finished."""
    latest = dedup.latest_per_key(events, [run], at, tie)
    return latest.withColumn("completed_at", F.when(F.col("status").isin(FINISHED), F.col(at)))


def newest(runs: DataFrame, at: str, tie: str, limit: int | None = None) -> DataFrame:
    ordered = runs.orderBy(F.desc(at), F.asc(tie))
    return ordered if limit is None else ordered.limit(limit)


def of_pipeline(runs: DataFrame, column: str, value, at: str, tie: str) -> DataFrame:
    return newest(runs.filter(F.col(column) == value), at, tie)


def lookup(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def page(df: DataFrame, key: str, skip: int = 0, limit: int = 50) -> DataFrame:
    """One page of a listing, ordered by key so that pages do not overlap."""
    return df.orderBy(key).offset(skip).limit(limit)


def status(runs: DataFrame, rows: str, at: str, ready: str) -> DataFrame:
    """Totals over a stage's runs."""
    return runs.agg(
        F.count("*").alias("total_runs"),
        F.max(at).alias("last_run"),
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("total_rows"),
        numbers.row_count(F.col("status") == "SUCCESS").alias("processed_resources"),
    ).withColumn("status", F.when(F.col("total_runs") > 0, ready).otherwise("Not configured"))


def dashboard(runs: DataFrame, dead: DataFrame, quality_runs: DataFrame, rows: str, source: str) -> DataFrame:
    """One row of platform figures; each input is reduced to one row first."""
    r = runs.agg(
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("records_processed"),
        numbers.row_count(F.col("status") == "FAILED").alias("failed_runs"),
        F.countDistinct(source).alias("active_sources"),
    )
    avg = F.avg(F.col("overall_score").cast("decimal(18,6)")).cast("decimal(18,6)")
    return r.select(
        "*",
        dead.agg(F.count("*")).scalar().alias("dlq_count"),
        quality_runs.agg(F.round(F.coalesce(avg, F.lit(0)), 1).cast("double")).scalar().alias("quality_score"),
    )


def stage_summary(ingested: DataFrame, standardized: DataFrame, gold: DataFrame, dead: DataFrame, rows: str, at: str) -> DataFrame:
    """Runs, rows, rejects and state of each pipeline stage, one row per stage."""
    def of_runs(name: str, runs: DataFrame) -> DataFrame:
        return runs.agg(
            F.lit(name).alias("stage"),
            F.count("*").alias("runs"),
            F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("rows"),
            F.max(at).alias("last_run"),
        ).withColumn("stage_status", F.when(F.col("runs") > 0, "PASS").otherwise("PENDING"))

    std_rows = standardized.agg(F.coalesce(F.sum(rows), F.lit(0)).cast("bigint")).scalar()
    gold_row = gold.agg(F.lit("Gold").alias("stage"), F.count("*").alias("rows")).select(
        "stage",
        "rows",
        F.when(F.col("rows") > 0, "PASS").otherwise("PENDING").alias("stage_status"),
        F.greatest(std_rows - F.col("rows"), F.lit(0)).alias("rejected"),
        dead.agg(F.count("*")).scalar().alias("dlq"),
    )
    return (
        of_runs("Raw", ingested)
        .unionByName(of_runs("Standardized", standardized))
        .unionByName(gold_row, allowMissingColumns=True)
        .select("stage", "runs", "rows", "last_run", "rejected", "dlq", "stage_status")
    )


def volume_alerts(runs: DataFrame, pipeline: str, day: str, rows: str, drop: float = 0.20, days: int = 7) -> DataFrame:
    """Days whose volume is more than ``drop`` below the average of the ``days`` before.

    The window runs over one row per pipeline and day, not over records, and counts
    days of the calendar: a day without a run is no day of the average.
    """
    daily = runs.groupBy(pipeline, day).agg(F.sum(rows).alias("records"))
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    trailing = Window.partitionBy(pipeline).orderBy(number).rangeBetween(-days, -1)
    known = daily.withColumn("trailing_average", F.avg("records").over(trailing))
    return known.filter(F.col("records") < (1 - drop) * F.col("trailing_average"))
