"""Reading stream: daily consumption that equals the batch result, and late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtally import session
from gridtally.functions import numbers
from gridtally.sinks import files as sink


def file_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


PARTIAL = "day date, kwh decimal(28,4), readings bigint, late bigint, newest timestamp_ntz"


def daily_partials(stream: DataFrame, out: str, checkpoint: str, moment: str, value: str, delay: str = "6 hours"):
    """Write each micro-batch's daily partial sums under its batch number.

    Summing the partials gives exactly the batch totals, however the readings are
    spread over files: files need not come in time order, so no reading is left out
    for being late. Readings of a day that was already closed (``delay`` behind the
    newest reading of earlier batches) are added to their day and counted as late.
    A retried batch replaces itself.
    """

    def partial(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = None
        if session.exists(spark, out):
            stored = spark.read.schema(f"{PARTIAL}, batch bigint").option("basePath", out).parquet(out)
            before = stored.filter(F.col("batch") < number).agg(F.max("newest")).first()[0]
        at = F.col(moment).cast("timestamp_ntz")
        closed = F.lit(before).cast("timestamp_ntz") - F.expr(f"interval {delay}")
        late = F.coalesce(F.date_add(at.cast("date"), 1).cast("timestamp_ntz") <= closed, F.lit(False))
        batch.filter(at.isNotNull()).groupBy(at.cast("date").alias("day")).agg(
            F.sum(numbers.exact(F.col(value))).alias("kwh"),
            F.count(value).alias("readings"),
            F.count_if(late).alias("late"),
            F.max(at).alias("newest"),
        ).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        stream.writeStream.foreachBatch(partial)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closed_days(spark: SparkSession, out: str, delay: str = "6 hours") -> DataFrame:
    """Daily totals of the days that are over by more than ``delay``, late readings included.

    The newest day stays open until later readings arrive.
    """
    stored = spark.read.schema(PARTIAL).parquet(out)
    until = stored.agg(F.max("newest") - F.expr(f"interval {delay}")).scalar()
    days = stored.groupBy("day").agg(
        F.sum("kwh").alias("total_kwh"), F.sum("readings").alias("reading_count"), F.sum("late").alias("late_count")
    )
    end = F.date_add("day", 1).cast("timestamp_ntz")
    return days.filter(end <= until).select(F.col("day").cast("timestamp_ntz").alias("day_start"), "total_kwh", "reading_count", "late_count")


def daily_totals(spark: SparkSession, out: str) -> DataFrame:
    stored = spark.read.schema(PARTIAL).parquet(out)
    return stored.groupBy("day").agg(
        F.round(F.sum("kwh"), 4).cast("double").alias("total_kwh"), F.sum("readings").alias("reading_count")
    )


def append_facts(stream: DataFrame, out: str, checkpoint: str):
    """Append facts by reading day. Late rows land in the partition of their day;
    each batch is a run of its own there, so retries do not duplicate rows."""

    def load(batch: DataFrame, number: int) -> None:
        sink.write_reading_fact(batch, out, f"batch-{number}")

    return (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
