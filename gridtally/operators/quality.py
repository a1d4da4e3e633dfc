"""Quality flags of readings, the split they drive, and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtally import session
from gridtally.functions import numbers, text, times
from gridtally.operators import dedup

# Fixed values.
MAX_KWH = 100
REASONS = {
    "is_complete": "Missing required fields",
    "is_valid": "Anomalous consumption value",
    "is_unique": "Duplicate reading",
}
PASS_RATE = 0.99
MAX_AGE_HOURS = 48


class QualityGateError(RuntimeError):
    """The batch passed too few rows to be loaded."""


def flag_readings(df: DataFrame, row_id: list[str]) -> DataFrame:
    """Add is_complete, is_valid, is_unique and is_good.

    ``row_id`` identifies a row and orders duplicates: the first one is kept.
    """
    checked = df.withColumn(
        "is_complete", F.col("meter_id").isNotNull() & F.col("event_timestamp").isNotNull()
    ).withColumn("is_valid", numbers.within(F.col("consumption_kwh"), 0, MAX_KWH))
    flagged = dedup.first_flag(checked, ["meter_id", "event_timestamp"], row_id, "is_unique")
    return flagged.withColumn("is_good", F.col("is_complete") & F.col("is_valid") & F.col("is_unique"))


def accepted(df: DataFrame, row_id: list[str]) -> DataFrame:
    """The good rows alone: the first row of each meter and moment, if complete and valid.

    The rank is limited before the shuffle, so this costs one scan and one shuffle,
    where the flags of all rows cost two scans and three.
    """
    firsts = dedup.first_per_key(df, ["meter_id", "event_timestamp"], *row_id)
    complete = F.col("meter_id").isNotNull() & F.col("event_timestamp").isNotNull()
    return firsts.filter(complete & numbers.within(F.col("consumption_kwh"), 0, MAX_KWH))


def split(flagged: DataFrame, flag: str = "is_good") -> tuple[DataFrame, DataFrame]:
    """Good rows and the rest; a NULL flag counts as bad."""
    good = F.coalesce(F.col(flag), F.lit(False))
    return flagged.filter(good), flagged.filter(~good)


def rejects(flagged: DataFrame) -> DataFrame:
    """Bad rows with the reasons they failed."""
    _, bad = split(flagged)
    return bad.withColumn("reasons", text.messages(" | ", [(~F.col(f), why) for f, why in REASONS.items()]))


def scores(flagged: DataFrame, *by) -> DataFrame:
    """Percentage of rows passing each check and all of them."""
    def share(flag: str):
        return numbers.percent(F.count_if(F.col(flag)), F.count("*"))

    return flagged.groupBy(*by).agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("is_good")).alias("good_rows"),
        share("is_complete").alias("completeness"),
        share("is_valid").alias("validity"),
        share("is_unique").alias("uniqueness"),
        share("is_good").alias("overall_score"),
    )


def average_scores(quality_runs: DataFrame, default: float | None = 100.0) -> DataFrame:
    """Mean scores over runs, one decimal; ``default`` when there is no run."""
    def mean(c: str):
        avg = F.avg(F.col(c).cast("decimal(18,6)")).cast("decimal(18,6)")
        return F.round(F.coalesce(avg, F.lit(default)), 1).cast("double").alias(c)

    return quality_runs.agg(
        *[mean(c) for c in ("overall_score", "completeness", "validity", "uniqueness")],
        F.count("*").alias("total_runs"),
    )


def gate(flagged: DataFrame, minimum: float = PASS_RATE, flag: str = "is_good") -> DataFrame:
    """Return the good rows, or raise before anything is written.

    Two counts reach the driver; the rows stay where they are, stored with their flags.
    """
    flagged = session.materialize(flagged, "flagged")
    total, passed = flagged.agg(F.count("*"), F.count_if(F.col(flag))).first()
    if total and passed / total < minimum:
        raise QualityGateError(f"{passed} of {total} rows passed, below {minimum:.2%}")
    return split(flagged, flag)[0]


def gate_report(flagged: DataFrame, minimum: float, *by) -> DataFrame:
    """Gate decision per batch."""
    rate = F.count_if(F.col("is_good")) / F.count("*")
    return flagged.groupBy(*by).agg(
        F.count("*").alias("rows_checked"),
        F.count_if(~F.col("is_good")).alias("rows_failed"),
        F.when(rate < minimum, "QUARANTINED").otherwise("LOADED").alias("decision"),
    )


def batch_metrics(flagged: DataFrame, run_id: str, pipeline: str, source: str, seconds: int, at: str) -> DataFrame:
    """The metrics record of one batch."""
    ok = F.col("is_good")
    return flagged.agg(
        F.lit(run_id).alias("run_id"),
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(source).alias("source"),
        F.count("*").alias("records_received"),
        F.count_if(ok).alias("records_processed"),
        F.count_if(~ok).alias("records_rejected"),
        F.count_if(~F.col("is_unique")).alias("duplicate_count"),
        F.count_if(F.col("consumption_kwh").isNull()).alias("null_count"),
        F.count_if(~F.col("is_valid")).alias("validation_failures"),
        F.lit(seconds).cast("bigint").alias("execution_time_seconds"),
        F.lit("SUCCESS").alias("status"),
        times.at(at).alias("run_timestamp"),
    )


def stale(df: DataFrame, read_at: str, received_at: str, hours: int = MAX_AGE_HOURS) -> DataFrame:
    """Rows that arrived later than the allowed age."""
    age = times.seconds_between(F.col(read_at), F.col(received_at))
    return df.filter(age > hours * 3600)


def snapshot_quality(df: DataFrame, tariff: str = "stdor_to_u", kwh: str = "consumption_kwh") -> DataFrame:
    """Null counts, surplus copies and scores of a snapshot, from one grouping.

    Identical rows collapse to one row with a count before the shuffle, so every
    figure is a sum over those counts.
    """
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    zero = F.lit(0)
    counted = copies.agg(
        F.coalesce(F.sum("_n"), zero).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col(tariff).isNull(), F.col("_n"))), zero).cast("bigint").alias("null_tariff"),
        F.coalesce(F.sum(F.when(F.col(kwh).isNull(), F.col("_n"))), zero).cast("bigint").alias("null_kwh"),
        F.coalesce(F.sum(F.col("_n") - 1), zero).cast("bigint").alias("duplicates"),
    )
    total = F.col("total_rows")
    good = total - F.col("null_tariff") - F.col("null_kwh") - F.col("duplicates")

    def remaining(lost: str):
        return F.coalesce(numbers.percent(total - F.col(lost), total, 1), F.lit(100.0))

    return counted.select(
        "*",
        F.greatest(good, zero).cast("bigint").alias("valid_rows"),
        F.coalesce(numbers.percent(good, total, 1), F.lit(0.0)).alias("quality_score"),
        remaining("null_kwh").alias("completeness"),
        remaining("null_tariff").alias("validity"),
        remaining("duplicates").alias("uniqueness"),
    )
