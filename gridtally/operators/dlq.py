"""Dead letters: building, listing and replaying them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from gridtally.functions import keys, text, times

PENDING = "PENDING"
UNRESOLVED = "UNRESOLVED"
VALIDATION_ERROR = "VALIDATION_ERROR"


def dead_letters(
    bad: DataFrame, error: str, source_system: str, table: str, at: str, category: str = VALIDATION_ERROR, attempt: int = 1
) -> DataFrame:
    """One dead letter per bad row, holding the whole row as JSON.

    The id is a digest of the content, so building the same letters twice gives
    the same ids.
    """
    body = [c for c in bad.columns if c != error]
    letters = bad.select(text.row_json(*body).alias("original_payload"), F.col(error).alias("error_message"))
    return letters.select(
        keys.record_id(F.lit(table), F.col("original_payload"), F.col("error_message")).alias("dlq_id"),
        F.lit(source_system).alias("source_system"),
        F.lit(table).alias("source_table"),
        "original_payload",
        F.lit(category).alias("error_category"),
        "error_message",
        F.lit(attempt).cast("int").alias("processing_attempt_count"),
        times.at(at).alias("failure_timestamp"),
        F.lit(UNRESOLVED).alias("status"),
    )


def events(bad: DataFrame, reasons: str, source: str, dataset: str, body: list[str], limit: int | None = None) -> DataFrame:
    """Short failure events: reasons plus the first 500 characters of the row.

    All bad rows are reported; ``limit`` only trims what a screen shows.
    """
    out = bad.select(
        keys.record_id(F.lit(dataset), *[F.col(c) for c in body]).alias("event_id"),
        F.lit(source).alias("source"),
        F.lit(dataset).alias("dataset"),
        F.lit("VALIDATION_FAILED").alias("error_type"),
        F.col(reasons).alias("error_message"),
        text.snippet(text.row_json(*body)).alias("payload_reference"),
        F.lit(1).alias("attempt_count"),
        F.lit(PENDING).alias("status"),
    )
    return out if limit is None else out.orderBy("event_id").limit(limit)


def pending(issues: DataFrame, newest: str, tie: str, limit: int = 100) -> DataFrame:
    """Newest open issues."""
    return issues.filter(F.col("status") == PENDING).orderBy(F.desc(newest), F.asc(tie)).limit(limit)


def replay(
    letters: DataFrame, schema: str, validate: Callable[[DataFrame], DataFrame], error: str = "errors"
) -> tuple[DataFrame, DataFrame]:
    """Validate stored payloads again.

    Returns the rows that now pass, and the letters that still fail with one more
    attempt and status PROCESSING.
    """
    again = letters.select(
        F.struct(*letters.columns).alias("_letter"), F.from_json("original_payload", schema).alias("_row")
    ).select("_letter", "_row.*")
    checked = validate(again)
    passed = F.col(error) == ""
    resolved = checked.filter(passed).drop("_letter", error)
    still = checked.filter(~passed).select(F.col(error).alias("_why"), "_letter.*")
    failed = (
        still.withColumn("error_message", F.col("_why"))
        .withColumn("processing_attempt_count", F.col("processing_attempt_count") + 1)
        .withColumn("status", F.lit("PROCESSING"))
        .drop("_why")
    )
    return resolved, failed


def quarantine(bad: DataFrame, reasons: str, run_id: str, dataset: str, body: list[str], at: str, file_uri: str | None = None) -> DataFrame:
    """Rejected rows of a whole batch, kept for inspection."""
    return bad.select(
        keys.record_id(F.lit(run_id), F.lit(dataset), *[F.col(c) for c in body]).alias("quarantine_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(dataset).alias("dataset"),
        (F.col(file_uri) if file_uri else F.lit(None).cast("string")).alias("original_file_uri"),
        text.row_json(*body).alias("record_content"),
        F.col(reasons).alias("rejection_reason"),
        times.at(at).alias("quarantined_at"),
    )
