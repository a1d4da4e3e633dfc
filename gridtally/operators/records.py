"""Checks on operational records before they are loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridtally.functions import numbers, text
from gridtally.operators.cdc import TABLE_KEYS

# Fixed values.
MAX_READING = 999999
NO_ID = "Missing primary key / ID field"
NEGATIVE_READING = "Negative reading_value not allowed"
HUGE_READING = "reading_value exceeds realistic maximum"
TEXT_READING = "reading_value must be numeric"
NO_READ_AT = "read_at timestamp is required"
NEGATIVE_AMOUNT = "Financial amount cannot be negative"
TEXT_AMOUNT = "Amount must be numeric"
ZERO_STAMP = "Invalid zero-timestamp in "


def _identifier_columns(table: str) -> list[str]:
    return list(dict.fromkeys([TABLE_KEYS.get(table, "id"), "id", f"{table[:-1]}_id", f"{table}_id"]))


def _number_findings(value: Column, checks: list[tuple[str, str]], not_a_number: str) -> list[tuple[Column, str]]:
    number = numbers.number_or_null(value.cast("string"))
    tests = {"negative": number < 0, "huge": (number > MAX_READING) & ~F.isnan(number)}
    found = [(tests[kind], message) for kind, message in checks]
    return [*found, (value.isNotNull() & number.isNull(), not_a_number)]


def findings(df: DataFrame, table: str) -> list[tuple[Column, str]]:
    """(condition, message) pairs that apply to a table with these columns."""
    has = set(df.columns)
    ids = [c for c in _identifier_columns(table) if c in has]
    no_id = F.lit(True)
    for c in ids:
        no_id = no_id & text.blank(F.col(c))
    found: list[tuple[Column, str]] = [(no_id, NO_ID)]
    if table == "meter_readings":
        if "reading_value" in has:
            found += _number_findings(
                F.col("reading_value"), [("negative", NEGATIVE_READING), ("huge", HUGE_READING)], TEXT_READING
            )
        found.append((text.blank(F.col("read_at")) if "read_at" in has else F.lit(True), NO_READ_AT))
    if table in ("bills", "payments"):
        amounts = [F.col(c).cast("string") for c in ("total_amount", "amount") if c in has]
        if amounts:
            found += _number_findings(F.coalesce(*amounts), [("negative", NEGATIVE_AMOUNT)], TEXT_AMOUNT)
    for name, dtype in df.dtypes:
        if dtype == "string" and ("date" in name or "_at" in name):
            found.append((F.coalesce(F.col(name).startswith("0000"), F.lit(False)), ZERO_STAMP + name))
    return found


def validate(df: DataFrame, table: str) -> DataFrame:
    """Add ``errors``: messages joined with "; ", empty for a good record."""
    return df.withColumn("errors", text.messages("; ", findings(df, table)))
