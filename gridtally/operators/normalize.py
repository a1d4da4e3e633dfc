"""From source strings to standardized readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridtally.functions import numbers, text, times

# Fixed values.
READING_SOURCE = "uk_power_networks"
HOUSEHOLD_PREFIX = "MAC"
METER_PREFIX = "METER-"
VALUE_COLUMN = "KWH/hh (per half hour)"
NO_VALUE = "Null"


def meter_of(household: Column) -> Column:
    return F.concat(F.lit(METER_PREFIX), F.replace(household, F.lit(HOUSEHOLD_PREFIX), F.lit("")))


def normalize_source(rows: DataFrame, null_as_zero: bool = False) -> DataFrame:
    """Normalized readings of a source file, with a ``reject_reason`` column.

    A row is rejected without a household or with a value that is no number. The
    marker for a missing value becomes NULL, or 0.0 where the caller asks for it.
    A timestamp in another format becomes NULL and fails completeness later.
    """
    raw_value = F.trim(F.coalesce(F.col(f"`{VALUE_COLUMN}`"), F.lit("0")))
    parsed = raw_value.try_cast("double")
    missing = F.lit(0.0) if null_as_zero else F.lit(None).cast("double")
    household = F.col("LCLid")
    return rows.select(
        meter_of(household).alias("meter_id"),
        household.alias("household_id"),
        times.iso_text(times.meter_stamp(F.col("DateTime"))).alias("event_timestamp"),
        F.when(raw_value == NO_VALUE, missing).otherwise(parsed).alias("consumption_kwh"),
        F.col("stdorToU"),
        F.lit(READING_SOURCE).alias("source_system"),
        F.when(text.blank(household), "no household")
        .when((raw_value != NO_VALUE) & parsed.isNull(), "value is no number")
        .alias("reject_reason"),
    )


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def scan_counts(normalized: DataFrame) -> DataFrame:
    """Rows read, accepted and rejected."""
    bad = F.col("reject_reason").isNotNull()
    return normalized.agg(
        F.count("*").alias("rows_read"),
        numbers.row_count(~bad).alias("rows_valid"),
        numbers.row_count(bad).alias("rows_invalid"),
    )


def standardize(
    raw: DataFrame, ingestion_run_id: str, standardize_run_id: str, processed_at: str, null_as_zero: bool = False
) -> DataFrame:
    """Typed readings with audit columns.

    Missing identifiers stay NULL so that the completeness rule can see them.
    ``null_as_zero`` turns a missing consumption into 0.0.
    """
    tariff = F.col("stdorToU").cast("string") if "stdorToU" in raw.columns else F.lit(None).cast("string")
    moment = raw.schema["event_timestamp"].dataType.typeName()
    stamp = F.col("event_timestamp")
    if moment == "string":
        stamp = times.utc_stamp(stamp)
    kwh = F.col("consumption_kwh").try_cast("double")
    return raw.select(
        F.col("meter_id").cast("string").alias("meter_id"),
        F.col("household_id").cast("string").alias("household_id"),
        stamp.cast("timestamp_ntz").alias("event_timestamp"),
        (F.coalesce(kwh, F.lit(0.0)) if null_as_zero else kwh).alias("consumption_kwh"),
        tariff.alias("stdor_to_u"),
        F.col("source_system").cast("string").alias("source_system"),
        times.at(processed_at).alias("processed_at"),
        F.lit(ingestion_run_id).alias("ingestion_run_id"),
        F.lit(standardize_run_id).alias("standardize_run_id"),
    )


def to_reading_fact(gold: DataFrame) -> DataFrame:
    """Gold readings under the fact table's column names."""
    return gold.withColumnsRenamed(
        {
            "household_id": "source_household_id",
            "event_timestamp": "reading_timestamp",
            "processed_at": "ingestion_date",
        }
    )


def union_batches(*batches: DataFrame) -> DataFrame:
    """All rows of all batches; a column absent from one is NULL there."""
    merged = batches[0]
    for batch in batches[1:]:
        merged = merged.unionByName(batch, allowMissingColumns=True)
    return merged
