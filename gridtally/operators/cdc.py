"""Change records to canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridtally.functions import payload, times
from gridtally.operators import dedup
from gridtally.operators.once import computed_once

# Fixed values.
CHANGE_SOURCE = "datastream_postgres"
SCHEMA_VERSION = "1.0"
NO_METADATA = "Missing required _metadata fields (table or change_type)"
NO_KEY = "Could not determine primary key from payload"
NOT_AN_OBJECT = "Record is not a JSON object"
UPSERTS = ["INSERT", "UPDATE"]

# Primary key of each operational table.
TABLE_KEYS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "premises": "premise_id",
    "contracts": "contract_id",
    "service_points": "service_point_id",
    "meters": "meter_id",
    "meter_readings": "reading_id",
    "bills": "bill_id",
    "payments": "payment_id",
}

# The order in which the guessing mode looks for a key.
GUESSED_KEYS = ["customer_id", "account_id", "meter_id"]


def _primary_key(record: Column, table: Column, guess: bool) -> Column:
    """Key by the table's own key column, or by guessing from the field names.

    First the name of the key field is chosen, then one field is read. An unknown
    table is keyed by its first field. Guessing takes the first of a few well-known
    id fields, which is wrong for rows that also carry their parent's id, so it is
    an opt-in.
    """
    if guess:
        names = F.coalesce(*[F.when(F.map_contains_key(record, name), F.lit(name)) for name in GUESSED_KEYS])
    else:
        names = F.create_map(*[F.lit(x) for pair in TABLE_KEYS.items() for x in pair])[table]
    first = F.try_element_at(F.map_keys(payload.data_fields(record)), F.lit(1))
    return F.try_variant_get(record[F.coalesce(names, first)], "$", "string")


def normalize(lines: DataFrame, ingested_at: str | Column, guess_keys: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Canonical events plus an ``error`` column that is NULL for good records.

    The event time defaults to the ingestion time. ``raw`` keeps the input line, and
    the columns named in ``keep`` go along.
    """
    keep = keep or []
    arrived = times.at(ingested_at) if isinstance(ingested_at, str) else ingested_at
    lines = lines.select(F.col("value").alias("raw"), arrived.alias("ingestion_timestamp"), *keep)
    parsed = computed_once(lines, ["raw", "ingestion_timestamp", *keep], {"_r": payload.fields(F.col("raw"))})
    record = F.col("_r")
    table = payload.metadata_text(record, "table")
    found = parsed.select(
        "raw",
        "ingestion_timestamp",
        record.isNull().alias("_no_object"),
        table.alias("source_table"),
        payload.metadata_text(record, "change_type").alias("operation"),
        _primary_key(record, table, guess_keys).alias("source_primary_key"),
        payload.metadata_text(record, "timestamp").alias("_stamp"),
        F.to_json(payload.data_fields(record)).alias("payload"),
        *keep,
    )
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return found.select(
        F.lit(CHANGE_SOURCE).alias("source_system"),
        "source_table",
        "operation",
        "source_primary_key",
        F.coalesce(times.utc_stamp(F.col("_stamp")), F.col("ingestion_timestamp")).alias("event_timestamp"),
        "ingestion_timestamp",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "payload",
        F.when(F.col("_no_object"), NOT_AN_OBJECT)
        .when(empty("source_table") | empty("operation"), NO_METADATA)
        .when(empty("source_primary_key"), NO_KEY)
        .alias("error"),
        "raw",
        *keep,
    )


def valid(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("error").isNull()).drop("error", "raw")


def invalid(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("error").isNotNull()).select("error", "raw")


def latest_events(events: DataFrame) -> DataFrame:
    """Latest event per table, key and operation."""
    keys = ["source_table", "source_primary_key", "operation"]
    return dedup.latest_per_key(events, keys, "ingestion_timestamp", "event_timestamp", "payload")


def typed(
    events: DataFrame, columns: dict[str, str], table: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Payload fields as typed columns; a bad value becomes NULL. ``table`` picks
    the events of one table."""
    own = events if table is None else events.filter(F.col("source_table") == table)
    keep = ["source_primary_key", "operation", "event_timestamp"] if keep is None else keep
    # Only the wanted fields are parsed, as text; a bad number must not spoil the record.
    text_fields = ", ".join(f"`{name}` string" for name in columns)
    parsed = computed_once(own, keep, {"_r": F.from_json("payload", text_fields)})
    return parsed.select(*keep, *[F.col(f"_r.{name}").try_cast(dtype).alias(name) for name, dtype in columns.items()])


def counters(normalized: DataFrame) -> DataFrame:
    return normalized.agg(
        F.count("*").alias("processed"), F.count("error").alias("invalid")
    )


def lag(events: DataFrame) -> DataFrame:
    """Delay between change and arrival, per table."""
    seconds = times.seconds_between(F.col("event_timestamp"), F.col("ingestion_timestamp"))
    return events.groupBy("source_table").agg(
        F.count("*").alias("events"),
        F.min(seconds).alias("min_lag_seconds"),
        F.max(seconds).alias("max_lag_seconds"),
        (F.sum(seconds).cast("double") / F.count("*")).alias("avg_lag_seconds"),
    )


def unify(snapshot: DataFrame, changes: DataFrame, keys: list[str], time: str, *ties: str) -> DataFrame:
    """Initial snapshot and later changes as one current state per key; on equal
    times the change wins, and a deleted row is left out."""
    base = snapshot.withColumn("operation", F.lit("SNAPSHOT")).withColumn("_rank", F.lit(0))
    feed = changes.withColumn("_rank", F.lit(1))
    everything = base.unionByName(feed, allowMissingColumns=True)
    current = dedup.latest_per_key(everything, keys, time, "_rank", *ties)
    return current.filter(F.col("operation") != "DELETE").drop("_rank")
