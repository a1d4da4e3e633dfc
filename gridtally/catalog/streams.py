"""Streaming queries, run to the end of the available data."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally import session
from gridtally.catalog.base_sql import CHANGES
from gridtally.catalog.changes import ERRORS, INGESTED, LATEST_CHANGES
from gridtally.catalog.readings import AS_OF
from gridtally.catalog.registry import query, with_ctes
from gridtally.functions import numbers
from gridtally.sources import adapters, changes as sources, files
from gridtally.streaming import changes, readings


def _split(spark, folder) -> str:
    base = session.fresh_path(spark, "changes")
    adapters.change_lines(spark, folder).write.option("maxRecordsPerFile", 100_000).text(f"{base}/in")
    changes.run_split(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", INGESTED)
    return f"{base}/out"


@query(
    "stream_cdc_counters",
    """SELECT 2 * count(DISTINCT event_type) + 1 AS notifications, count(DISTINCT event_type) AS files_read, CAST(1 AS BIGINT) AS read_errors,
         count(*) AS processed, count(*) FILTER (WHERE event_type = 'error') AS invalid FROM events""",
)
def _(spark, folder):
    """A change file for each kind of event, announced twice, and one that cannot be read, announced once."""
    base = session.fresh_path(spark, "notified")
    lines = adapters.change_lines(spark, folder, ["event_type"]).repartition("event_type")
    lines.write.partitionBy("event_type").option("compression", "gzip").text(f"{base}/in")
    session.put_if_absent(spark, f"{base}/in/event_type=none/half.txt.gz", "this is no archive")
    landed = files.listing(spark, f"{base}/in", "*.gz")
    name = F.regexp_extract("path", "(event_type=.*)$", 1)
    message = F.to_json(F.struct(F.lit("landing").alias("bucket"), name.alias("name")))
    times = F.when(name.contains("half"), F.lit(1)).otherwise(F.lit(2))
    landed.select(F.explode(F.array_repeat(message, times)).alias("value")).write.text(f"{base}/told")
    stream = sources.notification_stream(spark, f"{base}/told")
    changes.write_notified(stream, f"{base}/out", f"{base}/checkpoint", INGESTED, {"gs://landing": f"{base}/in"}).awaitTermination()
    return changes.counters(spark, None, f"{base}/out")


@query("stream_cdc_events", with_ctes([CHANGES, LATEST_CHANGES], "SELECT * FROM latest_changes"))
def _(spark, folder):
    return changes.events(spark, _split(spark, folder))


@query("stream_cdc_errors", with_ctes([ERRORS], "SELECT error, raw FROM errors"))
def _(spark, folder):
    return changes.errors(spark, _split(spark, folder))


@query(
    "stream_cdc_state",
    with_ctes([CHANGES], """SELECT source_table, source_primary_key, operation, event_timestamp FROM (SELECT *, row_number() OVER (
      PARTITION BY source_table, source_primary_key ORDER BY event_timestamp DESC, ingestion_timestamp DESC, operation DESC, payload DESC) AS rn FROM changes) WHERE rn = 1"""),
)
def _(spark, folder):
    state = changes.current_state(changes.events(spark, _split(spark, folder)))
    return state.select("source_table", "source_primary_key", "operation", "event_timestamp")


def _event_stream(spark, folder):
    """The events table as a stream; a large table is a folder of part files."""
    schema = adapters.table(spark, folder, "events").schema
    if session.is_folder(spark, f"{folder}/events.parquet"):
        return readings.file_stream(spark, f"{folder}/events.parquet", schema)
    return readings.file_stream(spark, folder, schema, "events.parquet")


@query(
    "stream_daily_consumption",
    """SELECT CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,4)))::DOUBLE AS total_kwh, count(value) AS reading_count FROM events GROUP BY 1""",
)
def _(spark, folder):
    base = session.fresh_path(spark, "daily")
    readings.daily_partials(_event_stream(spark, folder), f"{base}/out", f"{base}/checkpoint", "ts", "value").awaitTermination()
    return readings.daily_totals(spark, f"{base}/out")


@query(
    "stream_windowed_daily",
    """SELECT date_trunc('day', ts)::TIMESTAMP AS day_start, sum(CAST(value AS DECIMAL(18,4)))::DOUBLE AS total_kwh, count(value) AS reading_count FROM events
       GROUP BY 1 HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 6 HOUR FROM events)""",
)
def _(spark, folder):
    """Days that are over, late readings included."""
    base = session.fresh_path(spark, "windowed")
    readings.daily_partials(_event_stream(spark, folder), f"{base}/out", f"{base}/checkpoint", "ts", "value", "6 hours").awaitTermination()
    out = readings.closed_days(spark, f"{base}/out", "6 hours")
    return out.select("day_start", F.col("total_kwh").cast("double").alias("total_kwh"), "reading_count")


@query("stream_dedup_deliveries", "SELECT event_id, event_type, value FROM events")
def _(spark, folder):
    """Every event is delivered twice; one of each pair is kept."""
    base = session.fresh_path(spark, "deliveries")
    once = _event_stream(spark, folder).select("event_id", "event_type", "value", "ts")
    changes.append_once(once.union(once), f"{base}/out", f"{base}/checkpoint", ["event_id"], "ts").awaitTermination()
    return changes.stored_feed(spark, f"{base}/out").drop("ts")


@query("stream_reading_feed", "SELECT event_id AS reading_id, value FROM events")
def _(spark, folder):
    """The reading feed by its own event time, every reading delivered twice."""
    base = session.fresh_path(spark, "feed")
    once = _event_stream(spark, folder).select(F.col("event_id").alias("reading_id"), F.col("ts").alias("read_at"), "value")
    changes.entity_feed(once.union(once), "meter_reading", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return changes.stored_feed(spark, f"{base}/out").drop("read_at")


@query(
    "stream_fact_append",
    """SELECT CAST(ts AS DATE) AS reading_date, count(*) AS rows, count(DISTINCT user_id) AS households FROM events GROUP BY 1""",
)
def _(spark, folder):
    base = session.fresh_path(spark, "facts")
    facts = _event_stream(spark, folder).select(
        F.col("user_id").cast("string").alias("source_household_id"), F.col("ts").alias("reading_timestamp"),
        F.col("value").alias("consumption_kwh"), F.lit(AS_OF).cast("timestamp_ntz").alias("ingestion_date"),
    )
    readings.append_facts(facts, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    stored = spark.read.parquet(f"{base}/out")
    return stored.groupBy("reading_date").agg(F.count("*").alias("rows"), F.countDistinct("source_household_id").alias("households"))


@query("stream_equals_batch", "SELECT true AS same")
def _(spark, folder):
    """Daily totals of the stream against the batch computation."""
    base = session.fresh_path(spark, "parity")
    readings.daily_partials(_event_stream(spark, folder), f"{base}/out", f"{base}/checkpoint", "ts", "value").awaitTermination()
    stream = readings.daily_totals(spark, f"{base}/out")
    batch = adapters.table(spark, folder, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        numbers.exact_sum(F.col("value"), 4).alias("total_kwh"), F.count("value").alias("reading_count")
    )
    joined = stream.alias("s").join(batch.alias("b"), "day", "full_outer")
    equal = (F.col("s.total_kwh") == F.col("b.total_kwh")) & (F.col("s.reading_count") == F.col("b.reading_count"))
    return joined.agg(F.bool_and(F.coalesce(equal, F.lit(False))).alias("same"))


