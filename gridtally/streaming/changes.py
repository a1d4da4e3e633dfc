"""Change stream: lines in, canonical events, current state and errors out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from gridtally import schemas, session
from gridtally.operators import cdc, dedup
from gridtally.sources import changes, files

STATE_KEYS = ["source_table", "source_primary_key", "operation"]


#: Runs of one level of the stored events that become one run of the next.
RUNS = 8


def _take(spark: SparkSession, out: str, number: int, arrived: DataFrame | list[str], ingested_at: str | Column, guess_keys: bool) -> None:
    """Process a batch of lines, or of paths of change files, below ``out``, under its number."""
    # One parse per batch: the file is the hand-over to the two outputs.
    staged = f"{out}/normalized/batch={number}"

    def stage(lines: DataFrame) -> tuple[list[str], DataFrame]:
        keep = [c for c in lines.columns if c == "source_file"]
        normalized = cdc.normalize(lines, ingested_at, guess_keys, keep)
        normalized.write.mode("overwrite").parquet(staged)
        return keep, normalized

    if isinstance(arrived, list):
        unread: list[str] = []
        try:
            keep, normalized = stage(changes.lines_of(spark, arrived))
        except Exception:
            unread = changes.broken(spark, arrived)
            keep, normalized = stage(changes.lines_of(spark, [p for p in arrived if p not in set(unread)]))
        tried = [(p, p not in set(unread), session.size(spark, p)) for p in arrived]
        spark.createDataFrame(tried, _FILES).write.mode("overwrite").parquet(f"{out}/files/batch={number}")
    else:
        keep, normalized = stage(arrived)
    saved = spark.read.schema(normalized.schema).parquet(staged)
    seen = saved.groupBy(*keep).agg(F.count(F.lit(1)).alias("processed"), F.count("error").alias("invalid"))
    seen.write.mode("overwrite").parquet(f"{out}/counters/batch={number}")
    saved = saved.drop(*keep)
    cdc.latest_events(cdc.valid(saved)).write.mode("overwrite").parquet(f"{out}/events/level=0/run={number}")
    cdc.invalid(saved).write.mode("overwrite").parquet(f"{out}/errors/batch={number}")
    _compact(spark, out, number)


_FILES = "path string, whole boolean, bytes bigint"


def _compact(spark: SparkSession, out: str, number: int) -> None:
    """Reduce every ``RUNS`` runs of a level to one run of the next level.

    An event is reduced once a level, so a batch costs the same however many there were
    before it, and the stored runs grow as a logarithm. Reducing the same events twice
    changes nothing: a compaction that was cut off does no harm and is made again with its
    batch, and runs stay for one more compaction, so that who listed them can read them.
    """
    level, run = 0, number
    while (run + 1) % RUNS == 0:
        first = run + 1 - RUNS
        runs = [f"{out}/events/level={level}/run={r}" for r in range(first, run + 1)]
        reduced = cdc.latest_events(spark.read.schema(schemas.CHANGE_EVENT).parquet(*[r for r in runs if session.exists(spark, r)]))
        reduced.write.mode("overwrite").parquet(f"{out}/events/level={level + 1}/run={run // RUNS}")
        for r in range(first - RUNS, first):
            session.remove(spark, f"{out}/events/level={level}/run={r}")
        level, run = level + 1, run // RUNS


def write_split(arrived: DataFrame, out: str, checkpoint: str, ingested_at: str | Column, guess_keys: bool = False):
    """Start the stream that appends good events and bad records to two tables.

    ``arrived`` holds lines (``value``), or the ``path`` of change files. A file that
    cannot be read to its end gives no lines; it is written down as such, and ``replay``
    takes it when it has landed whole. An error that passes does no harm: a file is only
    given up if it fails again by itself. A batch is written under its own number, so a
    batch that is retried after a lost executor replaces its earlier attempt.
    """

    def both(batch: DataFrame, number: int) -> None:
        # at most the files of a batch; the source may name one twice
        given = sorted({r["path"] for r in batch.collect()}) if "path" in batch.columns else batch
        _take(batch.sparkSession, out, number, given, ingested_at, guess_keys)

    return (
        arrived.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def write_notified(messages: DataFrame, out: str, checkpoint: str, ingested_at: str | Column, stores: dict[str, str] | None = None, guess_keys: bool = False):
    """Start the stream that reads the files which notifications (``value``) announce, as ``write_split`` does.

    A path is read once, however often it is announced, in one batch or several: what
    earlier batches announced is stored, a row a path. ``stores`` says where buckets are,
    by the beginning of their paths.
    """

    def both(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        told = changes.located(changes.notified_paths(batch), stores or {}).groupBy("path").agg(F.count(F.lit(1)).alias("times"))
        told.write.mode("overwrite").parquet(f"{out}/announced/batch={number}")
        every = spark.read.schema("path string, times bigint, batch bigint").option("basePath", f"{out}/announced").parquet(f"{out}/announced")
        earlier = every.filter(F.col("batch") < number).select("path")
        fresh = every.filter(F.col("batch") == number).join(earlier, "path", "left_anti")
        # at most the files that a batch's messages name
        _take(spark, out, number, sorted(r["path"] for r in fresh.select("path").collect()), ingested_at, guess_keys)

    return messages.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_split(spark: SparkSession, source: str, out: str, checkpoint: str, ingested_at: str, files_per_batch: int = 1000) -> None:
    """Process everything that has arrived, then stop."""
    write_split(changes.change_file_stream(spark, source, files_per_batch), out, checkpoint, ingested_at).awaitTermination()


def replay(spark: SparkSession, out: str, ingested_at: str, guess_keys: bool = False) -> int:
    """Read the files anew that could not be read so far; returns how many could be now.

    Each call is a run of its own beside the stream's. The driver sees the paths of unread files.
    """
    paths = sorted(r["path"] for r in unread(spark, out).collect())
    whole = [p for p in paths if p not in set(changes.broken(spark, paths))]
    if whole:
        number = len(session.names(spark, f"{out}/replays"))
        _take(spark, f"{out}/replays/{number:06d}", 0, whole, ingested_at, guess_keys)
    return len(whole)


def _stored(spark: SparkSession, out: str, name: str, schema: str) -> DataFrame:
    """One of the tables below ``out``, replays included."""
    places = [out, *[f"{out}/replays/{n}" for n in session.names(spark, f"{out}/replays")]]
    columns = [part.strip().split(" ")[0] for part in schema.split(",")]
    there = [f"{p}/{name}" for p in places if session.exists(spark, f"{p}/{name}")]
    if not there:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.union, [spark.read.schema(schema).parquet(p).select(*columns) for p in there])


def events(spark: SparkSession, out: str) -> DataFrame:
    """Latest event per table, key and operation over all batches so far, from the compacted runs."""
    return cdc.latest_events(_stored(spark, out, "events", schemas.CHANGE_EVENT))


def counters(spark: SparkSession, source: str | None, out: str) -> DataFrame:
    """What the change stream has done so far, from what its batches stored.

    notifications  announcements of files, repeated ones too; of a stream that lists its
                   ``source``, the files there that hold bytes
    files_read     files that hold bytes and of which every record was taken
    read_errors    files that could not be read to their end, so that no record was taken
    processed      records taken
    invalid        those of them that went to the errors
    """
    seen = _stored(spark, out, "counters", "processed bigint, invalid bigint").agg(
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"), F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid")
    )
    tried = _files(spark, out).agg(F.count_if(F.col("whole") & (F.col("bytes") > 0)).alias("files_read"), F.count_if(~F.col("whole")).alias("read_errors"))
    if source is None:
        told = _stored(spark, out, "announced", "path string, times bigint").agg(F.coalesce(F.sum("times"), F.lit(0)).alias("notifications"))
    else:
        told = files.listing(spark, source).filter("bytes > 0").agg(F.count(F.lit(1)).alias("notifications"))
    # three aggregates of one row each, as one row
    parts = told.unionByName(tried, allowMissingColumns=True).unionByName(seen, allowMissingColumns=True)
    return parts.agg(*(F.sum(c).alias(c) for c in parts.columns))


def _files(spark: SparkSession, out: str) -> DataFrame:
    """Each file tried, its size, and whether it was read whole in the end."""
    return _stored(spark, out, "files", _FILES).groupBy("path").agg(F.max("whole").alias("whole"), F.max("bytes").alias("bytes"))


def unread(spark: SparkSession, out: str) -> DataFrame:
    """Paths of the files that could not be read to their end so far."""
    return _files(spark, out).filter(~F.col("whole")).select("path")


def errors(spark: SparkSession, out: str) -> DataFrame:
    return _stored(spark, out, "errors", schemas.CHANGE_ERROR)


# Event-time column and identity of each entity's feed.
FEEDS = {
    "customer": ("updated_at", "customer_id"),
    "account": ("updated_at", "account_id"),
    "contract": ("updated_at", "contract_id"),
    "service_point": ("updated_at", "service_point_id"),
    "meter": ("updated_at", "meter_id"),
    "meter_reading": ("read_at", "reading_id"),
    "bill": ("bill_date", "bill_id"),
    "payment": ("payment_date", "payment_id"),
}


def entity_feed(stream: DataFrame, entity: str, out: str, checkpoint: str):
    """Store an entity's feed, repeated deliveries dropped. A row counts as repeated
    when both its identity and its event time repeat."""
    moment, key = FEEDS[entity]
    return append_once(stream, out, checkpoint, [key], moment)


def append_once(stream: DataFrame, out: str, checkpoint: str, keys: list[str], moment: str):
    """Append rows whose keys and moment are not stored yet.

    What is stored is what decides, not a watermark: files need not come in time
    order, and a row is neither lost nor kept twice however late it comes. A batch
    is compared with the stored rows of the days it touches only. Rows that lack a
    key cannot be recognized and are all kept. A retried batch replaces itself.
    """
    identity = [*keys, moment]

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in identity])
        dated = batch.withColumn("_day", F.col(moment).cast("date"))
        rows = session.materialize(dated.filter(known).dropDuplicates(identity), "batch")
        fresh = rows
        if session.exists(spark, out):
            stored = spark.read.schema(rows.schema).option("basePath", out).parquet(f"{out}/batch=*")
            stored = stored.join(rows.select("_day").distinct(), "_day", "left_semi")
            fresh = rows.join(stored.filter(~F.col("_metadata.file_path").contains(f"/batch={number}/")).select(*identity), identity, "left_anti")
        (
            session.materialize(fresh.unionByName(dated.filter(~known)), "fresh")
            .write.mode("overwrite")
            .partitionBy("_day")
            .parquet(f"{out}/batch={number}")
        )

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_feed(spark: SparkSession, out: str) -> DataFrame:
    """All rows that ``append_once`` stored."""
    return spark.read.option("basePath", out).parquet(out).drop("batch", "_day")


def batch_counters(normalized: DataFrame) -> tuple[DataFrame, Observation]:
    """The same counters for a batch; read ``Observation.get`` after the write."""
    seen = Observation("change_counters")
    return normalized.observe(seen, F.count(F.lit(1)).alias("processed"), F.count("error").alias("invalid")), seen


def current_state(events: DataFrame) -> DataFrame:
    """One row per table and key: the latest event, whatever its operation."""
    return dedup.latest_per_key(
        events, ["source_table", "source_primary_key"], "event_timestamp", "ingestion_timestamp", "operation", "payload"
    )
