"""Readers and writers: what is written from the sample tables is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally import schemas, session
from gridtally.catalog.base_sql import BILLS, GOLD_CHAIN, PAYMENTS
from gridtally.catalog.readings import AS_OF, GOLD_COLUMNS, HOME_CHAIN, NORMALIZED_SQL, SOURCE_SQL, flagged, gold, homes
from gridtally.catalog.registry import query, with_ctes
from gridtally.operators import normalize
from gridtally.plans import pipelines, warehouse
from gridtally.sinks import files as sink
from gridtally.sources import adapters, changes, drops, files, readings


def write_source_csv(spark, folder) -> str:
    """The sample readings as a meter file, whose value header ends in a space."""
    path = session.fresh_path(spark, "source-csv")
    rows = adapters.source_rows(spark, folder)
    rows.withColumnRenamed(normalize.VALUE_COLUMN, normalize.VALUE_COLUMN + " ").write.option("header", "true").csv(path)
    return path


# An empty tariff in a CSV file reads as NULL.
FROM_FILE = f"n AS (SELECT * REPLACE (nullif(\"stdorToU\", '') AS \"stdorToU\") FROM ({NORMALIZED_SQL}))"


@query("csv_readings_scan", with_ctes([SOURCE_SQL, FROM_FILE], "SELECT * FROM n"))
def _(spark, folder):
    return normalize.accepted(normalize.normalize_source(readings.source_csv(spark, write_source_csv(spark, folder))))


@query("ndjson_run_scan", with_ctes([SOURCE_SQL, FROM_FILE], "SELECT * FROM n"))
def _(spark, folder):
    rows = normalize.accepted(normalize.normalize_source(adapters.source_rows(spark, folder)))
    rows = rows.withColumn("stdorToU", F.nullif("stdorToU", F.lit("")))
    base = session.fresh_path(spark, "raw")
    sink.write_raw_chunks(rows, f"{base}/file-a", "run-1")
    return readings.raw_run(spark, base, "run-1")


@query(
    "raw_run_chunks",
    with_ctes([SOURCE_SQL], "SELECT count(*) AS rows, true AS has_bytes FROM source_rows WHERE ok"),
)
def _(spark, folder):
    rows = normalize.accepted(normalize.normalize_source(adapters.source_rows(spark, folder)))
    base = session.fresh_path(spark, "raw")
    sink.write_raw_chunks(rows, f"{base}/file-a", "run-1")
    scanned = readings.raw_run(spark, base, "run-1")
    size = readings.raw_run_bytes(scanned).select((F.col("bytes") > 0).alias("b")).scalar()
    return scanned.agg(F.count("*").alias("rows")).withColumn("has_bytes", size)


@query("cdc_change_lines", "SELECT event_type, count(*) AS lines FROM events GROUP BY 1")
def _(spark, folder):
    """Change files with a blank line after every record."""
    path = session.fresh_path(spark, "change-files")
    kind = adapters.table(spark, folder, "events").select(F.col("event_type").alias("value"))
    kind.withColumn("value", F.explode(F.array("value", F.lit("  ")))).write.option("compression", "gzip").text(path)
    return changes.change_lines(spark, path).groupBy(F.col("value").alias("event_type")).agg(F.count("*").alias("lines"))


@query("gold_layer_roundtrip", with_ctes(GOLD_CHAIN, "SELECT * FROM gold"))
def _(spark, folder):
    root = session.fresh_path(spark, "gold")
    wanted = [*GOLD_COLUMNS, "is_complete", "is_valid", "is_unique", "is_good"]
    rows = flagged(spark, folder).select(*wanted)
    path = sink.write_gold(rows, root, "run-1")
    return readings.layer(spark, path, rows.select(*GOLD_COLUMNS).schema)


@query("latest_snapshot", with_ctes(GOLD_CHAIN, "SELECT * FROM gold"))
def _(spark, folder):
    """An older snapshot holds other rows; only the newest may be returned."""
    root = session.fresh_path(spark, "snapshots")
    rows = gold(spark, folder)
    sink.write_snapshot(rows.filter("stdor_to_u = 'Std'"), root, "run-1")
    sink.write_snapshot(rows, root, "run-2")
    return files.latest_snapshot(spark, root, rows.schema)


@query(
    "file_selection",
    """SELECT day, position, position IN (1, 3) AS selected, rows FROM (
         SELECT CAST(ts AS DATE) AS day, row_number() OVER (ORDER BY CAST(ts AS DATE)) AS position, count(*) AS rows FROM events GROUP BY 1)""",
)
def _(spark, folder):
    """Positions of the landed day files and which of them a request picks."""
    root = session.fresh_path(spark, "days")
    events = adapters.table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    events.select("event_id", "day").write.partitionBy("day").parquet(root)
    landed = files.listing(spark, root, "*.parquet").select(F.regexp_extract("path", r"(day=[^/]+)/", 1).alias("name")).distinct()
    names = sorted(r["name"] for r in landed.collect())
    chosen = files.choose_files(names, ["1", "3", "first", "9999"])
    position = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i + 1)])
    rows = spark.read.parquet(root).groupBy("day").agg(F.count("*").alias("rows"))
    name = F.concat(F.lit("day="), F.col("day").cast("string"))
    return rows.select("day", position[name].cast("bigint").alias("position"), name.isin(chosen).alias("selected"), "rows")


@query(
    "landing_manifest",
    """SELECT 'run-1' AS run_id, 'events' AS dataset, 'SUCCESS' AS status, count(*) AS rows_extracted,
         CAST(max(ts) AS VARCHAR) AS watermark_end FROM events WHERE ts > TIMESTAMP '2024-01-02'
       UNION ALL SELECT 'run-1', 'customer', 'SUCCESS', count(*), NULL FROM customer""",
)
def _(spark, folder):
    base = session.fresh_path(spark, "landing")
    datasets = [
        pipelines.Dataset("events", lambda s: adapters.table(s, folder, "events"), "ts"),
        pipelines.Dataset("customer", lambda s: adapters.table(s, folder, "customer")),
    ]
    pipelines.extract(spark, base, "run-1", datasets, "2026-01-01 00:00:00", {"events": "2024-01-02 00:00:00"})
    manifests = spark.read.schema(schemas.RUN_MANIFEST).option("recursiveFileLookup", "true").json(f"{base}/_manifests")
    return manifests.select("run_id", "dataset", "status", "rows_extracted", "watermark_end")


@query("landed_rows", "SELECT event_id, ts, value, DATE '2026-01-01' AS dt FROM events WHERE ts > TIMESTAMP '2024-01-02'")
def _(spark, folder):
    base = session.fresh_path(spark, "landing")
    dataset = pipelines.Dataset("events", lambda s: adapters.table(s, folder, "events").select("event_id", "ts", "value"), "ts")
    for _attempt in range(2):
        pipelines.extract(spark, base, "run-1", [dataset], "2026-01-01 00:00:00", {"events": "2024-01-02 00:00:00"})
    return spark.read.option("basePath", f"{base}/events").parquet(f"{base}/events").select("event_id", "ts", "value", "dt")


@query(
    "fact_load_partitions",
    with_ctes(GOLD_CHAIN, "SELECT CAST(event_timestamp AS DATE) AS reading_date, count(*) AS rows, count(DISTINCT household_id) AS households FROM gold GROUP BY 1"),
)
def _(spark, folder):
    """Two runs that share their days, one of them repeated: the fact holds both once."""
    path = session.fresh_path(spark, "fact")
    rows = gold(spark, folder).withColumn("processed_at", F.lit(AS_OF).cast("timestamp_ntz"))
    fact = normalize.to_reading_fact(rows)
    of_first = F.crc32(F.col("source_household_id").cast("binary")) % 2 == 0
    for run, part in (("run-1", of_first), ("run-2", ~of_first), ("run-1", of_first)):
        sink.write_reading_fact(fact.filter(part), path, run)
    return spark.read.parquet(path).groupBy("reading_date").agg(
        F.count("*").alias("rows"), F.countDistinct("source_household_id").alias("households")
    )


@query("monthly_fact_layout", with_ctes([BILLS], "SELECT CAST(date_trunc('month', bill_date) AS DATE) AS month, count(*) AS bills FROM bills GROUP BY 1"))
def _(spark, folder):
    path = session.fresh_path(spark, "bills")
    sink.write_monthly_fact(adapters.bills(spark, folder), path, "bill_date", ["account_id"], "run-1")
    return spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("bills"))


@query(
    "master_export",
    with_ctes(HOME_CHAIN, "\nUNION ALL\n".join(
        f"SELECT '{e}' AS entity, '{k}' AS kind, count(*) AS rows FROM homes" for e in ("customer", "account", "service_point", "contract", "meter") for k in ("parquet", "csv")
    )),
)
def _(spark, folder):
    root = session.fresh_path(spark, "master")
    # Five exports share the households, so those are written once and reread.
    master = warehouse.master_data(session.materialize(homes(spark, folder), "households"))
    out = None
    for name, df in master.items():
        paths = sink.export_entity(df, root, name)
        for kind, path in zip(("parquet", "csv"), paths):
            read = spark.read.schema(df.schema).option("header", "true").format(kind).load(path)
            counted = read.agg(F.lit(name).alias("entity"), F.lit(kind).alias("kind"), F.count("*").alias("rows"))
            out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "batch_drop_bills",
    with_ctes([BILLS], "SELECT bill_id, bill_date, 'INCREMENTAL' AS _load_type, true AS has_path, TIMESTAMP '2026-01-01' AS _ingested_at FROM bills WHERE bill_status <> 'PAID'"),
)
def _(spark, folder):
    """Paid bills were loaded before; only the other files are new."""
    root = session.fresh_path(spark, "drop-bills")
    bills = adapters.bills(spark, folder).select("bill_id", "bill_date", "bill_status")
    bills.write.partitionBy("bill_status").parquet(root)
    done = files.listing(spark, f"{root}/bill_status=PAID", "*.parquet")
    paths = drops.new_files(spark, root, done, "*.parquet")
    rows = drops.load(spark, paths, "parquet", bills.drop("bill_status").schema, AS_OF)
    return rows.select("bill_id", "bill_date", "_load_type", (F.col("_file_path") != "").alias("has_path"), "_ingested_at")


@query("batch_drop_payments", with_ctes([PAYMENTS], "SELECT payment_id, bill_id, amount::DOUBLE AS amount, payment_date, 'BACKFILL' AS _load_type FROM payments"))
def _(spark, folder):
    root = session.fresh_path(spark, "drop-payments")
    payments = adapters.payments(spark, folder).select("payment_id", "bill_id", "amount", "payment_date")
    payments.write.option("header", "true").csv(root)
    nothing = files.listing(spark, root, "*.csv").limit(0)
    paths = drops.new_files(spark, root, nothing, "*.csv")
    rows = drops.load(spark, paths, "csv", payments.schema, AS_OF, drops.BACKFILL)
    return rows.select("payment_id", "bill_id", F.col("amount").cast("double").alias("amount"), "payment_date", "_load_type")


@query(
    "meter_batch_pipeline",
    with_ctes([SOURCE_SQL, FROM_FILE, """f AS (SELECT *, row_number() OVER (PARTITION BY meter_id, event_timestamp ORDER BY pos) = 1 AS first_one,
        event_timestamp IS NOT NULL AND coalesce(consumption_kwh BETWEEN 0 AND 100, false) AS fine FROM (SELECT *, row_number() OVER () AS pos FROM n))"""],
        """SELECT 'standardized' AS layer, count(*) AS rows FROM f UNION ALL SELECT 'gold', count(*) FROM f WHERE fine AND first_one
           UNION ALL SELECT 'dead_letter', count(*) FROM f WHERE NOT (fine AND first_one)"""),
)
def _(spark, folder):
    """The whole file-to-gold run; rows per layer."""
    base = session.fresh_path(spark, "batch")
    paths = pipelines.meter_batch(spark, write_source_csv(spark, folder), base, "run-1", AS_OF)
    out = None
    for layer, path in paths.items():
        counted = spark.read.parquet(path).agg(F.lit(layer).alias("layer"), F.count("*").alias("rows"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "backfill_run",
    with_ctes([BILLS], """SELECT bill_id, bill_date, 'bf-1' AS _metadata_run_id, true AS _metadata_is_backfill FROM bills
      WHERE bill_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""),
)
def _(spark, folder):
    """A backfill that runs twice loads its rows once."""
    base = session.fresh_path(spark, "backfill")
    bills = adapters.bills(spark, folder).select("bill_id", "bill_date")

    def load(start: str, end: str):
        return bills

    def write(df) -> None:
        df.write.mode("overwrite").parquet(f"{base}/rows/run=bf-1")

    for _attempt in range(2):
        pipelines.backfill(spark, base, "bf-1", "bills", load, "bill_date", "1996-01-01", "1996-12-31", write)
    return spark.read.parquet(f"{base}/rows").drop("run")
