"""Change records, pages, notifications and their schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally import session
from gridtally.catalog.base_sql import CHANGES, CHANGE_COLUMNS, CUSTOMERS, CUSTOMER_CHANGES
from gridtally.catalog.registry import query, with_ctes
from gridtally.operators import cdc, evolve
from gridtally.sources import adapters, changes, extracts
from gridtally.sources.adapters import table

INGESTED = "2026-01-01 00:00:00"


def normalized(spark, folder, guess_keys=False):
    return cdc.normalize(adapters.change_lines(spark, folder), INGESTED, guess_keys)


def valid_events(spark, folder):
    return cdc.valid(normalized(spark, folder))


@query("cdc_normalize_valid", with_ctes([CHANGES], f"SELECT {CHANGE_COLUMNS} FROM changes"))
def _(spark, folder):
    return valid_events(spark, folder)


ERRORS = """errors AS (SELECT CASE WHEN value < 10 THEN 'Missing required _metadata fields (table or change_type)'
    WHEN value < 30 THEN 'Record is not a JSON object' WHEN value < 60 THEN 'Could not determine primary key from payload'
    ELSE 'Record is not a JSON object' END AS error,
  CASE WHEN value < 10 THEN '{"customer_id":"C' || user_id || '","status":"ACTIVE"}' WHEN value < 30 THEN 'not json ' || event_id
    WHEN value < 60 THEN '{"customer_id":"","_metadata":{"change_type":"' || CASE WHEN value < 50 THEN 'UPDATE' ELSE 'DELETE' END
      || '","table":"customers","schema":"utility","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z"}}'
    ELSE '[' || event_id || ']' END AS raw
  FROM events WHERE event_type = 'error')"""


@query("cdc_normalize_invalid", with_ctes([ERRORS], "SELECT error, raw FROM errors"))
def _(spark, folder):
    return cdc.invalid(normalized(spark, folder))


@query(
    "cdc_guessed_keys",
    """SELECT CASE event_type WHEN 'signup' THEN 'customers' WHEN 'view' THEN 'meter_readings' WHEN 'click' THEN 'meters' ELSE 'payments' END AS source_table,
       CASE event_type WHEN 'signup' THEN 'C' || user_id WHEN 'purchase' THEN 'ACC-' || user_id ELSE 'M-' || user_id END AS source_primary_key, count(*) AS events
       FROM events WHERE event_type <> 'error' GROUP BY 1, 2""",
)
def _(spark, folder):
    """Keys by the guessing mode: a reading is keyed by its meter, a payment by its account."""
    events = cdc.valid(normalized(spark, folder, guess_keys=True))
    return events.groupBy("source_table", "source_primary_key").agg(F.count("*").alias("events"))


LATEST_CHANGES = f"""latest_changes AS (SELECT {CHANGE_COLUMNS} FROM (SELECT *, row_number() OVER (
  PARTITION BY source_table, source_primary_key, operation ORDER BY ingestion_timestamp DESC, event_timestamp DESC, payload DESC) AS rn FROM changes)
  WHERE rn = 1)"""


@query("cdc_dedup_latest", with_ctes([CHANGES, LATEST_CHANGES], "SELECT * FROM latest_changes"))
def _(spark, folder):
    return cdc.latest_events(valid_events(spark, folder))


@query(
    "cdc_payload_columns",
    """SELECT CAST(event_id AS VARCHAR) AS source_primary_key, CASE WHEN value < 5 THEN 'INSERT' WHEN value < 50 THEN 'UPDATE' ELSE 'DELETE' END AS operation,
       date_trunc('second', ts) AS event_timestamp, value AS reading_value, 'kWh' AS unit_of_measure, 'INTERVAL' AS reading_type,
       'VALID' AS quality_flag, date_trunc('second', ts) AS read_at FROM events WHERE event_type = 'view'""",
)
def _(spark, folder):
    columns = {
        "reading_value": "double", "unit_of_measure": "string", "reading_type": "string", "quality_flag": "string", "read_at": "timestamp_ntz",
    }
    return cdc.typed(valid_events(spark, folder), columns, "meter_readings")


@query("cdc_counters", "SELECT count(*) AS processed, count(*) FILTER (WHERE event_type = 'error') AS invalid FROM events")
def _(spark, folder):
    return cdc.counters(normalized(spark, folder))


@query(
    "cdc_lag",
    with_ctes([CHANGES], """SELECT source_table, count(*) AS events, min(date_diff('second', event_timestamp, ingestion_timestamp)) AS min_lag_seconds,
      max(date_diff('second', event_timestamp, ingestion_timestamp)) AS max_lag_seconds,
      sum(date_diff('second', event_timestamp, ingestion_timestamp))::DOUBLE / count(*) AS avg_lag_seconds FROM changes GROUP BY 1"""),
)
def _(spark, folder):
    return cdc.lag(valid_events(spark, folder))


@query(
    "snapshot_and_changes",
    with_ctes([CUSTOMERS, CUSTOMER_CHANGES], """SELECT customer_id, email, customer_type, operation FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC, source DESC, change_no DESC) AS rn FROM (
          SELECT customer_id, email, customer_type, 'SNAPSHOT' AS operation, TIMESTAMP '1999-01-01' AS event_timestamp, 0 AS source, NULL AS change_no FROM customers
          UNION ALL SELECT customer_id, email, customer_type, operation, event_timestamp, 1, change_no FROM customer_changes))
      WHERE rn = 1 AND operation <> 'DELETE'"""),
)
def _(spark, folder):
    snapshot = adapters.customers(spark, folder).select("customer_id", "email", "customer_type").withColumn(
        "event_timestamp", F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    )
    current = cdc.unify(snapshot, adapters.customer_changes(spark, folder), ["customer_id"], "event_timestamp", "change_no")
    return current.select("customer_id", "email", "customer_type", "operation")


FIELDS = {
    "customers": {"customer_id": "str", "account_id": "str", "status": "str"},
    "meters": {"meter_id": "str", "status": "str"},
    "payments": {"payment_id": "str", "account_id": "str"},
    "meter_readings": {
        "reading_id": "str", "meter_id": "str", "unit_of_measure": "str", "reading_type": "str", "quality_flag": "str", "read_at": "str",
    },
}


def _observed_sql(condition: str) -> str:
    kinds = {"customers": "signup", "meters": "click", "payments": "purchase", "meter_readings": "view"}
    rows = ", ".join(f"('{t}', '{kinds[t]}', '{f}', '{d}')" for t, fields in FIELDS.items() for f, d in fields.items())
    return f"""SELECT DISTINCT t AS table_name, f AS field, d AS dtype FROM (VALUES {rows}) v(t, k, f, d)
        WHERE EXISTS (SELECT 1 FROM events WHERE event_type = k AND {condition})
      UNION SELECT CASE event_type WHEN 'view' THEN 'meter_readings' ELSE 'payments' END, CASE event_type WHEN 'view' THEN 'reading_value' ELSE 'amount' END,
        CASE WHEN value = floor(value) THEN 'int' ELSE 'float' END FROM events WHERE event_type IN ('view', 'purchase') AND {condition}"""


def _one_type_sql(condition: str) -> str:
    return f"""SELECT table_name, field, CASE WHEN string_agg(dtype, ',' ORDER BY dtype) = 'float,int' THEN 'float'
        ELSE string_agg(dtype, '|' ORDER BY dtype) END AS dtype FROM ({_observed_sql(condition)}) GROUP BY ALL"""


@query("observed_schema", _observed_sql("true"))
def _(spark, folder):
    return evolve.observed(valid_events(spark, folder))


@query(
    "schema_diff",
    f"""WITH old AS (SELECT * FROM ({_one_type_sql("value < 5")}) WHERE field <> 'status'),
         new AS (SELECT * FROM ({_one_type_sql("value >= 5")}) WHERE field <> 'unit_of_measure')
       SELECT coalesce(o.table_name, n.table_name) AS table_name, coalesce(o.field, n.field) AS field, o.dtype AS old_type, n.dtype AS new_type,
         CASE WHEN o.dtype IS NULL THEN 'ADDED' WHEN n.dtype IS NULL THEN 'REMOVED' WHEN o.dtype <> n.dtype THEN 'RETYPED' ELSE 'SAME' END AS change,
         NOT (n.dtype IS NULL OR coalesce(o.dtype <> n.dtype, false)) AS compatible
       FROM old o FULL OUTER JOIN new n ON n.table_name = o.table_name AND n.field = o.field""",
)
def _(spark, folder):
    """Schema of the first inserts against that of later changes; one field is left
    out on either side, so that an addition and a removal show."""
    events = valid_events(spark, folder)
    first = evolve.observed(events.filter("operation = 'INSERT'")).filter("field <> 'status'")
    later = evolve.observed(events.filter("operation <> 'INSERT'")).filter("field <> 'unit_of_measure'")
    return evolve.diff(first, later)


@query(
    "registry_evolution",
    f"""WITH seen AS ({_one_type_sql("true")}), old AS (SELECT * FROM seen WHERE field <> 'status')
       SELECT table_name, CAST(0 AS INTEGER) AS version, field, dtype FROM old
       UNION ALL SELECT table_name, CAST(1 AS INTEGER), field, dtype FROM seen
       WHERE table_name IN (SELECT table_name FROM seen EXCEPT ALL SELECT table_name FROM old)""",
)
def _(spark, folder):
    """A registry that does not know the status field yet grows by one version where it occurs."""
    seen = session.materialize(evolve.one_type(evolve.observed(valid_events(spark, folder))), "seen")  # one row a field, used many times
    registry = seen.filter("field <> 'status'").select("table_name", F.lit(0).alias("version"), "field", "dtype")
    return evolve.evolve(registry, seen)[0]


@query(
    "payload_type_errors",
    """SELECT CASE event_type WHEN 'view' THEN CAST(event_id AS VARCHAR) ELSE 'P' || event_id END AS source_primary_key,
       CASE event_type WHEN 'view' THEN 'meter_readings' ELSE 'payments' END AS table_name,
       CASE event_type WHEN 'view' THEN 'reading_value' ELSE 'amount' END AS field,
       CASE event_type WHEN 'view' THEN 'Field ''reading_value'' expected str, got ' || CASE WHEN value = floor(value) THEN 'int' ELSE 'float' END
         ELSE 'Field ''amount'' expected int, got float' END AS error
       FROM events WHERE event_type = 'view' OR (event_type = 'purchase' AND value <> floor(value))""",
)
def _(spark, folder):
    """Payloads checked against a registry that expects text readings and whole amounts."""
    events = valid_events(spark, folder)
    wanted = F.when(F.col("field") == "reading_value", "str").when(F.col("field") == "amount", "int").otherwise(F.col("dtype"))
    registry = evolve.observed(events).withColumn("dtype", wanted).distinct()
    return evolve.type_errors(events, registry, "source_primary_key")


@query(
    "read_old_and_new",
    """SELECT CAST(event_id AS VARCHAR) AS reading_id, CASE WHEN event_type = 'view' THEN value END AS reading_value FROM events WHERE event_type IN ('view', 'click')""",
)
def _(spark, folder):
    events = table(spark, folder, "events")
    ident = F.col("event_id").cast("string").alias("reading_id")
    old = events.filter("event_type = 'click'").select(ident)
    new = events.filter("event_type = 'view'").select(ident, F.col("value").alias("reading_value"))
    return evolve.read_together(old, new)


@query(
    "file_notifications",
    """SELECT event_id, 'gs://meter-raw/' || event_type || '/' || event_id || '.json' AS path FROM events WHERE event_type NOT IN ('error', 'signup')""",
)
def _(spark, folder):
    e = table(spark, folder, "events")
    bucket = F.when(F.col("event_type") != "error", "meter-raw")
    name = F.when(F.col("event_type") == "signup", "").otherwise(F.concat_ws("", "event_type", F.lit("/"), F.col("event_id").cast("string"), F.lit(".json")))
    messages = e.select("event_id", F.to_json(F.struct(bucket.alias("bucket"), name.alias("name"))).alias("value"))
    return changes.notified_paths(messages)


@query("page_unnest", "SELECT event_id, event_type, value FROM events")
def _(spark, folder):
    """Pages of at most 100 items, some bare lists and some under ``data``."""
    e = table(spark, folder, "events")
    paged = e.groupBy(F.floor(F.col("event_id") / 100).alias("page")).agg(
        F.collect_list(F.struct("event_id", "event_type", "value")).alias("items"), F.min("user_id").alias("_any")
    )
    body = F.when(F.col("_any") > 2, F.to_json("items")).otherwise(F.to_json(F.struct(F.col("items").alias("data"))))
    item = e.select("event_id", "event_type", "value").schema
    return extracts.unnest_pages(paged.select("page", body.alias("body")), "body", item).drop("page")
