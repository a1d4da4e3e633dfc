"""Dimensions, facts, keys, history."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally import session
from gridtally.catalog.base_sql import (
    ACCOUNTS, BILLS, CUSTOMERS, CUSTOMER_CHANGES, KEY60, METERS, OPS_READINGS, READINGS,
)
from gridtally.catalog.readings import AS_OF
from gridtally.catalog.integrity import BROKEN_BILLS, broken_bills
from gridtally.catalog.registry import query, with_ctes
from gridtally.functions import keys, text, times
from gridtally.operators import dedup, history, privacy, ranges
from gridtally.plans import stored_history, warehouse
from gridtally.sources import adapters, staging


# --- staging ---------------------------------------------------------------------------


@query(
    "staging_customers",
    with_ctes([CUSTOMERS], """SELECT customer_id, first_name, last_name, email, phone, created_at AS source_created_at,
      updated_at AS source_updated_at FROM customers"""),
)
def _(spark, folder):
    return staging.stage(adapters.customers(spark, folder).withColumnRenamed("customer_id", "id"), "customers")


@query(
    "staging_accounts",
    """SELECT 'ACC-' || c_custkey AS account_id, CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' WHEN c_acctbal > 9000 THEN 'CLOSED' ELSE 'ACTIVE' END AS status,
       n_name AS billing_address, TIMESTAMP '2010-01-01' AS source_created_at, TIMESTAMP '2010-01-01' AS source_updated_at
       FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def _(spark, folder):
    nation = adapters.table(spark, folder, "nation")
    home = adapters.table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("ACC-"), F.col("c_custkey").cast("string")).alias("account_id"), F.col("n_name").alias("billing_address")
    )
    raw = adapters.accounts(spark, folder).join(home, "account_id").withColumnsRenamed({"account_id": "id", "account_status": "status"})
    stamp = times.at("2010-01-01 00:00:00")
    return staging.stage(raw.withColumns({"created_at": stamp, "updated_at": stamp}), "accounts")


@query(
    "staging_meters",
    with_ctes([METERS], """SELECT meter_id, meter_serial_number AS serial_number, meter_type AS model, installation_date, status, service_point_id
      FROM meters"""),
)
def _(spark, folder):
    raw = adapters.meters(spark, folder).withColumnsRenamed({"meter_id": "id", "meter_serial_number": "serial_number", "meter_type": "model"})
    return staging.stage(raw, "meters")


@query("staging_readings", with_ctes([OPS_READINGS], "SELECT reading_id, meter_id, reading_value, unit, reading_timestamp FROM ops_readings"))
def _(spark, folder):
    return staging.stage(adapters.ops_readings(spark, folder).withColumnRenamed("reading_id", "id"), "readings")


# --- dimensions and facts ---------------------------------------------------------------


@query(
    "dim_customer",
    with_ctes([CUSTOMERS], f"""SELECT {KEY60.format('customer_id')} AS customer_sk, customer_id, customer_number, customer_type, status,
      'postgres_ops' AS source_system, TIMESTAMP '2026-01-01' AS bq_insert_timestamp, TIMESTAMP '2026-01-01' AS bq_update_timestamp FROM customers"""),
)
def _(spark, folder):
    return warehouse.dim_customer(adapters.customers(spark, folder), AS_OF)


@query(
    "surrogate_keys",
    with_ctes([BILLS], f"SELECT bill_id, {KEY60.format('bill_id')} AS bill_sk, md5(bill_id) AS bill_key, CAST(strftime(bill_date, '%Y%m%d') AS BIGINT) AS date_sk FROM bills"),
)
def _(spark, folder):
    return adapters.bills(spark, folder).select(
        "bill_id",
        keys.surrogate_key(F.col("bill_id")).alias("bill_sk"),
        keys.text_key(F.col("bill_id")).alias("bill_key"),
        keys.date_key(F.col("bill_date")).alias("date_sk"),
    )


LATEST_READINGS = """latest_readings AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY reading_id ORDER BY reading_timestamp DESC, reading_value DESC, meter_id DESC) AS rn
    FROM ops_readings) WHERE rn = 1)"""


@query("latest_per_key", with_ctes([OPS_READINGS, LATEST_READINGS], "SELECT reading_id, meter_id, reading_value, reading_timestamp FROM latest_readings"))
def _(spark, folder):
    rows = adapters.ops_readings(spark, folder).select("reading_id", "meter_id", "reading_value", "reading_timestamp")
    return dedup.latest_per_key(rows, ["reading_id"], "reading_timestamp", "reading_value", "meter_id")


@query(
    "fact_meter_reading",
    with_ctes([OPS_READINGS, LATEST_READINGS], f"""SELECT {KEY60.format('reading_id')} AS reading_sk, {KEY60.format('meter_id')} AS meter_sk,
      CAST(strftime(reading_timestamp, '%Y%m%d') AS BIGINT) AS date_sk, reading_id, reading_value, unit, reading_timestamp,
      'datastream_events' AS source_system, TIMESTAMP '2026-01-01' AS dw_created_at FROM latest_readings"""),
)
def _(spark, folder):
    return warehouse.reading_fact(adapters.ops_readings(spark, folder), AS_OF)


@query(
    "fact_consumption_daily",
    with_ctes([OPS_READINGS], """SELECT meter_id, CAST(reading_timestamp AS DATE) AS consumption_date,
      CAST(sum(CAST(reading_value AS DECIMAL(18,4))) AS DOUBLE) AS total_consumption, count(*) AS reading_count FROM ops_readings GROUP BY 1, 2"""),
)
def _(spark, folder):
    return warehouse.consumption_fact(adapters.ops_readings(spark, folder), "meter_id", "reading_timestamp", "reading_value")


@query(
    "dim_date",
    """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_sk, CAST(d AS DATE) AS full_date, year(d) AS year, month(d) AS month, day(d) AS day,
       quarter(d) AS quarter, dayofweek(d) + 1 AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
       FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)""",
)
def _(spark, folder):
    return warehouse.dim_date(adapters.table(spark, folder, "orders"), "o_orderdate")


@query(
    "resolve_fact_keys",
    with_ctes([ACCOUNTS, BILLS, BROKEN_BILLS], f"""SELECT bill_id, account_id, {KEY60.format('account_id')} AS account_sk
      FROM broken_bills WHERE account_id IN (SELECT account_id FROM accounts)"""),
)
def _(spark, folder):
    return _resolved(spark, folder)[0]


@query(
    "unresolved_fact_keys",
    with_ctes([ACCOUNTS, BILLS, BROKEN_BILLS], """SELECT bill_id, account_id FROM broken_bills b
      WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account_id = b.account_id)"""),
)
def _(spark, folder):
    return _resolved(spark, folder)[1]


def _resolved(spark, folder):
    known = adapters.accounts(spark, folder).select(
        "account_id", keys.surrogate_key(F.col("account_id")).alias("account_sk")
    )
    return warehouse.resolve_keys(broken_bills(spark, folder), known, "account_id", "account_sk")


# --- history ---------------------------------------------------------------------------

VERSIONS = """points AS (
    SELECT customer_id, event_timestamp, arg_max(struct_pack(e := email, p := phone, t := customer_type, d := operation = 'DELETE'), change_no) AS v
    FROM customer_changes GROUP BY 1, 2),
  marked AS (
    SELECT *, lag(v) OVER (PARTITION BY customer_id ORDER BY event_timestamp) AS was FROM points),
  kept AS (SELECT customer_id, event_timestamp, v FROM marked WHERE was IS NULL OR was IS DISTINCT FROM v),
  spans AS (SELECT *, lead(event_timestamp) OVER (PARTITION BY customer_id ORDER BY event_timestamp) AS valid_to FROM kept),
  versions AS (
    SELECT customer_id, v.e AS email, v.p AS phone, v.t AS customer_type, event_timestamp AS valid_from, valid_to, valid_to IS NULL AS is_current
    FROM spans WHERE NOT v.d)"""
VERSION_CHAIN = [CUSTOMER_CHANGES, VERSIONS]


def customer_versions(spark, folder):
    changes = adapters.customer_changes(spark, folder)
    return history.versions(
        changes, "customer_id", "event_timestamp", history.TRACKED["customer"], "change_no", F.col("operation") == "DELETE"
    )


@query("scd2_versions", with_ctes(VERSION_CHAIN, "SELECT * FROM versions"))
def _(spark, folder):
    return customer_versions(spark, folder)


@query("scd2_incremental", with_ctes(VERSION_CHAIN, "SELECT * FROM versions"))
def _(spark, folder):
    """The stored history after three batches that come in no order of time, the second one twice."""
    changes = session.materialize(adapters.customer_changes(spark, folder), "changes")
    kept = stored_history.History.at(
        spark, session.fresh_path(spark, "history"), changes.schema, "customer_id", "event_timestamp", history.TRACKED["customer"], "change_no"
    )
    of_batch = F.pmod(F.xxhash64("change_no", "customer_id"), F.lit(3))
    for batch in (0, 1, 1, 2):
        kept.apply(changes.filter(of_batch == batch), F.col("operation") == "DELETE", f"batch-{batch}")
    return kept.rows()


@query(
    "scd2_contract_versions",
    """WITH c AS (SELECT 'CTR-' || o_custkey AS contract_id, o_orderdate AS valid_from, o_orderkey AS n, o_orderpriority AS tariff_code,
         CASE o_orderstatus WHEN 'F' THEN 'ACTIVE' WHEN 'O' THEN 'EXPIRED' ELSE 'TERMINATED' END AS contract_status FROM orders),
       p AS (SELECT contract_id, valid_from, arg_max(struct_pack(t := tariff_code, s := contract_status), n) AS v FROM c GROUP BY 1, 2),
       k AS (SELECT * FROM (SELECT *, lag(v) OVER (PARTITION BY contract_id ORDER BY valid_from) AS was FROM p) WHERE was IS DISTINCT FROM v)
       SELECT contract_id, v.t AS tariff_code, v.s AS contract_status, valid_from, lead(valid_from) OVER w AS valid_to,
         lead(valid_from) OVER w IS NULL AS is_current
       FROM k WINDOW w AS (PARTITION BY contract_id ORDER BY valid_from)""",
)
def _(spark, folder):
    orders = adapters.table(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "ACTIVE").when(F.col("o_orderstatus") == "O", "EXPIRED").otherwise("TERMINATED")
    changes = orders.select(
        F.concat(F.lit("CTR-"), F.col("o_custkey").cast("string")).alias("contract_id"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderkey").alias("n"),
        F.col("o_orderpriority").alias("tariff_code"),
        status.alias("contract_status"),
    )
    return history.versions(changes, "contract_id", "at", history.TRACKED["contract"], "n")


@query(
    "point_in_time_join",
    with_ctes([BILLS, *VERSION_CHAIN], """SELECT b.bill_id, b.customer_id, b.bill_date, v.customer_type, v.valid_from, v.valid_to
      FROM bills b JOIN versions v ON v.customer_id = b.customer_id AND CAST(b.bill_date AS TIMESTAMP) >= v.valid_from
        AND (v.valid_to IS NULL OR CAST(b.bill_date AS TIMESTAMP) < v.valid_to)"""),
)
def _(spark, folder):
    bills = adapters.bills(spark, folder).select("bill_id", "customer_id", "bill_date").withColumn("_at", F.col("bill_date").cast("timestamp_ntz"))
    # The history is a stored dimension; a join reads the table, it does not rebuild it.
    versions = session.materialize(customer_versions(spark, folder), "dim-customer-history")
    versions = versions.select("customer_id", "customer_type", "valid_from", "valid_to")
    return ranges.valid_at(bills, versions, "customer_id", "_at", "valid_from", "valid_to").drop("_at")


@query(
    "scd2_soft_delete",
    with_ctes([CUSTOMERS, CUSTOMER_CHANGES], """SELECT c.customer_id, CASE WHEN d.deleted_at IS NOT NULL THEN 'INACTIVE' ELSE c.status END AS status, d.deleted_at
      FROM customers c LEFT JOIN (SELECT customer_id, max(event_timestamp) AS deleted_at FROM customer_changes WHERE operation = 'DELETE' GROUP BY 1) d
        ON d.customer_id = c.customer_id"""),
)
def _(spark, folder):
    current = adapters.customers(spark, folder).select("customer_id", "status")
    deletions = adapters.customer_changes(spark, folder).filter("operation = 'DELETE'")
    return history.soft_delete(current, deletions, "customer_id", "status", "event_timestamp")


@query(
    "pii_pseudonymize",
    with_ctes([CUSTOMERS], """SELECT customer_id, sha256(first_name) AS first_name_hash, sha256(last_name) AS last_name_hash, sha256(email) AS email_hash,
      sha256(phone) AS phone_hash, upper(trim(customer_type)) AS customer_type, year(date_of_birth) AS date_of_birth_year FROM customers"""),
)
def _(spark, folder):
    out = privacy.pseudonymize(adapters.customers(spark, folder))
    return out.select(
        "customer_id", "first_name_hash", "last_name_hash", "email_hash", "phone_hash", "customer_type", "date_of_birth_year"
    )


@query(
    "enum_cleanup",
    with_ctes([CUSTOMERS], """SELECT upper(trim(customer_type)) AS customer_type, count(*) AS customers,
      upper(trim(customer_type)) IN ('RESIDENTIAL', 'COMMERCIAL', 'INDUSTRIAL') AS known FROM customers GROUP BY 1"""),
)
def _(spark, folder):
    cleaned = adapters.customers(spark, folder).select(text.code(F.col("customer_type")).alias("customer_type"))
    counted = cleaned.groupBy("customer_type").agg(F.count("*").alias("customers"))
    return counted.withColumn("known", F.col("customer_type").isin("RESIDENTIAL", "COMMERCIAL", "INDUSTRIAL"))


@query(
    "half_hour_slots",
    with_ctes([READINGS], """SELECT date_trunc('hour', event_timestamp) AS hour, count(DISTINCT event_timestamp) AS slots, count(*) AS readings
      FROM readings WHERE event_timestamp IS NOT NULL GROUP BY 1"""),
)
def _(spark, folder):
    rows = adapters.readings(spark, folder).filter(F.col("event_timestamp").isNotNull())
    return rows.groupBy(times.slot(F.col("event_timestamp"), 60).alias("hour")).agg(
        F.countDistinct("event_timestamp").alias("slots"), F.count("*").alias("readings")
    )
