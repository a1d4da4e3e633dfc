"""Upserts into dimensions and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally.catalog.base_sql import ACCOUNTS, BILLS, CONTRACTS, CUSTOMERS, CUSTOMER_CHANGES, METERS, OPS_READINGS, PAYMENTS
from gridtally.catalog.registry import query, with_ctes
from gridtally.catalog.warehouse import LATEST_READINGS
from gridtally.functions import times
from gridtally.operators import cdc, dedup, upsert
from gridtally.sources import adapters

LOADED = "2026-01-01 00:00:00"
EARLIER = "1998-01-01 00:00:00"


def _customer_target(spark, folder):
    active = adapters.customers(spark, folder).filter("status = 'ACTIVE'")
    return active.select(
        "customer_id", "email", "phone", "customer_type",
        F.lit("postgres_ops").alias("source_system"),
        times.at(EARLIER).alias("dw_created_at"),
        times.at(EARLIER).alias("dw_updated_at"),
    )


def _customer_merge(or_equal: bool) -> upsert.Merge:
    now = times.at(LOADED)
    return upsert.Merge(
        keys=["customer_id"],
        update=["email", "phone", "customer_type"],
        guard=upsert.newer("dw_updated_at", "event_timestamp", or_equal),
        on_update={"dw_updated_at": now},
        on_insert={"source_system": F.lit("postgres_ops"), "dw_created_at": now, "dw_updated_at": now},
    )


CUSTOMER_TARGET = """target AS (SELECT customer_id, email, phone, customer_type, 'postgres_ops' AS source_system,
  TIMESTAMP '1998-01-01' AS dw_created_at, TIMESTAMP '1998-01-01' AS dw_updated_at FROM customers WHERE status = 'ACTIVE')"""


def _customer_merge_sql(op: str, condition: str) -> str:
    source = f"""source AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC, change_no DESC) AS rn
      FROM customer_changes WHERE {condition}) WHERE rn = 1)"""
    take = f"t.customer_id IS NULL OR s.event_timestamp {op} t.dw_updated_at"
    return with_ctes([CUSTOMERS, CUSTOMER_CHANGES, CUSTOMER_TARGET, source], f"""
      SELECT coalesce(t.customer_id, s.customer_id) AS customer_id,
        CASE WHEN {take} THEN s.email ELSE t.email END AS email, CASE WHEN {take} THEN s.phone ELSE t.phone END AS phone,
        CASE WHEN {take} THEN s.customer_type ELSE t.customer_type END AS customer_type, 'postgres_ops' AS source_system,
        coalesce(t.dw_created_at, TIMESTAMP '2026-01-01') AS dw_created_at,
        CASE WHEN {take} THEN TIMESTAMP '2026-01-01' ELSE t.dw_updated_at END AS dw_updated_at
      FROM target t FULL OUTER JOIN source s ON s.customer_id = t.customer_id""")


@query("merge_scd1", _customer_merge_sql(">", "true"))
def _(spark, folder):
    return upsert.merge_latest(
        _customer_target(spark, folder), adapters.customer_changes(spark, folder), _customer_merge(False), "event_timestamp", "change_no"
    )


@query("merge_customer_changes", _customer_merge_sql(">=", "operation IN ('INSERT', 'UPDATE')"))
def _(spark, folder):
    return upsert.merge_latest(
        _customer_target(spark, folder), adapters.customer_changes(spark, folder), _customer_merge(True),
        "event_timestamp", "change_no", operations=["INSERT", "UPDATE"],
    )


@query("merge_rerun_same", _customer_merge_sql(">", "true"))
def _(spark, folder):
    """Applying the same changes a second time alters nothing."""
    changes = adapters.customer_changes(spark, folder)
    once = upsert.merge_latest(_customer_target(spark, folder), changes, _customer_merge(False), "event_timestamp", "change_no")
    return upsert.merge_latest(once, changes, _customer_merge(False), "event_timestamp", "change_no")


def _readings(spark, folder):
    return dedup.latest_per_key(adapters.ops_readings(spark, folder), ["reading_id"], "reading_timestamp", "reading_value", "meter_id")


READING_FACT = """fact AS (SELECT reading_id, meter_id, CASE WHEN reading_type = 'MANUAL' THEN NULL ELSE reading_value END AS reading_value, unit,
  reading_timestamp, TIMESTAMP '1998-01-01' AS dw_created_at FROM latest_readings WHERE quality_flag = 'VALID')"""
CORRECTIONS = """corrections AS (SELECT reading_id, meter_id, CASE WHEN reading_type = 'INTERVAL' THEN reading_value + 1 ELSE reading_value END AS reading_value,
  unit, reading_timestamp FROM latest_readings)"""
FACT_CHAIN = [OPS_READINGS, LATEST_READINGS, READING_FACT, CORRECTIONS]


def _fact(spark, folder):
    value = F.when(F.col("reading_type") != "MANUAL", F.col("reading_value"))
    return _readings(spark, folder).filter("quality_flag = 'VALID'").select(
        "reading_id", "meter_id", value.alias("reading_value"), "unit", "reading_timestamp", times.at(EARLIER).alias("dw_created_at")
    )


def _corrections(spark, folder):
    value = F.when(F.col("reading_type") == "INTERVAL", F.col("reading_value") + 1).otherwise(F.col("reading_value"))
    return _readings(spark, folder).select(
        "reading_id", "meter_id", value.alias("reading_value"), "unit", "reading_timestamp", "reading_type"
    )


def _reading_merge() -> upsert.Merge:
    now = times.at(LOADED)
    return upsert.Merge(
        ["reading_id"], ["reading_value", "unit"], upsert.differs("reading_value"), {"dw_created_at": now}, {"dw_created_at": now}
    )


MERGED_READINGS = """SELECT s.reading_id, s.meter_id, s.reading_value, s.unit, s.reading_timestamp,
  CASE WHEN t.reading_id IS NULL OR t.reading_value IS DISTINCT FROM s.reading_value THEN TIMESTAMP '2026-01-01' ELSE t.dw_created_at END AS dw_created_at
  FROM corrections s LEFT JOIN fact t ON t.reading_id = s.reading_id"""


@query("merge_fact_changed", with_ctes(FACT_CHAIN, MERGED_READINGS))
def _(spark, folder):
    return upsert.merge(_fact(spark, folder), _corrections(spark, folder), _reading_merge())


LATE = """late AS (SELECT c.* FROM corrections c JOIN latest_readings r ON r.reading_id = c.reading_id
  WHERE r.reading_type = 'INTERVAL')"""


@query(
    "merge_touched_partitions",
    with_ctes([*FACT_CHAIN, LATE], """SELECT coalesce(t.reading_id, s.reading_id) AS reading_id, coalesce(t.meter_id, s.meter_id) AS meter_id,
      CASE WHEN s.reading_id IS NOT NULL THEN s.reading_value ELSE t.reading_value END AS reading_value, 'kWh' AS unit,
      coalesce(t.reading_timestamp, s.reading_timestamp) AS reading_timestamp,
      CASE WHEN t.reading_id IS NULL OR (s.reading_id IS NOT NULL AND t.reading_value IS DISTINCT FROM s.reading_value)
        THEN TIMESTAMP '2026-01-01' ELSE t.dw_created_at END AS dw_created_at,
      CAST(coalesce(t.reading_timestamp, s.reading_timestamp) AS DATE) AS reading_date
      FROM (SELECT * FROM fact WHERE CAST(reading_timestamp AS DATE) IN (SELECT CAST(reading_timestamp AS DATE) FROM late)) t
      FULL OUTER JOIN late s ON s.reading_id = t.reading_id"""),
)
def _(spark, folder):
    """Late corrections of interval readings: only the days they touch are read and replaced."""
    day = F.col("reading_timestamp").cast("date")
    target = _fact(spark, folder).withColumn("reading_date", day)
    late = _corrections(spark, folder).filter("reading_type = 'INTERVAL'").withColumn("reading_date", day)
    return upsert.merge_partitions(target, late, _reading_merge(), "reading_date").select(*target.columns)


BILL_CHANGES = """bill_changes AS (SELECT 'B-' || l_orderkey AS bill_id, CAST(l_extendedprice AS DECIMAL(12,4)) AS total_amount,
    CASE l_returnflag WHEN 'N' THEN 'PAID' WHEN 'A' THEN 'DISPUTED' ELSE 'OVERDUE' END AS bill_status,
    CASE WHEN l_linestatus = 'F' THEN 'UPDATE' ELSE 'INSERT' END AS operation, l_shipdate AS event_timestamp,
    l_linenumber * 1000000 + l_quantity AS change_no FROM lineitem)"""


@query(
    "merge_event_guard",
    with_ctes([BILLS, BILL_CHANGES], """SELECT b.bill_id, b.account_id, b.bill_date,
        CASE WHEN s.event_timestamp >= CAST(b.bill_date AS TIMESTAMP) + INTERVAL 30 DAY THEN s.total_amount ELSE b.total_amount END::DOUBLE AS total_amount,
        CASE WHEN s.event_timestamp >= CAST(b.bill_date AS TIMESTAMP) + INTERVAL 30 DAY THEN s.bill_status ELSE b.bill_status END AS bill_status,
        CASE WHEN s.event_timestamp >= CAST(b.bill_date AS TIMESTAMP) + INTERVAL 30 DAY THEN TIMESTAMP '2026-01-01'
          ELSE CAST(b.bill_date AS TIMESTAMP) + INTERVAL 30 DAY END AS bq_update_timestamp
      FROM bills b LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bill_id ORDER BY event_timestamp DESC, change_no DESC, total_amount DESC, bill_status DESC) AS rn
        FROM bill_changes) WHERE rn = 1) s ON s.bill_id = b.bill_id"""),
)
def _(spark, folder):
    """Bills change only when the event is not older than the row's last update."""
    line = adapters.table(spark, folder, "lineitem")
    status = F.when(F.col("l_returnflag") == "N", "PAID").when(F.col("l_returnflag") == "A", "DISPUTED").otherwise("OVERDUE")
    changes = line.select(
        F.concat(F.lit("B-"), F.col("l_orderkey").cast("string")).alias("bill_id"),
        F.col("l_extendedprice").cast("decimal(12,4)").alias("total_amount"),
        status.alias("bill_status"),
        F.when(F.col("l_linestatus") == "F", "UPDATE").otherwise("INSERT").alias("operation"),
        F.col("l_shipdate").alias("event_timestamp"),
        (F.col("l_linenumber") * 1000000 + F.col("l_quantity")).alias("change_no"),
    )
    seen = F.timestamp_add("DAY", F.lit(30), F.col("bill_date").cast("timestamp_ntz"))
    target = adapters.bills(spark, folder).select("bill_id", "account_id", "bill_date", "total_amount", "bill_status").withColumn(
        "bq_update_timestamp", seen
    )
    how = upsert.entity_merge("billing", ["total_amount", "bill_status", "bq_update_timestamp"], times.at(LOADED))
    merged = upsert.merge_latest(
        target, changes, how, "event_timestamp", "change_no", "total_amount", "bill_status", operations=["INSERT", "UPDATE"]
    )
    return merged.withColumn("total_amount", F.col("total_amount").cast("double"))


@query(
    "insert_if_absent",
    with_ctes([OPS_READINGS, LATEST_READINGS], """SELECT reading_id, meter_id, reading_value, reading_timestamp AS read_at, TIMESTAMP '1998-01-01' AS bq_insert_timestamp
        FROM latest_readings WHERE quality_flag = 'VALID'
      UNION ALL SELECT reading_id, meter_id, reading_value, reading_timestamp, TIMESTAMP '2026-01-01' FROM (
        SELECT *, row_number() OVER (PARTITION BY reading_id ORDER BY reading_timestamp, reading_value, meter_id) AS rn FROM ops_readings)
      WHERE rn = 1 AND reading_id NOT IN (SELECT reading_id FROM latest_readings WHERE quality_flag = 'VALID')"""),
)
def _(spark, folder):
    """Readings arrive as JSON payloads, with repeats; unseen ids are added once."""
    target = _readings(spark, folder).filter("quality_flag = 'VALID'").select(
        "reading_id", "meter_id", "reading_value", F.col("reading_timestamp").alias("read_at"), times.at(EARLIER).alias("bq_insert_timestamp")
    )
    landed = adapters.ops_readings(spark, folder).select(F.to_json(F.struct("reading_id", "meter_id", "reading_value", "reading_timestamp")).alias("payload"))
    columns = {"reading_id": "string", "meter_id": "string", "reading_value": "double", "reading_timestamp": "timestamp_ntz"}
    source = cdc.typed(landed, columns, keep=[]).withColumnRenamed("reading_timestamp", "read_at").withColumn(
        "bq_insert_timestamp", times.at(LOADED)
    )
    return upsert.insert_new(target, source, ["reading_id"], "read_at", "reading_value", "meter_id")


@query(
    "merge_account",
    with_ctes([ACCOUNTS], """SELECT account_id, account_number, account_status, billing_cycle,
        CASE WHEN account_status = 'CLOSED' THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '1998-01-01' END AS bq_insert_timestamp,
        CASE WHEN account_status = 'CLOSED' OR billing_cycle <> 'MONTHLY' THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '2025-01-01' END AS bq_update_timestamp
      FROM accounts"""),
)
def _(spark, folder):
    accounts = adapters.accounts(spark, folder).select("account_id", "account_number", "account_status", "billing_cycle")
    target = accounts.filter("account_status <> 'CLOSED'").withColumns(
        {"bq_insert_timestamp": times.at(EARLIER), "bq_update_timestamp": times.at("2025-01-01 00:00:00")}
    )
    newer = F.col("billing_cycle") != "MONTHLY"
    changes = accounts.withColumn("operation", F.lit("UPDATE")).withColumn(
        "event_timestamp", F.when(newer, times.at("2025-06-01 00:00:00")).otherwise(times.at("2024-06-01 00:00:00"))
    )
    how = upsert.entity_merge("account", target.columns, times.at(LOADED))
    return upsert.merge_latest(target, changes, how, "event_timestamp", operations=["INSERT", "UPDATE"])


@query(
    "merge_payment",
    with_ctes([PAYMENTS], """SELECT payment_id, payment_status, amount::DOUBLE AS amount, payment_date, TIMESTAMP '2026-01-01' AS bq_update_timestamp FROM (
        SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY payment_date DESC, amount DESC, payment_status DESC) AS rn FROM payments) WHERE rn = 1"""),
)
def _(spark, folder):
    """Payments first seen as pending take their latest state."""
    columns = ["payment_id", "payment_status", "amount", "payment_date"]
    payments = adapters.payments(spark, folder).select(*columns)
    target = dedup.first_per_key(payments, ["payment_id"], "payment_date", "amount", "payment_status").withColumns(
        {"payment_status": F.lit("PENDING"), "bq_update_timestamp": F.col("payment_date")}
    )
    changes = payments.withColumns({"operation": F.lit("UPDATE"), "event_timestamp": F.col("payment_date")})
    how = upsert.entity_merge("payment", target.columns, times.at(LOADED))
    merged = upsert.merge_latest(target, changes, how, "event_timestamp", "amount", "payment_status", operations=["INSERT", "UPDATE"])
    return merged.withColumn("amount", F.col("amount").cast("double"))


# Entities whose merge is the shared one: the sample columns each has.
SHARED = {
    "contract": (adapters.contracts, CONTRACTS, "contracts", ["contract_id", "tariff_code", "commodity_type"], "commodity_type = 'GAS'"),
    "meter": (adapters.meters, METERS, "meters", ["meter_id", "meter_type", "commodity_type", "status"], "status = 'ACTIVE'"),
}


def _register_shared(entity: str) -> None:
    load, cte, name, columns, changed = SHARED[entity]
    key, *rest = columns
    picked = ", ".join(f"CASE WHEN {changed} THEN {c} ELSE 'BEFORE' END AS {c}" for c in rest)
    sql = f"""SELECT {key}, {picked}, TIMESTAMP '2025-01-01' AS bq_insert_timestamp,
      CASE WHEN {changed} THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '2025-01-01' END AS bq_update_timestamp FROM {name}"""

    @query(f"merge_{entity}", with_ctes([cte], sql))
    def _(spark, folder):
        """Rows the warehouse knows in an older state; the changes of some come too late."""
        rows = load(spark, folder).select(*columns)
        seen = times.at("2025-01-01 00:00:00")
        target = rows.select(key, *[F.lit("BEFORE").alias(c) for c in rest]).withColumns(
            {"bq_insert_timestamp": seen, "bq_update_timestamp": seen}
        )
        moment = F.when(F.expr(changed), times.at("2025-06-01 00:00:00")).otherwise(times.at("2024-06-01 00:00:00"))
        changes = rows.withColumns({"operation": F.lit("UPDATE"), "event_timestamp": moment})
        how = upsert.entity_merge(entity, target.columns, times.at(LOADED))
        return upsert.merge_latest(target, changes, how, "event_timestamp", operations=cdc.UPSERTS)


for _entity in SHARED:
    _register_shared(_entity)


@query(
    "merge_location",
    """SELECT 'PR-' || n_nationkey AS premise_id, n_name AS city, r_name AS grid_zone, TIMESTAMP '2026-01-01' AS bq_insert_timestamp,
       TIMESTAMP '2026-01-01' AS bq_update_timestamp FROM nation JOIN region ON r_regionkey = n_regionkey""",
)
def _(spark, folder):
    """Locations of an empty dimension are all inserted."""
    region = adapters.table(spark, folder, "region")
    places = adapters.table(spark, folder, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    changes = places.select(
        F.concat(F.lit("PR-"), F.col("n_nationkey").cast("string")).alias("premise_id"), F.col("n_name").alias("city"),
        F.col("r_name").alias("grid_zone"), F.lit("INSERT").alias("operation"), times.at(EARLIER).alias("event_timestamp"),
    )
    stamps = {"bq_insert_timestamp": times.at(EARLIER), "bq_update_timestamp": times.at(EARLIER)}
    target = changes.filter("operation = 'NONE'").select("premise_id", "city", "grid_zone").withColumns(stamps)
    how = upsert.entity_merge("location", target.columns, times.at(LOADED))
    return upsert.merge_latest(target, changes, how, "event_timestamp", operations=cdc.UPSERTS)
