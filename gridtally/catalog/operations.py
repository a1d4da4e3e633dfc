"""Run log, listings, extracts and backfills."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally.catalog.base_sql import BILLS, CUSTOMERS, FLAGGED, GOLD_CHAIN, READINGS, RUN_EVENTS, RUNS
from gridtally.catalog.quality import DAY_SCORES, FLAG_CHAIN, quality_runs
from gridtally.catalog.readings import flagged, gold
from gridtally.catalog.registry import query, with_ctes
from gridtally.operators import differences, dlq, reconcile, runs
from gridtally.plans import pipelines
from gridtally.sources import adapters, extracts


@query(
    "run_state",
    with_ctes([RUN_EVENTS], """SELECT run_id, status, event_time, rows_received, event_id,
      CASE WHEN status IN ('SUCCESS', 'FAILED') THEN event_time END AS completed_at FROM (
        SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_time DESC, event_id DESC) AS rn FROM run_events) WHERE rn = 1"""),
)
def _(spark, folder):
    return runs.current(adapters.run_events(spark, folder))


def _status_sql(ready: str) -> str:
    return f"""SELECT count(*) AS total_runs, max(started_at) AS last_run, sum(rows_received)::BIGINT AS total_rows,
      count(*) FILTER (WHERE status = 'SUCCESS') AS processed_resources, '{ready}' AS status FROM runs"""


@query("ingestion_status", with_ctes([RUNS], _status_sql("Connected")))
def _(spark, folder):
    return runs.status(adapters.runs(spark, folder), "rows_received", "started_at", "Connected")


@query(
    "processing_status",
    with_ctes([RUN_EVENTS], """SELECT count(*) AS total_runs, max(event_time) AS last_run, sum(rows_received)::BIGINT AS total_rows,
      count(*) FILTER (WHERE status = 'SUCCESS') AS processed_resources, 'Operational' AS status FROM (
        SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_time DESC, event_id DESC) AS rn FROM run_events) WHERE rn = 1"""),
)
def _(spark, folder):
    return runs.status(runs.current(adapters.run_events(spark, folder)), "rows_received", "event_time", "Operational")


@query("recent_runs", with_ctes([RUNS], "SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 50"))
def _(spark, folder):
    return runs.newest(adapters.runs(spark, folder), "started_at", "run_id", 50)


@query("pipeline_run_history", with_ctes([RUNS], "SELECT * FROM runs WHERE source = '1-URGENT'"))
def _(spark, folder):
    return runs.of_pipeline(adapters.runs(spark, folder), "source", "1-URGENT", "started_at", "run_id")


@query("run_listing", with_ctes([RUNS], "SELECT * FROM runs"))
def _(spark, folder):
    return runs.newest(adapters.runs(spark, folder), "started_at", "run_id")


@query("customer_page", with_ctes([CUSTOMERS], "SELECT customer_id, customer_number, status FROM customers ORDER BY customer_id LIMIT 50 OFFSET 50"))
def _(spark, folder):
    return runs.page(adapters.customers(spark, folder).select("customer_id", "customer_number", "status"), "customer_id", 50, 50)


@query("customer_lookup", with_ctes([CUSTOMERS], "SELECT customer_id, customer_number, status FROM customers WHERE customer_number = 'Customer#000000007'"))
def _(spark, folder):
    rows = adapters.customers(spark, folder).select("customer_id", "customer_number", "status")
    return runs.lookup(rows, "customer_number", "Customer#000000007")


@query(
    "pending_issues",
    with_ctes(FLAG_CHAIN, "SELECT reading_no, 'PENDING' AS status, received_at AS created_at FROM flagged WHERE NOT is_good AND stdor_to_u IS NOT NULL ORDER BY received_at DESC, reading_no LIMIT 100"),
)
def _(spark, folder):
    status = F.when(F.col("stdor_to_u").isNotNull(), dlq.PENDING).otherwise("RESOLVED")
    issues = flagged(spark, folder).filter(~F.col("is_good")).select("reading_no", status.alias("status"), F.col("received_at").alias("created_at"))
    return dlq.pending(issues, "created_at", "reading_no", 100)


@query(
    "dashboard_summary",
    with_ctes([RUNS, *FLAG_CHAIN, DAY_SCORES], """SELECT sum(rows_received)::BIGINT AS records_processed,
        count(*) FILTER (WHERE status = 'FAILED') AS failed_runs, count(DISTINCT source) AS active_sources,
        (SELECT count(*) FROM flagged WHERE NOT is_good) AS dlq_count,
        (SELECT CAST(round(CAST(CAST(sum(CAST(overall_score AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS DECIMAL(18,6)), 1) AS DOUBLE) FROM quality_runs) AS quality_score
      FROM runs"""),
)
def _(spark, folder):
    bad = flagged(spark, folder).filter(~F.col("is_good"))
    return runs.dashboard(adapters.runs(spark, folder), bad, quality_runs(spark, folder), "rows_received", "source")


@query(
    "stage_summary",
    with_ctes([RUN_EVENTS, RUNS, *GOLD_CHAIN], """SELECT 'Raw' AS stage, count(*) AS runs, sum(rows_received)::BIGINT AS rows, max(started_at) AS last_run,
        CAST(NULL AS BIGINT) AS rejected, CAST(NULL AS BIGINT) AS dlq, 'PASS' AS stage_status FROM runs
      UNION ALL SELECT 'Standardized', count(DISTINCT run_id), sum(n)::BIGINT, max(d), NULL, NULL, 'PASS'
        FROM (SELECT CAST(received_at AS DATE) AS run_id, count(*) AS n, max(received_at) AS d FROM readings GROUP BY 1)
      UNION ALL SELECT 'Gold', NULL, count(*), NULL, (SELECT count(*) FROM readings) - count(*), (SELECT count(*) FROM flagged WHERE NOT is_good), 'PASS' FROM gold"""),
)
def _(spark, folder):
    standardized = adapters.readings(spark, folder).groupBy(F.col("received_at").cast("date").alias("run_id")).agg(
        F.count("*").alias("rows_received"), F.max("received_at").alias("started_at")
    )
    bad = flagged(spark, folder).filter(~F.col("is_good"))
    return runs.stage_summary(adapters.runs(spark, folder), standardized, gold(spark, folder), bad, "rows_received", "started_at")


# --- extracts and backfills ---------------------------------------------------------------


@query("full_extract", "SELECT * FROM customer")
def _(spark, folder):
    return extracts.incremental(adapters.table(spark, folder, "customer"), "c_custkey", None)


@query("incremental_extract", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def _(spark, folder):
    return extracts.incremental(adapters.table(spark, folder, "orders"), "o_orderdate", "1998-01-01 00:00:00")


@query("incremental_extract_inclusive", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def _(spark, folder):
    return extracts.incremental(adapters.table(spark, folder, "orders"), "o_orderdate", "1998-01-01 00:00:00", inclusive=True)


@query("watermarks", """SELECT event_type AS dataset, max(ts) AS watermark_end, count(*) AS rows_extracted FROM events GROUP BY 1""")
def _(spark, folder):
    return adapters.table(spark, folder, "events").groupBy(F.col("event_type").alias("dataset")).agg(
        F.max("ts").alias("watermark_end"), F.count("*").alias("rows_extracted")
    )


@query(
    "backfill_range",
    with_ctes([BILLS], """SELECT bill_id, bill_date, bill_status, 'bf-1996' AS _metadata_run_id, true AS _metadata_is_backfill
      FROM bills WHERE bill_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""),
)
def _(spark, folder):
    bills = adapters.bills(spark, folder).select("bill_id", "bill_date", "bill_status")
    return pipelines.tag_backfill(bills, "bf-1996", "bill_date", "1996-01-01", "1996-12-31")


@query(
    "source_target_counts",
    with_ctes([READINGS, FLAGGED], """SELECT CAST(received_at AS DATE) AS bucket, count(*) AS source_rows, count(*) FILTER (WHERE is_good) AS target_rows,
      count(*) = count(*) FILTER (WHERE is_good) AS keys_match FROM flagged GROUP BY 1"""),
)
def _(spark, folder):
    rows = flagged(spark, folder)
    day = F.col("received_at").cast("date")
    return reconcile.compare(rows, rows.filter("is_good"), "reading_no", day, day)


@query(
    "differing_keys",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 97 = 0 THEN 'missing' ELSE 'changed' END AS state FROM orders
         WHERE o_orderkey % 97 = 0 OR (o_orderkey % 89 = 0 AND o_totalprice <> 0)
       UNION ALL SELECT -1 - o_orderkey, 'surplus' FROM orders WHERE o_orderkey % 83 = 0""",
)
def _(spark, folder):
    """The orders that a copy lacks, has beyond them, or has with another price."""
    orders = adapters.table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))
    other = F.when(F.col("order_id") % 89 == 0, F.lit(0.0)).otherwise(F.col("price"))
    copy = orders.filter("order_id % 97 != 0").select("order_id", other.cast(orders.schema["price"].dataType).alias("price"))
    beyond = orders.filter("order_id % 83 = 0").select((-1 - F.col("order_id")).alias("order_id"), "price")
    return differences.between(orders, copy.union(beyond), ["order_id"], ["price"])
