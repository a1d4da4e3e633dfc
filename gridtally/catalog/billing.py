"""Reconciliation and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally.catalog.base_sql import (
    ACCOUNTS, BILLS, CONTRACTS, CUSTOMERS, FLAGGED, METERS, OPS_READINGS, OWNED_PAYMENTS, PAYMENTS, READINGS, SERVICE_POINTS,
)
from gridtally.catalog.readings import flagged
from gridtally.catalog.registry import query, with_ctes
from gridtally.functions import keys, numbers, times
from gridtally.operators import ranges, reconcile, runs
from gridtally.plans import marts, warehouse
from gridtally.sources import adapters


def star(spark, folder):
    bills = adapters.bills(spark, folder).drop("customer_id")
    return warehouse.billing_star(
        bills, adapters.accounts(spark, folder), adapters.customers(spark, folder), adapters.contracts(spark, folder)
    )


STAR = """star AS (SELECT b.*, c.customer_type, k.commodity_type FROM (SELECT * EXCLUDE (customer_id) FROM bills) b
  JOIN accounts a ON a.account_id = b.account_id JOIN customers c ON c.customer_id = a.customer_id
  JOIN contracts k ON k.contract_id = b.contract_id)"""
STAR_CHAIN = [BILLS, ACCOUNTS, CUSTOMERS, CONTRACTS, STAR]


@query(
    "monthly_revenue",
    with_ctes(STAR_CHAIN, """SELECT CAST(date_trunc('month', bill_date) AS DATE) AS billing_month, customer_type, commodity_type,
      sum(total_amount)::DOUBLE AS total_revenue, count(DISTINCT bill_id) AS total_bills_issued FROM star
      WHERE bill_status <> 'CANCELLED' GROUP BY 1, 2, 3"""),
)
def _(spark, folder):
    return marts.monthly_revenue(star(spark, folder))


@query("star_join", with_ctes(STAR_CHAIN, "SELECT bill_id, account_id, customer_type, commodity_type FROM star"))
def _(spark, folder):
    return star(spark, folder).select("bill_id", "account_id", "customer_type", "commodity_type")


@query("calendar_join", with_ctes([BILLS], """SELECT bill_id, year(bill_date) AS year, quarter(bill_date) AS quarter,
  dayofweek(bill_date) IN (0, 6) AS is_weekend FROM bills"""))
def _(spark, folder):
    bills = adapters.bills(spark, folder).select("bill_id", keys.date_key(F.col("bill_date")).alias("date_sk"), "bill_date")
    calendar = warehouse.dim_date(bills, "bill_date").select("date_sk", "year", "quarter", "is_weekend")
    return bills.join(calendar, "date_sk").select("bill_id", "year", "quarter", "is_weekend")


SITED = """sited AS (SELECT r.meter_id, k.account_id, r.reading_timestamp, r.reading_value FROM ops_readings r
  JOIN meters m ON m.meter_id = r.meter_id JOIN service_points s ON s.service_point_id = m.service_point_id
  JOIN contracts k ON k.contract_id = s.contract_id)"""
SITE_CHAIN = [OPS_READINGS, METERS, SERVICE_POINTS, CONTRACTS, SITED]


def daily_site_usage(spark, folder):
    """Usage per meter, account and day. Readings are summed per meter and day
    before they meet the dimensions."""
    daily = adapters.ops_readings(spark, folder).groupBy("meter_id", F.col("reading_timestamp").cast("date").alias("day")).agg(
        F.sum(numbers.exact(F.col("reading_value"))).alias("usage")
    )
    site = (
        adapters.meters(spark, folder).select("meter_id", "service_point_id")
        .join(adapters.service_points(spark, folder).select("service_point_id", "contract_id"), "service_point_id")
        .join(adapters.contracts(spark, folder).select("contract_id", "account_id"), "contract_id")
    )
    return daily.join(site, "meter_id")


@query(
    "monthly_consumption",
    with_ctes(SITE_CHAIN, """SELECT account_id, year(reading_timestamp)::INTEGER AS year, month(reading_timestamp)::INTEGER AS month,
      sum(CAST(reading_value AS DECIMAL(18,4)))::DOUBLE AS metered FROM sited GROUP BY 1, 2, 3"""),
)
def _(spark, folder):
    out = reconcile.monthly_consumption(daily_site_usage(spark, folder), "account_id", "day", "usage")
    return out.withColumn("metered", F.col("metered").cast("double"))


def zeroed_bills(spark, folder):
    """Bills with the smallest amounts set to nothing, so that zero bills exist."""
    amount = F.when(F.col("total_amount") < 50000, F.lit(0).cast("decimal(12,4)")).otherwise(F.col("total_amount"))
    return adapters.bills(spark, folder).withColumn("total_amount", amount)


BILLING = """billing AS (SELECT account_id, year(bill_date)::INTEGER AS year, month(bill_date)::INTEGER AS month,
  sum(CASE WHEN total_amount < 50000 THEN 0 ELSE total_amount END) AS billed, count(*) AS bill_count
  FROM bills WHERE bill_status IN ('ISSUED', 'PAID') GROUP BY 1, 2, 3)"""
CONSUMED = """consumed AS (SELECT account_id, year(reading_timestamp)::INTEGER AS year, month(reading_timestamp)::INTEGER AS month,
  sum(CAST(reading_value AS DECIMAL(18,4))) AS metered FROM sited GROUP BY 1, 2, 3)"""


@query("monthly_billing", with_ctes([BILLS, BILLING], "SELECT account_id, year, month, billed::DOUBLE AS billed, bill_count FROM billing"))
def _(spark, folder):
    out = reconcile.monthly_billing(zeroed_bills(spark, folder), "account_id", "bill_date", "total_amount", "bill_status", "bill_id")
    return out.withColumn("billed", F.col("billed").cast("double"))


@query(
    "recon_meter_to_bill",
    with_ctes([*SITE_CHAIN, BILLS, BILLING, CONSUMED], """SELECT c.account_id, c.year, c.month, c.metered::DOUBLE AS metered, b.billed::DOUBLE AS billed,
        b.bill_count, CASE WHEN b.account_id IS NULL THEN 'NO_BILL_ISSUED' ELSE 'ZERO_BILL_WITH_CONSUMPTION' END AS reconciliation_status
      FROM consumed c LEFT JOIN billing b ON b.account_id = c.account_id AND b.year = c.year AND b.month = c.month
      WHERE b.account_id IS NULL OR (b.billed <= 0 AND c.metered > 0)"""),
)
def _(spark, folder):
    consumption = reconcile.monthly_consumption(daily_site_usage(spark, folder), "account_id", "day", "usage")
    billing = reconcile.monthly_billing(zeroed_bills(spark, folder), "account_id", "bill_date", "total_amount", "bill_status", "bill_id")
    out = reconcile.metered_against_billed(consumption, billing, "account_id")
    out = out.orderBy(F.desc("year"), F.desc("month"), F.desc("metered"), F.asc("account_id"))
    return out.withColumns({"metered": F.col("metered").cast("double"), "billed": F.col("billed").cast("double")})


@query(
    "recon_variance",
    with_ctes([*SITE_CHAIN, BILLS], """SELECT b.bill_id, b.account_id, b.total_amount::DOUBLE AS billed_usage,
        sum(CAST(s.reading_value AS DECIMAL(18,4)))::DOUBLE AS metered,
        (b.total_amount - sum(CAST(s.reading_value AS DECIMAL(18,4))))::DOUBLE AS variance
      FROM bills b JOIN sited s ON s.account_id = b.account_id AND s.reading_timestamp >= CAST(b.period_start AS TIMESTAMP)
        AND s.reading_timestamp < CAST(b.period_end AS TIMESTAMP) + INTERVAL 1 DAY GROUP BY b.bill_id, b.account_id, b.total_amount"""),
)
def _(spark, folder):
    daily = daily_site_usage(spark, folder).groupBy("account_id", "day").agg(F.sum("usage").alias("usage"))
    bills = adapters.bills(spark, folder).select("bill_id", "account_id", "period_start", "period_end", F.col("total_amount").alias("billed_usage"))
    out = reconcile.billed_variance(bills, daily, "account_id", "period_start", "period_end", "billed_usage")
    return out.select("bill_id", "account_id", *[F.col(c).cast("double").alias(c) for c in ("billed_usage", "metered", "variance")])


@query(
    "usage_in_periods",
    """WITH p AS (SELECT DISTINCT o_custkey AS site, CAST(date_trunc('month', o_orderdate) AS DATE) AS start_day,
         CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS end_day FROM orders)
       SELECT site, start_day, end_day, sum(CAST(l_quantity AS DECIMAL(18,4)))::DOUBLE AS total FROM p
       JOIN lineitem ON l_partkey = site AND CAST(l_shipdate AS DATE) BETWEEN start_day AND end_day GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    orders, line = adapters.table(spark, folder, "orders"), adapters.table(spark, folder, "lineitem")
    periods = orders.select(
        F.col("o_custkey").alias("site"), times.month_start(F.col("o_orderdate")).alias("start_day"), F.last_day("o_orderdate").alias("end_day")
    )
    daily = line.groupBy(F.col("l_partkey").alias("site"), F.col("l_shipdate").cast("date").alias("day")).agg(
        F.sum(numbers.exact(F.col("l_quantity"))).alias("usage")
    )
    out = ranges.usage_in_periods(periods, daily, ["site"], "start_day", "end_day", "usage", "total")
    return out.withColumn("total", F.col("total").cast("double"))


MONTHLY = """SELECT coalesce(b.account_id, p.account_id) AS account_id, coalesce(b.month, p.month) AS month,
    coalesce(b.billed, 0)::DOUBLE AS total_billed, coalesce(p.paid, 0)::DOUBLE AS total_collected,
    CASE WHEN b.billed > 0 THEN coalesce(p.paid, 0)::DOUBLE / b.billed::DOUBLE END AS collection_rate,
    coalesce(b.n, 0) AS bill_count, coalesce(p.n, 0) AS payment_count
  FROM (SELECT account_id, CAST(date_trunc('month', bill_date) AS DATE) AS month, sum(total_amount) AS billed, count(*) AS n FROM bills GROUP BY 1, 2) b
  FULL OUTER JOIN (SELECT account_id, CAST(date_trunc('month', payment_date) AS DATE) AS month, sum(amount) AS paid, count(*) AS n
    FROM owned_payments WHERE payment_status = 'CLEARED' GROUP BY 1, 2) p ON p.account_id = b.account_id AND p.month = b.month"""


@query("mart_revenue_monthly", with_ctes([BILLS, PAYMENTS, OWNED_PAYMENTS], MONTHLY))
def _(spark, folder):
    return marts.revenue_monthly(adapters.bills(spark, folder), adapters.payments_with_owner(spark, folder))


@query(
    "mart_payment_lag",
    with_ctes([BILLS, PAYMENTS], """SELECT b.bill_id, b.account_id, b.bill_date, b.due_date, p.first_payment_date, p.settled_date,
        date_diff('day', b.bill_date, p.first_payment_date) AS days_to_first_payment, date_diff('day', b.bill_date, p.settled_date) AS days_to_settlement,
        p.first_payment_date > b.due_date AS is_overdue
      FROM bills b LEFT JOIN (SELECT bill_id, CAST(min(payment_date) AS DATE) AS first_payment_date, CAST(min(settled_at) AS DATE) AS settled_date
        FROM payments GROUP BY 1) p ON p.bill_id = b.bill_id"""),
)
def _(spark, folder):
    return marts.payment_lag(adapters.bills(spark, folder), adapters.payments(spark, folder))


@query(
    "mart_unbilled_readings",
    with_ctes([*SITE_CHAIN, BILLS], """SELECT s.account_id, CAST(s.reading_timestamp AS DATE) AS read_date, count(*) AS reading_count,
        sum(CAST(s.reading_value AS DECIMAL(18,4)))::DOUBLE AS total_kwh,
        bool_or(EXISTS (SELECT 1 FROM bills b WHERE b.account_id = s.account_id
          AND CAST(s.reading_timestamp AS DATE) BETWEEN b.period_start AND b.period_end)) AS is_billed
      FROM sited s GROUP BY 1, 2"""),
)
def _(spark, folder):
    site = (
        adapters.meters(spark, folder).select("meter_id", "service_point_id")
        .join(adapters.service_points(spark, folder).select("service_point_id", "contract_id"), "service_point_id")
        .join(adapters.contracts(spark, folder).select("contract_id", "account_id"), "contract_id")
        .select("meter_id", "account_id")
    )
    readings = adapters.ops_readings(spark, folder).select("meter_id", "reading_timestamp", "reading_value")
    bills = adapters.bills(spark, folder)
    return marts.unbilled_readings(readings, bills, "account_id", "reading_timestamp", "reading_value", owners=site, key="meter_id")


@query(
    "mart_churn_signals",
    with_ctes([BILLS, PAYMENTS, OWNED_PAYMENTS, ACCOUNTS, CONTRACTS], """SELECT customer_id, month, sum(f)::BIGINT AS payment_failures,
        sum(d)::BIGINT AS disputes, sum(s)::BIGINT AS suspensions FROM (
        SELECT customer_id, CAST(date_trunc('month', payment_date) AS DATE) AS month, 1 AS f, 0 AS d, 0 AS s FROM owned_payments WHERE payment_status = 'FAILED'
        UNION ALL SELECT customer_id, CAST(date_trunc('month', bill_date) AS DATE), 0, 1, 0 FROM bills WHERE bill_status = 'DISPUTED'
        UNION ALL SELECT a.customer_id, CAST(date_trunc('month', c.end_date) AS DATE), 0, 0, 1 FROM accounts a JOIN contracts c ON c.account_id = a.account_id
          WHERE a.account_status = 'SUSPENDED') GROUP BY 1, 2"""),
)
def _(spark, folder):
    payments = adapters.payments_with_owner(spark, folder).withColumn("month", times.month_start(F.col("payment_date")))
    bills = adapters.bills(spark, folder).withColumn("month", times.month_start(F.col("bill_date")))
    ended = adapters.contracts(spark, folder).select("account_id", times.month_start(F.col("end_date")).alias("month"))
    suspended = adapters.accounts(spark, folder).filter("account_status = 'SUSPENDED'").join(ended, "account_id")
    return marts.churn_signals(payments, bills, suspended)


def pipeline_runs(spark, folder):
    """Quality results per tariff and hour, as a run log of three pipelines."""
    return flagged(spark, folder).groupBy(
        F.coalesce("stdor_to_u", F.lit("none")).alias("pipeline_name"),
        F.col("received_at").cast("date").alias("run_date"),
        F.hour("received_at").alias("run_hour"),
    ).agg(
        F.count("*").alias("rows_read"),
        F.count_if("is_good").alias("rows_written"),
        F.count_if(~F.col("is_good")).alias("rows_dlq"),
        (F.count("*") / 2).alias("duration_seconds"),
        F.when(F.count_if("is_good") == 0, "FAILED").otherwise("SUCCESS").alias("status"),
    )


RUN_LOG = """run_log AS (SELECT coalesce(stdor_to_u, 'none') AS pipeline_name, CAST(received_at AS DATE) AS run_date, hour(received_at) AS run_hour,
  count(*) AS rows_read, count(*) FILTER (WHERE is_good) AS rows_written, count(*) FILTER (WHERE NOT is_good) AS rows_dlq,
  count(*) / 2.0 AS duration_seconds, CASE WHEN count(*) FILTER (WHERE is_good) = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM flagged GROUP BY 1, 2, 3)"""


@query(
    "mart_pipeline_health",
    with_ctes([READINGS, FLAGGED, RUN_LOG], """SELECT pipeline_name, run_date, sum(rows_read)::BIGINT AS rows_read, sum(rows_written)::BIGINT AS rows_written,
        sum(rows_dlq)::BIGINT AS rows_dlq, sum(rows_dlq)::DOUBLE / sum(rows_read)::DOUBLE AS dlq_rate, sum(duration_seconds)::DOUBLE AS duration_seconds,
        CASE WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'FAILED' WHEN sum(rows_dlq) > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
      FROM run_log GROUP BY 1, 2"""),
)
def _(spark, folder):
    return marts.pipeline_health(pipeline_runs(spark, folder))


@query(
    "volume_alert",
    """WITH d AS (SELECT event_type AS pipeline_name, CAST(ts AS DATE) AS run_date, count(*) AS records FROM events GROUP BY 1, 2),
       t AS (SELECT *, avg(records) OVER (PARTITION BY pipeline_name ORDER BY run_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS trailing_average FROM d)
       SELECT pipeline_name, run_date, records, trailing_average FROM t WHERE records < 0.8 * trailing_average""",
)
def _(spark, folder):
    events = adapters.table(spark, folder, "events").select(
        F.col("event_type").alias("pipeline_name"), F.col("ts").cast("date").alias("run_date"), F.lit(1).alias("n")
    )
    return runs.volume_alerts(events, "pipeline_name", "run_date", "n")
