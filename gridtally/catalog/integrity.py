"""Relations between the operational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally.catalog.base_sql import (
    ACCOUNTS, BILLS, CONTRACTS, CUSTOMERS, METERS, OPS_READINGS, OWNED_PAYMENTS, PAYMENTS, READINGS, SERVICE_POINTS,
)
from gridtally.catalog.quality import ODD_BILLS, odd_bills
from gridtally.catalog.registry import query, with_ctes
from gridtally.operators import dedup, integrity, ordered, rules
from gridtally.sources import adapters

# The sample's references are complete by construction. Some are broken here by value, so
# that checks against whole parents have something to find.


def broken_bills(spark, folder):
    """Cancelled bills name an unknown account, disputed ones none."""
    status = F.col("bill_status")
    account = F.when(status == "CANCELLED", "ACC-unknown").when(status != "DISPUTED", F.col("account_id"))
    return adapters.bills(spark, folder).select("bill_id", account.alias("account_id"))


BROKEN_BILLS = """broken_bills AS (SELECT bill_id, CASE bill_status WHEN 'CANCELLED' THEN 'ACC-unknown' WHEN 'DISPUTED' THEN NULL ELSE account_id END AS account_id
  FROM bills)"""


@query(
    "fk_orphan_bills",
    with_ctes([ACCOUNTS, BILLS, BROKEN_BILLS], """SELECT b.bill_id, b.account_id FROM broken_bills b
      LEFT JOIN accounts a ON a.account_id = b.account_id WHERE a.account_id IS NULL"""),
)
def _(spark, folder):
    return integrity.orphans(broken_bills(spark, folder), adapters.accounts(spark, folder), "account_id", "account_id")


@query(
    "fk_orphan_accounts",
    with_ctes([ACCOUNTS, CUSTOMERS], """SELECT account_id, customer_id FROM (
        SELECT account_id, CASE WHEN account_status = 'SUSPENDED' THEN 'unknown' ELSE customer_id END AS customer_id FROM accounts) a
      WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = a.customer_id)"""),
)
def _(spark, folder):
    customer = F.when(F.col("account_status") == "SUSPENDED", "unknown").otherwise(F.col("customer_id"))
    accounts = adapters.accounts(spark, folder).select("account_id", customer.alias("customer_id"))
    return integrity.orphans(accounts, adapters.customers(spark, folder), "customer_id", "customer_id")


@query(
    "fk_orphan_readings",
    with_ctes([OPS_READINGS, METERS], """SELECT r.reading_id, r.meter_id FROM (
        SELECT reading_id, CASE WHEN reading_type = 'INTERVAL' THEN meter_id ELSE 'unknown' END AS meter_id FROM ops_readings) r
      LEFT JOIN meters m ON m.meter_id = r.meter_id WHERE m.meter_id IS NULL"""),
)
def _(spark, folder):
    meter = F.when(F.col("reading_type") == "INTERVAL", F.col("meter_id")).otherwise("unknown")
    rows = adapters.ops_readings(spark, folder).select("reading_id", meter.alias("meter_id"))
    return integrity.orphans(rows, adapters.meters(spark, folder), "meter_id", "meter_id")


# The foreign keys of the operational tables (child, key, parent).
FOREIGN_KEYS = [
    ("accounts", "customer_id", "customers"),
    ("contracts", "account_id", "accounts"),
    ("service_points", "contract_id", "contracts"),
    ("meters", "service_point_id", "service_points"),
    ("meter_readings", "meter_id", "meters"),
    ("bills", "account_id", "accounts"),
    ("bills", "contract_id", "contracts"),
    ("payments", "bill_id", "bills"),
    ("payments", "account_id", "accounts"),
    ("premises", "account_id", "accounts"),
    ("contracts", "premise_id", "premises"),
    ("service_points", "premise_id", "premises"),
]
PREMISES = """premises AS (SELECT 'PR-' || c_custkey AS premise_id, 'ACC-' || c_custkey AS account_id FROM customer)"""
PREMISED_CONTRACTS = "contracts_p AS (SELECT *, CASE WHEN contract_status = 'EXPIRED' THEN 'PR-unknown' ELSE replace(contract_id, 'CTR', 'PR') END AS premise_id FROM contracts)"
PREMISED_POINTS = "service_points_p AS (SELECT *, replace(contract_id, 'CTR', 'PR') AS premise_id FROM service_points)"
_SQL_NAME = {"meter_readings": "ops_readings", "payments": "owned_payments", "contracts": "contracts_p", "service_points": "service_points_p"}


def operational_tables(spark, folder):
    premises = adapters.table(spark, folder, "customer").select(
        F.concat(F.lit("PR-"), F.col("c_custkey").cast("string")).alias("premise_id"),
        F.concat(F.lit("ACC-"), F.col("c_custkey").cast("string")).alias("account_id"),
    )
    at_premise = F.replace(F.col("contract_id"), F.lit("CTR"), F.lit("PR"))
    return {
        "customers": adapters.customers(spark, folder),
        "accounts": adapters.accounts(spark, folder),
        "premises": premises,
        "contracts": adapters.contracts(spark, folder).withColumn(
            "premise_id", F.when(F.col("contract_status") == "EXPIRED", "PR-unknown").otherwise(at_premise)
        ),
        "service_points": adapters.service_points(spark, folder).withColumn("premise_id", at_premise),
        "meters": adapters.meters(spark, folder),
        "meter_readings": adapters.ops_readings(spark, folder),
        "bills": adapters.bills(spark, folder),
        "payments": adapters.payments_with_owner(spark, folder),
    }


def _fk_sql(child: str, key: str, parent: str) -> str:
    c, p = _SQL_NAME.get(child, child), _SQL_NAME.get(parent, parent)
    # The account of a payment is known through its bill; the bill itself is not.
    c = "payments" if (child, key) == ("payments", "bill_id") else c
    return (
        f"SELECT '{child}.{key}' AS table_name, count(*) AS orphan_records FROM {c} x "
        f"WHERE NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{key} = x.{key})"
    )


ALL_TABLES = [
    CUSTOMERS, ACCOUNTS, CONTRACTS, SERVICE_POINTS, METERS, OPS_READINGS, BILLS, PAYMENTS, OWNED_PAYMENTS, PREMISES,
    PREMISED_CONTRACTS, PREMISED_POINTS,
]


@query("fk_orphan_counts", with_ctes(ALL_TABLES, "\nUNION ALL\n".join(_fk_sql(*fk) for fk in FOREIGN_KEYS)))
def _(spark, folder):
    tables = operational_tables(spark, folder)
    payments = adapters.payments(spark, folder)
    child = lambda name, key: payments if (name, key) == ("payments", "bill_id") else tables[name]
    return integrity.orphan_counts(
        [integrity.Reference(child(name, key), key, tables[parent], key, f"{name}.{key}") for name, key, parent in FOREIGN_KEYS]
    )


@query(
    "cross_reference_rule",
    with_ctes([BILLS, ACCOUNTS, BROKEN_BILLS], """SELECT bill_id, account_id,
      'Invalid foreign-key relationship: Account does not exist in warehouse' AS errors FROM broken_bills b
      WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account_id = b.account_id)"""),
)
def _(spark, folder):
    bad = integrity.orphans(broken_bills(spark, folder), adapters.accounts(spark, folder), "account_id", "account_id")
    message = "Invalid foreign-key relationship: Account does not exist in warehouse"
    return bad.withColumn("errors", F.lit(message))


UNIQUE_KEYS = {
    "customers": ("customer_number", "customers"),
    "accounts": ("account_number", "accounts"),
    "meters": ("meter_serial_number", "meters"),
    "bills": ("bill_id", "bills"),
    "payments": ("payment_id", "payments"),
    "service_points": ("contract_id", "service_points"),
    "meters_per_point": ("service_point_id", "meters"),
}


@query(
    "unique_key_violations",
    with_ctes(ALL_TABLES, "\nUNION ALL\n".join(
        f"SELECT '{label}' AS check_name, count(*) AS repeated_keys, coalesce(sum(n), 0)::BIGINT AS rows_involved FROM "
        f"(SELECT {key}, count(*) AS n FROM {table} GROUP BY 1 HAVING count(*) > 1)"
        for label, (key, table) in UNIQUE_KEYS.items()
    )),
)
def _(spark, folder):
    tables = operational_tables(spark, folder) | {"payments": adapters.payments(spark, folder)}
    out = None
    for label, (key, table) in UNIQUE_KEYS.items():
        repeated = dedup.repeated_keys(tables[table], [key], "n").agg(
            F.lit(label).alias("check_name"),
            F.count("*").alias("repeated_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_involved"),
        )
        out = repeated if out is None else out.unionByName(repeated)
    return out


@query("dup_reading_keys", with_ctes([OPS_READINGS], "SELECT reading_id, count(*) AS record_count FROM ops_readings GROUP BY 1 HAVING count(*) > 1"))
def _(spark, folder):
    return dedup.repeated_keys(adapters.ops_readings(spark, folder), ["reading_id"])


@query("dup_meter_slots", with_ctes([READINGS], """SELECT meter_id, event_timestamp, count(*) AS record_count FROM readings
  GROUP BY 1, 2 HAVING count(*) > 1"""))
def _(spark, folder):
    return dedup.repeated_keys(adapters.readings(spark, folder), ["meter_id", "event_timestamp"])


@query(
    "surplus_copies",
    """WITH twice AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'error')
       SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS duplicates FROM twice""",
)
def _(spark, folder):
    """Whole rows; the error events were delivered twice."""
    events = adapters.table(spark, folder, "events")
    return dedup.surplus_copies(events.unionByName(events.filter("event_type = 'error'")))


@query(
    "commodity_mismatch_contract",
    with_ctes([SERVICE_POINTS, CONTRACTS], """SELECT s.service_point_id, s.contract_id, s.commodity_type, c.commodity_type AS related_value
      FROM service_points s JOIN contracts c ON c.contract_id = s.contract_id WHERE s.commodity_type <> c.commodity_type"""),
)
def _(spark, folder):
    points = adapters.service_points(spark, folder).select("service_point_id", "contract_id", "commodity_type")
    return integrity.mismatches(points, adapters.contracts(spark, folder), "contract_id", "commodity_type", "commodity_type")


@query(
    "commodity_mismatch_meter",
    with_ctes([SERVICE_POINTS, METERS], """SELECT m.meter_id, m.service_point_id, m.commodity_type, s.commodity_type AS related_value
      FROM meters m JOIN service_points s ON s.service_point_id = m.service_point_id WHERE s.commodity_type <> m.commodity_type"""),
)
def _(spark, folder):
    meters = adapters.meters(spark, folder).select("meter_id", "service_point_id", "commodity_type")
    return integrity.mismatches(meters, adapters.service_points(spark, folder), "service_point_id", "commodity_type", "commodity_type")


@query(
    "bill_contract_account_mismatch",
    with_ctes([BILLS, CONTRACTS], """SELECT b.bill_id, b.contract_id, 'ACC-' || substr(b.bill_id, 3) AS account_id, c.account_id AS related_value
      FROM bills b JOIN contracts c ON c.contract_id = b.contract_id WHERE 'ACC-' || substr(b.bill_id, 3) <> c.account_id"""),
)
def _(spark, folder):
    """Bills are given the account of their own number, so most disagree with their contract."""
    bills = adapters.bills(spark, folder).select(
        "bill_id", "contract_id", F.concat(F.lit("ACC-"), F.expr("substring(bill_id, 3)")).alias("account_id")
    )
    return integrity.mismatches(bills, adapters.contracts(spark, folder), "contract_id", "account_id", "account_id")


@query(
    "payment_account_mismatch",
    with_ctes([BILLS, PAYMENTS], """SELECT p.payment_id, p.bill_id, 'ACC-' || substr(p.bill_id, 3) AS account_id, b.account_id AS related_value
      FROM payments p JOIN bills b ON b.bill_id = p.bill_id WHERE 'ACC-' || substr(p.bill_id, 3) <> b.account_id"""),
)
def _(spark, folder):
    payments = adapters.payments(spark, folder).select(
        "payment_id", "bill_id", F.concat(F.lit("ACC-"), F.expr("substring(bill_id, 3)")).alias("account_id")
    )
    return integrity.mismatches(payments, adapters.bills(spark, folder), "bill_id", "account_id", "account_id")


@query(
    "readings_before_installation",
    with_ctes([OPS_READINGS, METERS], """SELECT r.reading_id, r.meter_id, r.reading_timestamp, CAST(m.installation_date AS TIMESTAMP) AS owner_start
      FROM ops_readings r JOIN meters m ON m.meter_id = r.meter_id WHERE r.reading_timestamp < CAST(m.installation_date AS TIMESTAMP)"""),
)
def _(spark, folder):
    rows = adapters.ops_readings(spark, folder).select("reading_id", "meter_id", "reading_timestamp")
    return integrity.before_start(rows, adapters.meters(spark, folder), "meter_id", "reading_timestamp", "installation_date")


@query(
    "interval_readings_exist",
    with_ctes([OPS_READINGS, METERS], """SELECT count(*) AS matching_rows, count(*) > 0 AS has_rows
      FROM ops_readings r JOIN meters m ON m.meter_id = r.meter_id
      WHERE m.meter_type = 'AMI' AND m.commodity_type = 'ELECTRICITY' AND m.status = 'ACTIVE' AND r.reading_type = 'INTERVAL'"""),
)
def _(spark, folder):
    smart = adapters.meters(spark, folder).filter("meter_type = 'AMI' and commodity_type = 'ELECTRICITY' and status = 'ACTIVE'")
    return integrity.matching_rows(adapters.ops_readings(spark, folder), smart, "meter_id", F.col("reading_type") == "INTERVAL")


# How many rows tables must have relative to each other.
COUNT_RULES = [
    ("enough_customers", "customers >= 1000"),
    ("accounts_per_customer", "accounts >= customers"),
    ("premises_per_account", "premises >= accounts"),
    ("contracts_per_account", "contracts >= accounts"),
    ("point_per_contract", "service_points = contracts"),
    ("meter_per_point", "meters = service_points"),
    ("enough_readings", "meter_readings >= 1000"),
    ("bills_per_contract", "bills >= contracts"),
    ("half_of_bills_paid", "payments >= bills div 2"),
]


def _count_rule_sql() -> str:
    names = ["customers", "accounts", "premises", "contracts", "service_points", "meters", "bills", "payments"]
    counts = ", ".join(f"(SELECT count(*) FROM {n}) AS {n}" for n in names)
    parts = [f"SELECT '{name}' AS rule_name, {text.replace(' div ', ' // ')} AS passed FROM c" for name, text in COUNT_RULES]
    head = f"c AS (SELECT {counts}, (SELECT count(*) FROM ops_readings) AS meter_readings)"
    return with_ctes([*ALL_TABLES, head], "\nUNION ALL\n".join(parts))


@query("cardinality_rules", _count_rule_sql())
def _(spark, folder):
    tables = operational_tables(spark, folder) | {"payments": adapters.payments(spark, folder)}
    return integrity.count_rules(integrity.table_counts(tables), COUNT_RULES)


@query(
    "table_counts",
    with_ctes(ALL_TABLES, "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {s}"
        for n, s in [("customers", "customers"), ("accounts", "accounts"), ("contracts", "contracts"), ("meters", "meters"), ("bills", "bills")]
    )),
)
def _(spark, folder):
    tables = operational_tables(spark, folder)
    return integrity.table_counts({n: tables[n] for n in ("customers", "accounts", "contracts", "meters", "bills")})


@query(
    "sequence_gaps",
    """SELECT n + 1 AS gap_start, nxt - 1 AS gap_end, nxt - n - 1 AS missing FROM (
         SELECT n, lead(n) OVER (ORDER BY n) AS nxt FROM (SELECT DISTINCT event_id + CASE WHEN event_type = 'error' THEN 1000000000000 ELSE 0 END AS n FROM events))
       WHERE nxt > n + 1""",
)
def _(spark, folder):
    """Error events get numbers far off, which leaves gaps and strays."""
    stray = F.when(F.col("event_type") == "error", 1_000_000_000_000).otherwise(0)
    events = adapters.table(spark, folder, "events").select((F.col("event_id") + stray).alias("event_id"))
    return ordered.sequence_gaps(events, "event_id")


@query(
    "rules_bills",
    with_ctes([BILLS, ODD_BILLS], """SELECT bill_id, total_amount::DOUBLE AS total_amount, concat_ws('; ',
      CASE WHEN trim(account_id) = '' THEN 'account_id is required' END,
      CASE WHEN total_amount < 0 THEN 'Bill amount cannot be negative' END) AS errors FROM odd_bills"""),
)
def _(spark, folder):
    checked = rules.check(odd_bills(spark, folder), rules.bill_rules())
    return checked.select("bill_id", F.col("total_amount").cast("double").alias("total_amount"), "errors")
