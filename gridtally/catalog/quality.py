"""Quality flags, scores, rules and dead letters."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridtally.catalog.base_sql import (
    ACCOUNTS, BILLS, CONTRACTS, CUSTOMERS, FLAGGED, METERS, OPS_READINGS, OWNED_PAYMENTS, PAYMENTS, READINGS,
)
from gridtally.catalog.readings import AS_OF, flagged
from gridtally.catalog.registry import query, with_ctes
from gridtally.operators import dlq, quality, records, rules
from gridtally.sources import adapters

FLAG_CHAIN = [READINGS, FLAGGED]

REASON_SQL = """concat_ws(' | ', CASE WHEN NOT is_complete THEN 'Missing required fields' END,
  CASE WHEN NOT is_valid THEN 'Anomalous consumption value' END, CASE WHEN NOT is_unique THEN 'Duplicate reading' END)"""


@query("quality_flags", with_ctes(FLAG_CHAIN, "SELECT reading_no, is_complete, is_valid, is_unique, is_good FROM flagged"))
def _(spark, folder):
    return flagged(spark, folder).select("reading_no", "is_complete", "is_valid", "is_unique", "is_good")


@query("quality_rejects", with_ctes(FLAG_CHAIN, f"SELECT reading_no, {REASON_SQL} AS reasons FROM flagged WHERE NOT is_good"))
def _(spark, folder):
    return quality.rejects(flagged(spark, folder)).select("reading_no", "reasons")


def _score_sql(by: str) -> str:
    share = "count(*) FILTER (WHERE {0})::DOUBLE * 100.0 / count(*)::DOUBLE"
    return f"""SELECT {by + ',' if by else ''} count(*) AS total_rows, count(*) FILTER (WHERE is_good) AS good_rows,
      {share.format('is_complete')} AS completeness, {share.format('is_valid')} AS validity,
      {share.format('is_unique')} AS uniqueness, {share.format('is_good')} AS overall_score
      FROM flagged {'GROUP BY 1' if by else ''}"""


@query("quality_scores", with_ctes(FLAG_CHAIN, _score_sql("")))
def _(spark, folder):
    return quality.scores(flagged(spark, folder))


DAY_SCORES = f"quality_runs AS ({_score_sql('CAST(received_at AS DATE) AS run_day')})"


def quality_runs(spark, folder):
    return quality.scores(flagged(spark, folder), F.col("received_at").cast("date").alias("run_day"))


@query("quality_runs_by_day", with_ctes([*FLAG_CHAIN, DAY_SCORES], "SELECT * FROM quality_runs"))
def _(spark, folder):
    return quality_runs(spark, folder)


def _mean(c: str) -> str:
    total = f"sum(CAST({c} AS DECIMAL(18,6)))"
    return f"CAST(round(CAST(CAST({total} AS DOUBLE) / count(*) AS DECIMAL(18,6)), 1) AS DOUBLE) AS {c}"


@query(
    "average_quality_scores",
    with_ctes([*FLAG_CHAIN, DAY_SCORES], f"""SELECT {_mean('overall_score')}, {_mean('completeness')}, {_mean('validity')},
      {_mean('uniqueness')}, count(*) AS total_runs FROM quality_runs"""),
)
def _(spark, folder):
    return quality.average_scores(quality_runs(spark, folder))


@query(
    "quality_gate",
    with_ctes(FLAG_CHAIN, """SELECT CAST(received_at AS DATE) AS batch_day, count(*) AS rows_checked,
      count(*) FILTER (WHERE NOT is_good) AS rows_failed,
      CASE WHEN count(*) FILTER (WHERE is_good)::DOUBLE / count(*) < 0.7 THEN 'QUARANTINED' ELSE 'LOADED' END AS decision
      FROM flagged GROUP BY 1"""),
)
def _(spark, folder):
    return quality.gate_report(flagged(spark, folder), 0.7, F.col("received_at").cast("date").alias("batch_day"))


@query(
    "batch_metrics",
    with_ctes(FLAG_CHAIN, """SELECT 'run-1' AS run_id, 'smartmeter' AS pipeline_name, 'uk_power_networks' AS source, count(*) AS records_received,
      count(*) FILTER (WHERE is_good) AS records_processed, count(*) FILTER (WHERE NOT is_good) AS records_rejected,
      count(*) FILTER (WHERE NOT is_unique) AS duplicate_count, count(*) FILTER (WHERE consumption_kwh IS NULL) AS null_count,
      count(*) FILTER (WHERE NOT is_valid) AS validation_failures, CAST(12 AS BIGINT) AS execution_time_seconds,
      'SUCCESS' AS status, TIMESTAMP '2026-01-01' AS run_timestamp FROM flagged"""),
)
def _(spark, folder):
    return quality.batch_metrics(flagged(spark, folder), "run-1", "smartmeter", "uk_power_networks", 12, AS_OF)


@query(
    "late_readings",
    """SELECT event_id AS reading_no, event_type FROM events e, (SELECT max(ts) AS newest FROM events) m
       WHERE date_diff('second', ts, newest) > 48 * 3600""",
)
def _(spark, folder):
    events = adapters.table(spark, folder, "events")
    received = events.withColumn("received_at", events.agg(F.max("ts")).scalar())
    return quality.stale(received, "ts", "received_at").select(F.col("event_id").alias("reading_no"), "event_type")


@query(
    "snapshot_dq",
    """WITH s AS (SELECT CAST(l_orderkey AS VARCHAR) AS household_id, l_linenumber,
         CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS stdor_to_u,
         CASE WHEN l_linestatus <> 'F' OR l_linenumber > 1 THEN 1.0 END AS consumption_kwh FROM lineitem),
       d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM s)),
       c AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE stdor_to_u IS NULL) AS null_tariff,
         count(*) FILTER (WHERE consumption_kwh IS NULL) AS null_kwh, count(*) - any_value(d.n) AS duplicates FROM s, d),
       g AS (SELECT *, total_rows - null_tariff - null_kwh - duplicates AS good FROM c)
       SELECT total_rows, null_tariff, null_kwh, duplicates, greatest(good, 0) AS valid_rows,
         round(good * 100.0::DOUBLE / total_rows, 1) AS quality_score,
         round((total_rows - null_kwh) * 100.0::DOUBLE / total_rows, 1) AS completeness,
         round((total_rows - null_tariff) * 100.0::DOUBLE / total_rows, 1) AS validity,
         round((total_rows - duplicates) * 100.0::DOUBLE / total_rows, 1) AS uniqueness FROM g""",
)
def _(spark, folder):
    line = adapters.table(spark, folder, "lineitem")
    present = (F.col("l_linestatus") != "F") | (F.col("l_linenumber") > 1)
    snapshot = line.select(
        F.col("l_orderkey").cast("string").alias("household_id"),
        "l_linenumber",
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("stdor_to_u"),
        F.when(present, F.lit(1.0)).alias("consumption_kwh"),
    )
    return quality.snapshot_quality(snapshot)


# --- declarative rules -----------------------------------------------------------------


@query(
    "rules_readings",
    with_ctes([OPS_READINGS], """SELECT reading_id, meter_id, reading_timestamp, concat_ws('; ',
      CASE WHEN reading_value < 0 THEN 'Impossible meter reading: Consumption cannot be negative' END,
      CASE WHEN reading_timestamp > TIMESTAMP '2000-01-01' THEN 'Invalid timestamp: Reading cannot be in the future' END) AS errors,
      CASE WHEN reading_value * 400 > 10000 THEN 'Unusually high reading' ELSE '' END AS warnings FROM ops_readings"""),
)
def _(spark, folder):
    rows = adapters.ops_readings(spark, folder).withColumn("reading_value", F.col("reading_value") * 400)
    checked = rules.check(rows, rules.reading_rules("2000-01-01 00:00:00"))
    return checked.select("reading_id", "meter_id", "reading_timestamp", "errors", "warnings")


@query(
    "rules_payments",
    with_ctes([BILLS, PAYMENTS, OWNED_PAYMENTS], """SELECT payment_id, amount::DOUBLE AS amount,
      CASE WHEN payment_method NOT IN ('CREDIT_CARD', 'BANK_TRANSFER', 'CASH', 'CHECK') THEN 'Invalid payment method' ELSE '' END AS errors
      FROM owned_payments"""),
)
def _(spark, folder):
    checked = rules.check(adapters.payments_with_owner(spark, folder), rules.payment_rules())
    return checked.select("payment_id", F.col("amount").cast("double").alias("amount"), "errors")


def _log_sql(table: str, failures: dict[str, str]) -> str:
    parts = [
        f"SELECT 'run-1' AS run_id, '{table}' AS table_name, '{name}' AS rule_name, count(*) AS rows_checked, "
        f"count(*) FILTER (WHERE NOT coalesce({bad}, false)) AS rows_passed, count(*) FILTER (WHERE coalesce({bad}, false)) AS rows_failed, "
        f"count(*) FILTER (WHERE NOT coalesce({bad}, false))::DOUBLE / count(*)::DOUBLE AS pass_rate FROM {RULE_SOURCES.get(table, table)}"
        for name, bad in failures.items()
    ]
    return "\nUNION ALL\n".join(parts)


RULE_TABLES = {
    "customers": (
        adapters.customers, [CUSTOMERS],
        {
            "email_required": "email IS NULL", "first_name_required": "first_name IS NULL", "last_name_required": "last_name IS NULL",
            "updated_at_after_created_at": "updated_at < created_at",
            "customer_type_allowed": "customer_type NOT IN ('RESIDENTIAL', 'COMMERCIAL', 'INDUSTRIAL')",
        },
    ),
    "contracts": (
        adapters.contracts, [CONTRACTS],
        {
            "end_date_after_start_date": "end_date <= start_date",
            "commodity_type_allowed": "commodity_type NOT IN ('ELECTRICITY', 'GAS', 'WATER')",
            "contract_status_allowed": "contract_status NOT IN ('ACTIVE', 'EXPIRED', 'TERMINATED')",
        },
    ),
    "meters": (
        adapters.meters, [METERS],
        {
            "multiplier_min": "multiplier <= 0", "decommission_date_after_installation_date": "decommission_date < installation_date",
            "decommissioned_has_date": "status = 'DECOMMISSIONED' AND decommission_date IS NULL",
            "meter_type_allowed": "meter_type NOT IN ('AMI', 'AMR', 'MANUAL')",
            "status_allowed": "status NOT IN ('ACTIVE', 'INACTIVE', 'DECOMMISSIONED')",
        },
    ),
    "payments": (
        adapters.payments, [PAYMENTS],
        {
            "amount_min": "amount <= 0", "cleared_has_settlement": "payment_status = 'CLEARED' AND settled_at IS NULL",
            "payment_status_allowed": "payment_status NOT IN ('PENDING', 'CLEARED', 'REVERSED', 'FAILED')",
        },
    ),
}
ACCOUNT_FAILURES = {
    "updated_at_after_created_at": "updated_at < created_at",
    "account_status_allowed": "account_status NOT IN ('ACTIVE', 'SUSPENDED', 'CLOSED')",
    "billing_cycle_allowed": "billing_cycle NOT IN ('MONTHLY', 'QUARTERLY', 'ANNUAL')",
    "payment_method_allowed": "payment_method NOT IN ('DIRECT_DEBIT', 'CREDIT_CARD', 'CHEQUE', 'BANK_TRANSFER')",
}
BILL_FAILURES = {
    "total_amount_min": "total_amount < 0", "tax_amount_min": "tax_amount < 0", "updated_at_after_created_at": "updated_at < created_at",
    "period_end_after_period_start": "period_end <= period_start",
    "due_date_after_bill_date": "due_date < bill_date",
    "bill_status_allowed": "bill_status NOT IN ('ISSUED', 'PAID', 'OVERDUE', 'CANCELLED', 'DISPUTED')",
}
# The sample tables know no change times, tax or quality flags; these are derived, some of them wrong.
LATER_SQL = "TIMESTAMP '2020-01-01' AS created_at, CASE WHEN {0} THEN TIMESTAMP '2019-01-01' ELSE TIMESTAMP '2021-01-01' END AS updated_at"


def _times(df, wrong):
    stamp = lambda year: F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumns({"created_at": stamp(2020), "updated_at": F.when(wrong, stamp(2019)).otherwise(stamp(2021))})


def _rule_accounts(spark, folder):
    return _times(adapters.accounts(spark, folder), F.col("account_status") == "CLOSED")


def odd_bills(spark, folder):
    """Disputed bills with a negative amount, cancelled ones with a negative tax or without an account."""
    status = F.col("bill_status")
    odd = _times(adapters.bills(spark, folder), status == "OVERDUE")
    return odd.withColumns({
        "total_amount": F.when(status == "DISPUTED", -F.col("total_amount")).otherwise(F.col("total_amount")),
        "tax_amount": F.when(status == "CANCELLED", F.lit(-1)).otherwise(F.lit(1)),
        "account_id": F.when(status == "CANCELLED", " ").otherwise(F.col("account_id")),
    })


def _rule_readings(spark, folder):
    kind = F.col("event_type")
    return adapters.table(spark, folder, "events").select(
        (F.col("value") - 5).alias("reading_value"),
        F.when(kind == "error", "therms").otherwise("kWh").alias("unit_of_measure"),
        F.when(kind == "view", "INTERVAL").when(kind == "click", "MANUAL").when(kind == "signup", "GUESSED").otherwise("CUMULATIVE").alias("reading_type"),
        F.when(kind == "purchase", "UNKNOWN").otherwise("VALID").alias("quality_flag"),
    )


ODD_ACCOUNTS = f"odd_accounts AS (SELECT *, {LATER_SQL.format("account_status = 'CLOSED'")} FROM accounts)"
ODD_BILLS = f"""odd_bills AS (SELECT * REPLACE (CASE WHEN bill_status = 'DISPUTED' THEN -total_amount ELSE total_amount END AS total_amount,
    CASE WHEN bill_status = 'CANCELLED' THEN ' ' ELSE account_id END AS account_id),
    CASE WHEN bill_status = 'CANCELLED' THEN -1 ELSE 1 END AS tax_amount, {LATER_SQL.format("bill_status = 'OVERDUE'")} FROM bills)"""
ODD_READINGS = """meter_readings AS (SELECT value - 5 AS reading_value, CASE WHEN event_type = 'error' THEN 'therms' ELSE 'kWh' END AS unit_of_measure,
    CASE event_type WHEN 'view' THEN 'INTERVAL' WHEN 'click' THEN 'MANUAL' WHEN 'signup' THEN 'GUESSED' ELSE 'CUMULATIVE' END AS reading_type,
    CASE WHEN event_type = 'purchase' THEN 'UNKNOWN' ELSE 'VALID' END AS quality_flag FROM events)"""
RULE_TABLES["accounts"] = (_rule_accounts, [ACCOUNTS, ODD_ACCOUNTS], ACCOUNT_FAILURES)
RULE_TABLES["bills"] = (odd_bills, [BILLS, ODD_BILLS], BILL_FAILURES)
RULE_TABLES["meter_readings"] = (
    _rule_readings, [ODD_READINGS],
    {
        "reading_value_min": "reading_value < 0", "unit_of_measure_allowed": "unit_of_measure NOT IN ('kWh', 'm3', 'liters')",
        "reading_type_allowed": "reading_type NOT IN ('INTERVAL', 'CUMULATIVE', 'MANUAL')",
        "quality_flag_allowed": "quality_flag NOT IN ('VALID', 'ESTIMATED', 'SUSPECT', 'REJECTED')",
    },
)
# Where the defects are put into a derived table, the SQL reads that one.
RULE_SOURCES = {"accounts": "odd_accounts", "bills": "odd_bills"}


def _register_log(table: str) -> None:
    load, ctes, failures = RULE_TABLES[table]

    @query(f"rule_run_log_{table}", with_ctes(ctes, _log_sql(table, failures)))
    def _(spark, folder):
        return rules.run_log(load(spark, folder), rules.table_rules(table), table, "run-1")


for _table in RULE_TABLES:
    _register_log(_table)


# --- record validation and dead letters -------------------------------------------------

BAD_RECORDS = """records AS (
  SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS reading_id,
    CASE WHEN event_type = 'signup' THEN 'unknown' WHEN event_type = 'click' THEN CAST(CAST(-value AS DECIMAL(18,4)) AS VARCHAR)
      WHEN event_type = 'purchase' THEN CAST(CAST(value * 100000 AS DECIMAL(18,4)) AS VARCHAR) ELSE CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) END AS reading_value,
    CASE WHEN event_type = 'view' AND value < 10 THEN NULL WHEN event_type = 'error' THEN '0000-00-00'
      ELSE strftime(ts, '%Y-%m-%d') END AS read_at,
    event_id, event_type, value
  FROM events)"""

RECORD_ERRORS = """concat_ws('; ',
  CASE WHEN event_type = 'error' THEN 'Missing primary key / ID field' END,
  CASE WHEN event_type = 'click' AND value > 0 THEN 'Negative reading_value not allowed' END,
  CASE WHEN event_type = 'purchase' AND value * 100000 > 999999 THEN 'reading_value exceeds realistic maximum' END,
  CASE WHEN event_type = 'signup' THEN 'reading_value must be numeric' END,
  CASE WHEN event_type = 'view' AND value < 10 THEN 'read_at timestamp is required' END,
  CASE WHEN event_type = 'error' THEN 'Invalid zero-timestamp in read_at' END)"""


def reading_records(spark, folder):
    e = adapters.table(spark, folder, "events")
    kind, value = F.col("event_type"), F.col("value")
    text = lambda number: number.cast("decimal(18,4)").cast("string")  # noqa: E731  the same text in any engine
    return e.select(
        F.when(kind != "error", F.col("event_id").cast("string")).alias("reading_id"),
        F.when(kind == "signup", "unknown")
        .when(kind == "click", text(-value))
        .when(kind == "purchase", text(value * 100000))
        .otherwise(text(value))
        .alias("reading_value"),
        F.when((kind == "view") & (value < 10), F.lit(None))
        .when(kind == "error", "0000-00-00")
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("read_at"),
        "event_id",
    )


@query("validate_reading_records", with_ctes([BAD_RECORDS], f"SELECT event_id, {RECORD_ERRORS} AS errors FROM records"))
def _(spark, folder):
    return records.validate(reading_records(spark, folder), "meter_readings").select("event_id", "errors")


@query(
    "validate_payment_records",
    """SELECT c_custkey AS payment_no, CASE WHEN c_acctbal < 0 THEN 'Financial amount cannot be negative' ELSE '' END AS errors FROM customer""",
)
def _(spark, folder):
    c = adapters.table(spark, folder, "customer")
    rows = c.select(F.col("c_custkey").alias("payment_no"), F.col("c_name").alias("payment_id"), F.col("c_acctbal").alias("amount"))
    return records.validate(rows, "payments").select("payment_no", "errors")


LETTERS = f"""letters AS (
  SELECT '{{"reading_id":' || coalesce('"' || reading_id || '"', 'null') || ',"reading_value":"' || reading_value
    || '","read_at":' || coalesce('"' || read_at || '"', 'null') || '}}' AS original_payload, error_message
  FROM (SELECT *, {RECORD_ERRORS} AS error_message FROM records)
  WHERE error_message <> '')"""


def letters(spark, folder):
    rows = reading_records(spark, folder).drop("event_id")
    bad = records.validate(rows, "meter_readings").filter("errors != ''")
    return dlq.dead_letters(bad, "errors", "datastream_postgres", "meter_readings", AS_OF)


@query(
    "dlq_records",
    with_ctes([BAD_RECORDS, LETTERS], """SELECT md5('meter_readings' || chr(1) || original_payload || chr(1) || error_message) AS dlq_id,
      'datastream_postgres' AS source_system, 'meter_readings' AS source_table, original_payload, 'VALIDATION_ERROR' AS error_category,
      error_message, 1 AS processing_attempt_count, TIMESTAMP '2026-01-01' AS failure_timestamp, 'UNRESOLVED' AS status FROM letters"""),
)
def _(spark, folder):
    return letters(spark, folder)


@query(
    "dlq_replay",
    with_ctes([BAD_RECORDS, LETTERS], """SELECT error_message, 2 AS processing_attempt_count, 'PROCESSING' AS status, count(*) AS letters
      FROM letters WHERE error_message NOT LIKE '%must be numeric%' GROUP BY 1
      UNION ALL SELECT 'resolved', 1, 'RESOLVED', count(*) FROM letters WHERE error_message LIKE '%must be numeric%'"""),
)
def _(spark, folder):
    """Replay after text values have been repaired: those rows pass, the rest stay."""
    def repaired(df):
        fixed = df.withColumn("reading_value", F.when(F.col("reading_value") != "unknown", F.col("reading_value")))
        return records.validate(fixed, "meter_readings")

    resolved, failed = dlq.replay(letters(spark, folder), "reading_id string, reading_value string, read_at string", repaired)
    left = failed.groupBy("error_message", "processing_attempt_count", "status").agg(F.count("*").alias("letters"))
    good = resolved.agg(F.count("*").alias("letters")).select(
        F.lit("resolved").alias("error_message"), F.lit(1).alias("processing_attempt_count"), F.lit("RESOLVED").alias("status"), "letters"
    )
    return left.unionByName(good)


@query(
    "dlq_events",
    with_ctes(FLAG_CHAIN, f"""SELECT reading_no, 'uk_power_networks' AS source, 'smartmeter' AS dataset, 'VALIDATION_FAILED' AS error_type,
      {REASON_SQL} AS error_message, substr('{{"reading_no":' || reading_no || ',"meter_id":"' || meter_id || '","stdor_to_u":'
        || coalesce('"' || stdor_to_u || '"', 'null') || '}}', 1, 500) AS payload_reference, 1 AS attempt_count, 'PENDING' AS status
      FROM flagged WHERE NOT is_good"""),
)
def _(spark, folder):
    bad = quality.rejects(flagged(spark, folder))
    out = dlq.events(bad, "reasons", "uk_power_networks", "smartmeter", ["reading_no", "meter_id", "stdor_to_u"])
    number = F.get_json_object("payload_reference", "$.reading_no").cast("bigint")
    return out.withColumn("reading_no", number).drop("event_id")


@query(
    "quarantine_records",
    with_ctes(FLAG_CHAIN, f"""SELECT md5('run-1' || chr(1) || 'smartmeter' || chr(1) || reading_no || chr(1) || meter_id) AS quarantine_id,
      'run-1' AS run_id, 'smartmeter' AS dataset, CAST(NULL AS VARCHAR) AS original_file_uri,
      '{{"reading_no":' || reading_no || ',"meter_id":"' || meter_id || '"}}' AS record_content, {REASON_SQL} AS rejection_reason,
      TIMESTAMP '2026-01-01' AS quarantined_at FROM flagged WHERE NOT is_good"""),
)
def _(spark, folder):
    bad = quality.rejects(flagged(spark, folder))
    return dlq.quarantine(bad, "reasons", "run-1", "smartmeter", ["reading_no", "meter_id"], AS_OF)
