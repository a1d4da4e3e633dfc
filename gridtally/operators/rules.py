"""Declarative quality rules, compiled to one pass over the table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

ERROR, WARNING = "ERROR", "WARNING"


@dataclass(frozen=True)
class Rule:
    """``passes`` is a SQL condition; NULL means the rule does not apply."""

    name: str
    passes: str
    message: str
    severity: str = ERROR

    def failed(self) -> Column:
        return F.coalesce(~F.expr(self.passes), F.lit(False))


def required(column: str) -> Rule:
    return Rule(f"{column}_required", f"{column} is not null and trim(string({column})) != ''", f"{column} is required")


def minimum(column: str, low: float, message: str, strict: bool = False) -> Rule:
    op = ">" if strict else ">="
    # text that is no number is the numeric rule's matter
    return Rule(f"{column}_min", f"try_cast({column} as double) {op} {low}", message)


def allowed(column: str, values: list[str], message: str | None = None) -> Rule:
    listed = ", ".join(f"'{v}'" for v in values)
    return Rule(f"{column}_allowed", f"{column} in ({listed})", message or f"Invalid {column}")


def numeric(column: str) -> Rule:
    return Rule(
        f"{column}_numeric", f"{column} is null or try_cast({column} as double) is not null", f"{column} must be numeric"
    )


def not_after(column: str, moment: str, message: str) -> Rule:
    return Rule(f"{column}_not_future", f"{column} <= timestamp_ntz'{moment}'", message)


def ordered(earlier: str, later: str, strict: bool = False) -> Rule:
    op = ">" if strict else ">="
    return Rule(f"{later}_after_{earlier}", f"{later} {op} {earlier}", f"{later} is before {earlier}")


def implies(name: str, condition: str, column: str) -> Rule:
    return Rule(name, f"not ({condition}) or {column} is not null", f"{column} is required when {condition}")


def flagged_when(name: str, condition: str, message: str) -> Rule:
    return Rule(name, f"not ({condition})", message, WARNING)


def check(df: DataFrame, rules: list[Rule], separator: str = "; ") -> DataFrame:
    """Add ``errors`` and ``warnings``: joined messages, empty text for none."""
    def joined(severity: str) -> Column:
        return F.concat_ws(separator, *[F.when(r.failed(), F.lit(r.message)) for r in rules if r.severity == severity])

    return df.withColumn("errors", joined(ERROR)).withColumn("warnings", joined(WARNING))


def run_log(df: DataFrame, rules: list[Rule], table: str, run_id: str) -> DataFrame:
    """One row per rule: rows checked, passed, failed and the pass rate."""
    measured = df.agg(F.count("*").alias("_n"), *[F.count_if(r.failed()).alias(f"_f{i}") for i, r in enumerate(rules)])
    pairs = ", ".join(f"'{r.name}', _f{i}" for i, r in enumerate(rules))
    return measured.select("_n", F.expr(f"stack({len(rules)}, {pairs}) as (rule_name, rows_failed)")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(table).alias("table_name"),
        "rule_name",
        F.col("_n").alias("rows_checked"),
        (F.col("_n") - F.col("rows_failed")).alias("rows_passed"),
        "rows_failed",
        (F.when(F.col("_n") > 0, (F.col("_n") - F.col("rows_failed")) / F.col("_n"))).alias("pass_rate"),
    )


# Enumerations of the operational tables.
ENUMS = {
    "customers.customer_type": ["RESIDENTIAL", "COMMERCIAL", "INDUSTRIAL"],
    "accounts.account_status": ["ACTIVE", "SUSPENDED", "CLOSED"],
    "accounts.billing_cycle": ["MONTHLY", "QUARTERLY", "ANNUAL"],
    "accounts.payment_method": ["DIRECT_DEBIT", "CREDIT_CARD", "CHEQUE", "BANK_TRANSFER"],
    "contracts.commodity_type": ["ELECTRICITY", "GAS", "WATER"],
    "contracts.contract_status": ["ACTIVE", "EXPIRED", "TERMINATED"],
    "meters.meter_type": ["AMI", "AMR", "MANUAL"],
    "meters.status": ["ACTIVE", "INACTIVE", "DECOMMISSIONED"],
    "meter_readings.unit_of_measure": ["kWh", "m3", "liters"],
    "meter_readings.reading_type": ["INTERVAL", "CUMULATIVE", "MANUAL"],
    "meter_readings.quality_flag": ["VALID", "ESTIMATED", "SUSPECT", "REJECTED"],
    "bills.bill_status": ["ISSUED", "PAID", "OVERDUE", "CANCELLED", "DISPUTED"],
    "payments.payment_status": ["PENDING", "CLEARED", "REVERSED", "FAILED"],
}

# The payment methods the batch rule set accepts (fewer than the table does).
BATCH_PAYMENT_METHODS = ["CREDIT_CARD", "BANK_TRANSFER", "CASH", "CHECK"]
LEAK_THRESHOLD = 10000


def reading_rules(as_of: str) -> list[Rule]:
    return [
        required("meter_id"),
        required("reading_value"),
        required("reading_timestamp"),
        numeric("reading_value"),
        minimum("reading_value", 0, "Impossible meter reading: Consumption cannot be negative"),
        not_after("reading_timestamp", as_of, "Invalid timestamp: Reading cannot be in the future"),
        flagged_when("consumption_threshold", f"reading_value > {LEAK_THRESHOLD}", "Unusually high reading"),
    ]


def payment_rules() -> list[Rule]:
    return [
        required("account_id"),
        required("amount"),
        required("payment_method"),
        numeric("amount"),
        minimum("amount", 0.01, "Negative quantities not allowed for standard payments"),
        allowed("payment_method", BATCH_PAYMENT_METHODS, "Invalid payment method"),
    ]


def bill_rules() -> list[Rule]:
    return [
        required("bill_id"),
        required("account_id"),
        required("total_amount"),
        numeric("total_amount"),
        minimum("total_amount", 0, "Bill amount cannot be negative"),
    ]


def table_rules(table: str) -> list[Rule]:
    """Constraints of an operational table, as rules."""
    enums = [allowed(k.split(".")[1], v) for k, v in ENUMS.items() if k.split(".")[0] == table]
    own = {
        "customers": [required("email"), required("first_name"), required("last_name"), ordered("created_at", "updated_at")],
        "accounts": [ordered("created_at", "updated_at")],
        "contracts": [ordered("start_date", "end_date", strict=True)],
        "meters": [
            minimum("multiplier", 0, "multiplier must be positive", strict=True),
            ordered("installation_date", "decommission_date"),
            implies("decommissioned_has_date", "status = 'DECOMMISSIONED'", "decommission_date"),
        ],
        "meter_readings": [minimum("reading_value", 0, "reading_value is negative")],
        "bills": [
            minimum("total_amount", 0, "total_amount is negative"),
            minimum("tax_amount", 0, "tax_amount is negative"),
            ordered("created_at", "updated_at"),
            ordered("period_start", "period_end", strict=True),
            ordered("bill_date", "due_date"),
        ],
        "payments": [
            minimum("amount", 0, "amount must be positive", strict=True),
            implies("cleared_has_settlement", "payment_status = 'CLEARED'", "settled_at"),
        ],
    }
    return own.get(table, []) + enums
