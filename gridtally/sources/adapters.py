"""Sample tables seen as metering and billing tables.

The sample data set has generic tables (events, customer, orders, lineitem, part).
Each function reads one of them and names its columns as the domain does. All
rows are kept; irregular values are mapped to the defects the operators handle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridtally.functions import times
from gridtally.operators.normalize import READING_SOURCE
from gridtally.operators.once import computed_once


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _case(column: str, mapping: dict[str, str], default: str | None = None) -> Column:
    out = F.when(F.lit(False), "")
    for value, result in mapping.items():
        out = out.when(F.col(column) == value, result)
    return out if default is None else out.otherwise(default)


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


TARIFF_OF = {"view": "Std", "click": "Std", "purchase": "ToU", "signup": "ToU"}


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Half-hourly meter readings. ``error`` events carry no value and no tariff;
    the smallest ``signup`` values lost their timestamp."""
    events = table(spark, folder, "events")
    number = F.format_string("%06d", F.col("user_id"))
    lost = (F.col("event_type") == "signup") & (F.col("value") < 1)
    return events.select(
        F.col("event_id").alias("reading_no"),
        F.concat(F.lit("METER-"), number).alias("meter_id"),
        F.concat(F.lit("MAC"), number).alias("household_id"),
        F.when(~lost, times.half_hour(F.col("ts"))).alias("event_timestamp"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("consumption_kwh"),
        _case("event_type", TARIFF_OF).alias("stdor_to_u"),
        F.lit(READING_SOURCE).alias("source_system"),
        F.col("ts").alias("received_at"),
    )


def source_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same readings as the text columns of a meter file."""
    events = table(spark, folder, "events")
    number = F.format_string("%06d", F.col("user_id"))
    slot = times.half_hour(F.col("ts"))
    kind, value = F.col("event_type"), F.col("value")
    return events.select(
        F.when((kind == "signup") & (value > 50), "").otherwise(F.concat(F.lit("MAC"), number)).alias("LCLid"),
        _case("event_type", TARIFF_OF, "").alias("stdorToU"),
        F.when((kind == "click") & (value > 80), F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.concat(F.date_format(slot, "yyyy-MM-dd HH:mm:ss"), F.lit(".0000000")))
        .alias("DateTime"),
        F.when(kind == "error", "Null")
        .when((kind == "purchase") & (value > 80), "n/a")
        .otherwise(value.cast("string"))
        .alias("KWH/hh (per half hour)"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    balance = F.col("c_acctbal")
    segment = {
        "BUILDING": "COMMERCIAL", "MACHINERY": "INDUSTRIAL", "AUTOMOBILE": " industrial ",
        "HOUSEHOLD": "RESIDENTIAL", "FURNITURE": "residential",
    }
    created = F.lit("2010-01-01 00:00:00").cast("timestamp_ntz")
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_number"),
        F.lit("Customer").alias("first_name"),
        F.substring("c_name", 10, 20).alias("last_name"),
        F.when(balance > -900, F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))).alias("email"),
        F.when(balance >= 0, F.concat(F.lit("+44"), F.format_string("%010d", F.col("c_custkey")))).alias("phone"),
        _case("c_mktsegment", segment).alias("customer_type"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 365).alias("date_of_birth"),
        F.when(balance < 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        created.alias("created_at"),
        F.timestamp_add("DAY", F.col("c_nationkey") - 2, created).alias("updated_at"),
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    cycle = {"BUILDING": "QUARTERLY", "MACHINERY": "ANNUAL", "FURNITURE": "WEEKLY"}
    method = {"BUILDING": "BANK_TRANSFER", "MACHINERY": "CHEQUE", "AUTOMOBILE": "CREDIT_CARD"}
    return c.select(
        _text("ACC-", "c_custkey").alias("account_id"),
        F.col("c_name").alias("account_number"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.when(F.col("c_acctbal") < 0, "SUSPENDED").when(F.col("c_acctbal") > 9000, "CLOSED").otherwise("ACTIVE").alias("account_status"),
        _case("c_mktsegment", cycle, "MONTHLY").alias("billing_cycle"),
        _case("c_mktsegment", method, "DIRECT_DEBIT").alias("payment_method"),
    )


def _commodity(column: str) -> Column:
    return F.when(F.col(column) < 10, "ELECTRICITY").when(F.col(column) < 20, "GAS").otherwise("WATER")


def contracts(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    start = F.date_add(F.lit("1995-01-01").cast("date"), F.col("c_nationkey") * 30)
    return c.select(
        _text("CTR-", "c_custkey").alias("contract_id"),
        _text("ACC-", "c_custkey").alias("account_id"),
        F.concat("c_mktsegment", F.lit("-FLAT")).alias("tariff_code"),
        _commodity("c_nationkey").alias("commodity_type"),
        start.alias("start_date"),
        F.when(F.col("c_acctbal") < 0, F.date_sub(start, 1))
        .when(F.col("c_acctbal") > 9000, F.date_add(start, 900))
        .alias("end_date"),
        F.when(F.col("c_acctbal") < 0, "TERMINATED").when(F.col("c_acctbal") > 9000, "EXPIRED").otherwise("ACTIVE").alias("contract_status"),
    )


def service_points(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    return p.select(
        _text("SP-", "p_partkey").alias("service_point_id"),
        _text("CTR-", "p_partkey").alias("contract_id"),
        _commodity("p_size").alias("commodity_type"),
        F.col("p_brand").alias("grid_zone"),
    )


def meters(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    installed = F.date_add(F.lit("1994-06-01").cast("date"), F.col("p_size") * 20)
    size = F.col("p_size")
    return p.select(
        _text("M-", "p_partkey").alias("meter_id"),
        _text("SP-", "p_partkey").alias("service_point_id"),
        F.concat_ws("/", "p_name", "p_brand", "p_type").alias("meter_serial_number"),
        F.when(size < 17, "AMI").when(size < 34, "AMR").otherwise("MANUAL").alias("meter_type"),
        F.when(size < 25, "ELECTRICITY").otherwise("GAS").alias("commodity_type"),
        F.when(size < 30, "ACTIVE").when(size < 40, "INACTIVE").otherwise("DECOMMISSIONED").alias("status"),
        installed.alias("installation_date"),
        F.when(size.between(40, 45), F.date_add(installed, 100)).when(size.between(30, 31), F.date_sub(installed, 5)).alias("decommission_date"),
        (size - 1).cast("decimal(10,4)").alias("multiplier"),
    )


def ops_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Operational readings; (order, line) pairs repeat, so reading ids do too."""
    line = table(spark, folder, "lineitem")
    return line.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("reading_id"),
        _text("M-", "l_partkey").alias("meter_id"),
        F.col("l_quantity").alias("reading_value"),
        F.lit("kWh").alias("unit"),
        F.col("l_shipdate").alias("reading_timestamp"),
        _case("l_returnflag", {"N": "INTERVAL", "A": "MANUAL", "R": "CUMULATIVE"}).alias("reading_type"),
        _case("l_linestatus", {"F": "VALID", "O": "UNKNOWN"}).alias("quality_flag"),
    )


BILL_STATUS = {"F": "PAID", "O": "ISSUED"}
OPEN_BILL = {"1-URGENT": "DISPUTED", "5-LOW": "CANCELLED"}


def bills(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    status = _case("o_orderstatus", BILL_STATUS)
    return o.select(
        _text("B-", "o_orderkey").alias("bill_id"),
        _text("ACC-", "o_custkey").alias("account_id"),
        _text("CTR-", "o_custkey").alias("contract_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        day.alias("bill_date"),
        F.date_add(day, 21).alias("due_date"),
        F.date_sub(day, 30).alias("period_start"),
        F.date_sub(day, 1).alias("period_end"),
        F.col("o_totalprice").cast("decimal(12,4)").alias("total_amount"),
        F.coalesce(status, _case("o_orderpriority", OPEN_BILL, "OVERDUE")).alias("bill_status"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    line = table(spark, folder, "lineitem")
    cleared = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    method = (
        F.when(F.col("l_linenumber") <= 2, "CREDIT_CARD").when(F.col("l_linenumber") <= 4, "DIRECT_DEBIT").otherwise("BANK_TRANSFER")
    )
    return line.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("payment_id"),
        _text("B-", "l_orderkey").alias("bill_id"),
        F.col("l_extendedprice").cast("decimal(12,4)").alias("amount"),
        method.alias("payment_method"),
        _case("l_returnflag", {"N": "CLEARED", "A": "FAILED", "R": "REVERSED"}).alias("payment_status"),
        F.col("l_shipdate").alias("payment_date"),
        F.when(cleared, F.timestamp_add("DAY", F.lit(2), F.col("l_shipdate"))).alias("settled_at"),
    )


def payments_with_owner(spark: SparkSession, folder: str) -> DataFrame:
    owner = bills(spark, folder).select("bill_id", "account_id", "customer_id")
    return payments(spark, folder).join(owner, "bill_id")


def customer_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change feed of customers, several changes per customer."""
    o = table(spark, folder, "orders")
    deleted = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return o.select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@"), F.lower("o_orderstatus"), F.lit(".example")).alias("email"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.substring("o_orderpriority", 1, 1)).alias("phone"),
        _case("o_orderstatus", {"F": "COMMERCIAL", "O": "RESIDENTIAL"}, "INDUSTRIAL").alias("customer_type"),
        F.when(deleted, "DELETE").when(F.col("o_orderstatus") == "F", "INSERT").otherwise("UPDATE").alias("operation"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.col("o_orderkey").alias("change_no"),
    )


def change_lines(spark: SparkSession, folder: str, keep: tuple = ()) -> DataFrame:
    """Change records as JSON text (``value``), some of them broken, beside the ``keep`` columns of the events."""
    e = table(spark, folder, "events")
    kind, value = F.col("event_type"), F.col("value")
    operation = F.when(value < 5, "INSERT").when(value < 50, "UPDATE").otherwise("DELETE")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))

    def meta(name: str, timed: bool = True) -> Column:
        parts = [operation.alias("change_type"), F.lit(name).alias("table"), F.lit("utility").alias("schema")]
        return F.struct(*parts, *([stamp.alias("timestamp")] if timed else [])).alias("_metadata")

    user, number = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    customer = F.concat(F.lit("C"), user).alias("customer_id")
    meter = F.concat(F.lit("M-"), user).alias("meter_id")
    reading = F.to_json(
        F.struct(
            number.alias("reading_id"), meter, value.alias("reading_value"), F.lit("kWh").alias("unit_of_measure"),
            F.lit("INTERVAL").alias("reading_type"), F.lit("VALID").alias("quality_flag"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("read_at"), meta("meter_readings"),
        )
    )
    state = F.when(value < 20, "ACTIVE").otherwise("INACTIVE").alias("status")
    broken = (
        F.when(value < 10, F.to_json(F.struct(customer, F.lit("ACTIVE").alias("status"))))
        .when(value < 30, F.concat(F.lit("not json "), number))
        .when(value < 60, F.to_json(F.struct(F.lit("").alias("customer_id"), meta("customers"))))
        .otherwise(F.concat(F.lit("["), number, F.lit("]")))
    )
    account = F.concat(F.lit("ACC-"), user).alias("account_id")
    text = (
        F.when(kind == "signup", F.to_json(F.struct(customer, account, F.lit("ACTIVE").alias("status"), meta("customers"))))
        .when(kind == "view", reading)
        .when(kind == "click", F.to_json(F.struct(meter, state, meta("meters", timed=False))))
        .when(kind == "purchase", F.to_json(F.struct(F.concat(F.lit("P"), number).alias("payment_id"), account, value.alias("amount"), meta("payments"))))
        .otherwise(broken)
    )
    return computed_once(e, list(keep), {"value": text})


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Run log: each order is a run that starts, each of its lines reports on it."""
    o = table(spark, folder, "orders")
    line = table(spark, folder, "lineitem")
    none = F.lit(0).cast("bigint")
    started = o.select(
        F.col("o_orderkey").alias("run_id"),
        F.lit("RUNNING").alias("status"),
        F.col("o_orderdate").alias("event_time"),
        none.alias("rows_received"),
        F.lit("start").alias("event_id"),
    )
    reported = line.select(
        F.col("l_orderkey").alias("run_id"),
        _case("l_returnflag", {"A": "FAILED", "R": "RUNNING", "N": "SUCCESS"}).alias("status"),
        F.col("l_shipdate").alias("event_time"),
        F.col("l_quantity").cast("bigint").alias("rows_received"),
        # Lines repeat, so their id spells out what they report.
        F.concat_ws("/", F.col("l_linenumber").cast("string"), "l_returnflag", F.format_string("%08d", F.col("l_quantity").cast("bigint"))).alias("event_id"),
    )
    return started.unionByName(reported)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Finished and open runs, one row each."""
    o = table(spark, folder, "orders")
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("source"),
        _case("o_orderstatus", {"F": "SUCCESS", "O": "FAILED", "P": "RUNNING"}).alias("status"),
        F.col("o_orderdate").alias("started_at"),
        F.col("o_totalprice").cast("bigint").alias("rows_received"),
    )
