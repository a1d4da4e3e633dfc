"""Star schema: dimensions and facts from operational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtally import session
from gridtally.functions import keys, numbers, times
from gridtally.operators import dedup

# Fixed values.
MASTER_REGION = "REGION-LONDON"
MASTER_CURRENCY = "GBP"
MASTER_METER = "SMART_ELECTRICITY"
MASTER_DATES = {"customer": "2010-01-01", "account": "2010-01-15", "contract": "2010-01-20", "meter": "2010-02-01"}
TARIFFS = {
    "Std": ("UKPN-STD", "Standard Tariff (Flat Rate)"),
    "ToU": ("UKPN-TOU", "Time of Use Tariff (Variable Rate)"),
}
TARIFFS_VALID_FROM = "2010-01-01 00:00:00"
READING_LINEAGE = "datastream_events"
CUSTOMER_LINEAGE = "postgres_ops"


def households(gold: DataFrame, *order: str) -> DataFrame:
    """One row per household with the tariff of its first reading."""
    return dedup.first_per_key(gold, ["household_id"], *order).select("household_id", "stdor_to_u")


def master_data(homes: DataFrame) -> dict[str, DataFrame]:
    """Customer, account, service point, contract and meter of each household."""
    def ident(prefix: str):
        return F.concat(F.lit(f"{prefix}-"), F.replace(F.col("household_id"), F.lit("MAC"), F.lit("")))

    def since(entity: str):
        return F.lit(MASTER_DATES[entity]).cast("timestamp_ntz")

    active = F.lit("ACTIVE").alias("status")
    return {
        "customer": homes.select(ident("CUS").alias("id"), active, since("customer").alias("created_at")),
        "account": homes.select(
            ident("ACC").alias("id"),
            ident("CUS").alias("customer_id"),
            active,
            since("account").alias("opened_at"),
            F.lit(MASTER_CURRENCY).alias("currency"),
        ),
        "service_point": homes.select(ident("SP").alias("id"), F.lit(MASTER_REGION).alias("region_code"), active),
        "contract": homes.select(
            ident("CTR").alias("id"),
            ident("ACC").alias("account_id"),
            ident("SP").alias("service_point_id"),
            active,
            since("contract").alias("contract_start"),
            F.lit(None).cast("timestamp_ntz").alias("contract_end"),
        ),
        "meter": homes.select(
            ident("METER").alias("id"),
            F.col("household_id").alias("source_household_id"),
            ident("SP").alias("service_point_id"),
            F.col("stdor_to_u").alias("tariff_code"),
            F.lit(MASTER_METER).alias("meter_type"),
            since("meter").alias("installation_date"),
            active,
        ),
    }


def meter_with_service_point(meters: DataFrame, service_points: DataFrame) -> DataFrame:
    """Each meter with its service point as a nested record."""
    points = service_points.select(F.col("id").alias("_sp"), F.struct(*service_points.columns).alias("service_point"))
    return meters.join(points, F.col("service_point_id") == F.col("_sp"), "left").drop("_sp")


def master_mapping(master: dict[str, DataFrame]) -> DataFrame:
    """Household to meter, service point, contract, account and customer."""
    meters = master["meter"].select(
        "source_household_id", F.col("id").alias("meter_id"), "service_point_id", "tariff_code"
    )
    points = master["service_point"].select(F.col("id").alias("service_point_id"))
    contracts = master["contract"].select(F.col("id").alias("contract_id"), "service_point_id", "account_id")
    accounts = master["account"].select(F.col("id").alias("account_id"), "customer_id")
    customers = master["customer"].select(F.col("id").alias("customer_id"))
    return (
        meters.join(points, "service_point_id")
        .join(contracts, "service_point_id")
        .join(accounts, "account_id")
        .join(customers, "customer_id")
        .select(
            "source_household_id", "meter_id", "service_point_id", "contract_id", "account_id", "customer_id", "tariff_code"
        )
    )


def dim_tariff(readings: DataFrame, source: str) -> DataFrame:
    """The tariffs that occur, described without inventing prices."""
    code = F.col("stdor_to_u")
    key = F.when(F.lit(False), "")
    description = F.when(F.lit(False), "")
    for value, (k, text) in TARIFFS.items():
        key, description = key.when(code == value, k), description.when(code == value, text)
    return (
        readings.filter(code.isNotNull())
        .select("stdor_to_u")
        .distinct()
        .select(
            key.otherwise(F.concat(F.lit("UKPN-"), F.upper(code))).alias("tariff_key"),
            code.alias("source_tariff_code"),
            description.otherwise(code).alias("tariff_description"),
            F.lit(source).alias("source_system"),
            F.lit(TARIFFS_VALID_FROM).cast("timestamp_ntz").alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        )
    )


def dim_meter_span(gold: DataFrame) -> DataFrame:
    """First and last reading of each meter."""
    return gold.groupBy("meter_id", F.col("household_id").alias("source_household_id")).agg(
        F.min("event_timestamp").alias("first_reading_date"), F.max("event_timestamp").alias("last_reading_date")
    )


def dim_date(df: DataFrame, moment: str) -> DataFrame:
    """Calendar from the first to the last day that occurs."""
    span = df.agg(F.min(F.col(moment).cast("date")).alias("a"), F.max(F.col(moment).cast("date")).alias("b"))
    days = span.select(F.explode(F.expr("sequence(a, b, interval 1 day)")).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        keys.date_key(d).alias("date_sk"),
        "full_date",
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_customer(customers: DataFrame, loaded_at: str) -> DataFrame:
    stamp = times.at(loaded_at)
    return customers.select(
        keys.surrogate_key(F.col("customer_id")).alias("customer_sk"),
        "customer_id",
        "customer_number",
        "customer_type",
        "status",
        F.lit(CUSTOMER_LINEAGE).alias("source_system"),
        stamp.alias("bq_insert_timestamp"),
        stamp.alias("bq_update_timestamp"),
    )


def reading_fact(readings: DataFrame, loaded_at: str) -> DataFrame:
    """Operational readings, latest version of each, with warehouse keys."""
    latest = dedup.latest_per_key(readings, ["reading_id"], "reading_timestamp", "reading_value", "meter_id")
    return latest.select(
        keys.surrogate_key(F.col("reading_id")).alias("reading_sk"),
        keys.surrogate_key(F.col("meter_id")).alias("meter_sk"),
        keys.date_key(F.col("reading_timestamp")).alias("date_sk"),
        "reading_id",
        "reading_value",
        "unit",
        "reading_timestamp",
        F.lit(READING_LINEAGE).alias("source_system"),
        times.at(loaded_at).alias("dw_created_at"),
    )


def consumption_fact(readings: DataFrame, meter: str, moment: str, value: str) -> DataFrame:
    """Usage and reading count per meter and day."""
    return readings.groupBy(meter, F.col(moment).cast("date").alias("consumption_date")).agg(
        numbers.exact_sum(F.col(value)).alias("total_consumption"), F.count("*").alias("reading_count")
    )


def resolve_keys(facts: DataFrame, dimension: DataFrame, key: str, sk: str) -> tuple[DataFrame, DataFrame]:
    """Facts with the dimension's key, and the facts whose key is unknown."""
    known = dimension.select(F.col(key).alias("_key"), F.col(sk).alias(sk))
    # two outputs, one join
    joined = session.materialize(facts.join(known, F.col(key) == F.col("_key"), "left"), "resolved")
    return (
        joined.filter(F.col("_key").isNotNull()).drop("_key"),
        joined.filter(F.col("_key").isNull()).drop("_key", sk),
    )


def billing_star(bills: DataFrame, accounts: DataFrame, customers: DataFrame, contracts: DataFrame) -> DataFrame:
    """Bills with the customer type and commodity they belong to.

    No join hint: Catalyst broadcasts a dimension only below its size limit, and
    adaptive execution splits the partitions of an account with very many bills.
    """
    a = accounts.select("account_id", "customer_id")
    c = customers.select("customer_id", "customer_type")
    k = contracts.select("contract_id", "commodity_type")
    return bills.join(a, "account_id").join(c, "customer_id").join(k, "contract_id")
