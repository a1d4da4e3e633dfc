"""Readings from source text to served aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtally import session
from gridtally.catalog.base_sql import GOLD_CHAIN, READINGS
from gridtally.catalog.registry import query, with_ctes
from gridtally.operators import dedup, normalize, quality, reconcile
from gridtally.plans import analytics, warehouse
from gridtally.sources import adapters, readings as reading_files

AS_OF = "2026-01-01 00:00:00"
GOLD_COLUMNS = [
    "meter_id", "household_id", "event_timestamp", "consumption_kwh", "stdor_to_u", "source_system", "reading_no"
]


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    return quality.flag_readings(adapters.readings(spark, folder), ["reading_no"])


def gold(spark: SparkSession, folder: str) -> DataFrame:
    return quality.accepted(adapters.readings(spark, folder), ["reading_no"]).select(*GOLD_COLUMNS)


SOURCE_SQL = """source_rows AS (
  SELECT event_id, event_type, value, user_id, ts,
    NOT (event_type = 'signup' AND value > 50) AND NOT (event_type = 'purchase' AND value > 80) AS ok
  FROM events)"""

NORMALIZED_SQL = """
  SELECT 'METER-' || printf('%06d', user_id) AS meter_id, 'MAC' || printf('%06d', user_id) AS household_id,
    CASE WHEN NOT (event_type = 'click' AND value > 80)
      THEN strftime(time_bucket(INTERVAL '30 minutes', ts), '%Y-%m-%dT%H:%M:%S') END AS event_timestamp,
    CASE WHEN event_type <> 'error' THEN value END AS consumption_kwh,
    CASE WHEN event_type IN ('view', 'click') THEN 'Std' WHEN event_type IN ('purchase', 'signup') THEN 'ToU' ELSE '' END AS "stdorToU",
    'uk_power_networks' AS source_system
  FROM source_rows WHERE ok"""


@query("normalize_source_rows", with_ctes([SOURCE_SQL], NORMALIZED_SQL))
def _(spark, folder):
    return normalize.accepted(normalize.normalize_source(adapters.source_rows(spark, folder)))


@query(
    "normalize_rejects",
    """SELECT CASE WHEN event_type = 'signup' THEN 'no household' ELSE 'value is no number' END AS reject_reason, count(*) AS rows
       FROM events WHERE (event_type = 'signup' AND value > 50) OR (event_type = 'purchase' AND value > 80) GROUP BY 1""",
)
def _(spark, folder):
    rows = normalize.normalize_source(adapters.source_rows(spark, folder))
    return rows.filter(F.col("reject_reason").isNotNull()).groupBy("reject_reason").agg(F.count("*").alias("rows"))


@query(
    "source_scan_counts",
    with_ctes([SOURCE_SQL], """SELECT count(*) AS rows_read, count(*) FILTER (WHERE ok) AS rows_valid,
      count(*) FILTER (WHERE NOT ok) AS rows_invalid FROM source_rows"""),
)
def _(spark, folder):
    return normalize.scan_counts(normalize.normalize_source(adapters.source_rows(spark, folder)))


def standardized(spark: SparkSession, folder: str, null_as_zero: bool) -> DataFrame:
    raw = normalize.accepted(normalize.normalize_source(adapters.source_rows(spark, folder), null_as_zero))
    return normalize.standardize(raw, "ing-1", "std-1", AS_OF, null_as_zero)


def _standardized_sql(kwh: str) -> str:
    return with_ctes([SOURCE_SQL, f"n AS ({NORMALIZED_SQL})"], f"""
      SELECT meter_id, household_id, CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, {kwh} AS consumption_kwh,
        "stdorToU" AS stdor_to_u, source_system, TIMESTAMP '2026-01-01' AS processed_at,
        'ing-1' AS ingestion_run_id, 'std-1' AS standardize_run_id FROM n""")


@query("standardize_readings", _standardized_sql("consumption_kwh"))
def _(spark, folder):
    return standardized(spark, folder, False)


@query("standardize_readings_zero_fill", _standardized_sql("coalesce(consumption_kwh, 0.0)"))
def _(spark, folder):
    return standardized(spark, folder, True)


@query(
    "reading_fact_columns",
    with_ctes([SOURCE_SQL, f"n AS ({NORMALIZED_SQL})"], """
      SELECT household_id AS source_household_id, meter_id, CAST(event_timestamp AS TIMESTAMP) AS reading_timestamp,
        consumption_kwh, "stdorToU" AS stdor_to_u, source_system, TIMESTAMP '2026-01-01' AS ingestion_date,
        'ing-1' AS ingestion_run_id, 'std-1' AS standardize_run_id FROM n"""),
)
def _(spark, folder):
    return normalize.to_reading_fact(standardized(spark, folder, False))


@query("sample_read", with_ctes([READINGS], "SELECT reading_no, household_id, consumption_kwh FROM readings ORDER BY reading_no LIMIT 100"))
def _(spark, folder):
    rows = adapters.readings(spark, folder).select("reading_no", "household_id", "consumption_kwh")
    return reading_files.sample(rows, 100, "reading_no")


@query(
    "union_batches",
    """SELECT event_id AS reading_no, value AS consumption_kwh, 'Std' AS stdor_to_u FROM events WHERE event_type IN ('view', 'click')
       UNION ALL SELECT event_id, value, NULL FROM events WHERE event_type NOT IN ('view', 'click')""",
)
def _(spark, folder):
    events = adapters.table(spark, folder, "events")
    standard = F.col("event_type").isin("view", "click")
    base = [F.col("event_id").alias("reading_no"), F.col("value").alias("consumption_kwh")]
    first = events.filter(standard).select(*base, F.lit("Std").alias("stdor_to_u"))
    return normalize.union_batches(first, events.filter(~standard).select(*base))


@query(
    "gold_tariff_breakdown",
    with_ctes(GOLD_CHAIN, """SELECT stdor_to_u AS tariff_code, count(DISTINCT household_id) AS household_count,
      count(consumption_kwh) AS total_readings, CAST(sum(CAST(consumption_kwh AS DECIMAL(18,4))) AS DOUBLE) AS total_consumption_kwh
      FROM gold WHERE stdor_to_u IS NOT NULL GROUP BY 1"""),
)
def _(spark, folder):
    return analytics.tariff_breakdown(gold(spark, folder))


@query("gold_readings", with_ctes(GOLD_CHAIN, "SELECT * FROM gold"))
def _(spark, folder):
    return gold(spark, folder)


@query(
    "gold_stats",
    with_ctes(GOLD_CHAIN, """SELECT count(*) AS total_rows, count(DISTINCT household_id) AS distinct_households,
      CAST(round(sum(CAST(consumption_kwh AS DECIMAL(18,4))), 2) AS DOUBLE) AS total_consumption_kwh,
      min(event_timestamp) AS from_ts, max(event_timestamp) AS to_ts FROM gold"""),
)
def _(spark, folder):
    return analytics.gold_stats(gold(spark, folder))


@query(
    "dataset_summary",
    with_ctes(GOLD_CHAIN, """SELECT count(*) AS total_rows, count(DISTINCT household_id) AS distinct_households,
      CAST(sum(CAST(consumption_kwh AS DECIMAL(18,4))) AS DOUBLE) AS total_consumption_kwh,
      count(*) FILTER (WHERE stdor_to_u = 'Std') AS tariff_std_count, count(*) FILTER (WHERE stdor_to_u = 'ToU') AS tariff_tou_count,
      min(event_timestamp) AS from_ts, max(event_timestamp) AS to_ts FROM gold"""),
)
def _(spark, folder):
    return analytics.snapshot_summary(gold(spark, folder))


@query("tariff_counts", with_ctes(GOLD_CHAIN, "SELECT stdor_to_u, count(*) AS readings FROM gold WHERE stdor_to_u IS NOT NULL GROUP BY 1"))
def _(spark, folder):
    return analytics.tariff_counts(gold(spark, folder))


@query(
    "tariff_distribution_pct",
    with_ctes([READINGS], """SELECT stdor_to_u, count(*) AS readings,
      round(count(*) * 100.0 / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM readings WHERE stdor_to_u IS NOT NULL GROUP BY 1"""),
)
def _(spark, folder):
    return analytics.tariff_distribution(adapters.readings(spark, folder))


@query(
    "daily_consumption_30",
    with_ctes(GOLD_CHAIN, """SELECT CAST(event_timestamp AS DATE) AS day, CAST(sum(CAST(consumption_kwh AS DECIMAL(18,4))) AS DOUBLE) AS consumption
      FROM gold WHERE event_timestamp IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 30"""),
)
def _(spark, folder):
    return analytics.recent_days(gold(spark, folder), 30)


@query(
    "daily_series",
    with_ctes(GOLD_CHAIN, """SELECT CAST(event_timestamp AS DATE) AS day, CAST(sum(CAST(consumption_kwh AS DECIMAL(18,4))) AS DOUBLE) AS total_kwh,
      count(consumption_kwh) AS reading_count FROM gold WHERE event_timestamp IS NOT NULL GROUP BY 1"""),
)
def _(spark, folder):
    return analytics.daily_series(gold(spark, folder))


@query(
    "household_top10",
    with_ctes(GOLD_CHAIN, """SELECT household_id AS source_household_id, CAST(sum(CAST(consumption_kwh AS DECIMAL(18,4))) AS DOUBLE) AS total_consumption,
      count(consumption_kwh) AS reading_count FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
)
def _(spark, folder):
    return analytics.top_households(gold(spark, folder), 10)


@query(
    "zone_profile",
    """SELECT CAST(1 AS BIGINT) AS files, 6 AS column_count, count(*) AS row_count, min(ts) AS min_ts, max(ts) AS max_ts,
       count(DISTINCT user_id) AS distinct_ids, min(value) AS min_value, max(value) AS max_value FROM events""",
)
def _(spark, folder):
    return analytics.zone_profile(adapters.table(spark, folder, "events"), "ts", "user_id", "value")


@query(
    "latest_n_readings",
    with_ctes([READINGS], """SELECT meter_id, reading_no, event_timestamp, consumption_kwh FROM (
      SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY event_timestamp DESC NULLS LAST, reading_no DESC) AS rn FROM readings)
      WHERE rn <= 5"""),
)
def _(spark, folder):
    rows = adapters.readings(spark, folder).select("meter_id", "reading_no", "event_timestamp", "consumption_kwh")
    return dedup.top_per_key(rows, ["meter_id"], [F.desc("event_timestamp"), F.desc("reading_no")], 5)


FIRST_SQL = """homes AS (
  SELECT household_id, stdor_to_u FROM (
    SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY reading_no) AS rn FROM gold) WHERE rn = 1)"""
HOME_CHAIN = [*GOLD_CHAIN, FIRST_SQL]


def homes(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.households(gold(spark, folder), "reading_no")


@query("first_per_household", with_ctes(HOME_CHAIN, "SELECT * FROM homes"))
def _(spark, folder):
    return homes(spark, folder)


MASTER_SQL = {
    "customer": """SELECT replace(household_id, 'MAC', 'CUS-') AS id, 'ACTIVE' AS status, TIMESTAMP '2010-01-01' AS created_at FROM homes""",
    "account": """SELECT replace(household_id, 'MAC', 'ACC-') AS id, replace(household_id, 'MAC', 'CUS-') AS customer_id,
      'ACTIVE' AS status, TIMESTAMP '2010-01-15' AS opened_at, 'GBP' AS currency FROM homes""",
    "service_point": """SELECT replace(household_id, 'MAC', 'SP-') AS id, 'REGION-LONDON' AS region_code, 'ACTIVE' AS status FROM homes""",
    "contract": """SELECT replace(household_id, 'MAC', 'CTR-') AS id, replace(household_id, 'MAC', 'ACC-') AS account_id,
      replace(household_id, 'MAC', 'SP-') AS service_point_id, 'ACTIVE' AS status, TIMESTAMP '2010-01-20' AS contract_start,
      CAST(NULL AS TIMESTAMP) AS contract_end FROM homes""",
    "meter": """SELECT replace(household_id, 'MAC', 'METER-') AS id, household_id AS source_household_id,
      replace(household_id, 'MAC', 'SP-') AS service_point_id, stdor_to_u AS tariff_code, 'SMART_ELECTRICITY' AS meter_type,
      TIMESTAMP '2010-02-01' AS installation_date, 'ACTIVE' AS status FROM homes""",
}


def _register_master(entity: str) -> None:
    @query(f"master_{entity}", with_ctes(HOME_CHAIN, MASTER_SQL[entity]))
    def _(spark, folder):
        return warehouse.master_data(homes(spark, folder))[entity]


for _entity in MASTER_SQL:
    _register_master(_entity)


@query(
    "master_mapping",
    with_ctes(HOME_CHAIN, """SELECT household_id AS source_household_id, replace(household_id, 'MAC', 'METER-') AS meter_id,
      replace(household_id, 'MAC', 'SP-') AS service_point_id, replace(household_id, 'MAC', 'CTR-') AS contract_id,
      replace(household_id, 'MAC', 'ACC-') AS account_id, replace(household_id, 'MAC', 'CUS-') AS customer_id,
      stdor_to_u AS tariff_code FROM homes"""),
)
def _(spark, folder):
    # the mapping joins five entities, all made of the households
    return warehouse.master_mapping(warehouse.master_data(session.materialize(homes(spark, folder), "households")))


@query(
    "master_coverage",
    with_ctes(GOLD_CHAIN, """SELECT count(DISTINCT household_id) AS households, count(DISTINCT household_id) AS mapped, true AS complete FROM gold"""),
)
def _(spark, folder):
    readings = gold(spark, folder)
    found = session.materialize(warehouse.households(readings, "reading_no"), "households")
    mapped = warehouse.master_mapping(warehouse.master_data(found))
    return readings.agg(
        F.countDistinct("household_id").alias("households"),
        mapped.agg(F.count("*")).scalar().alias("mapped"),
    ).withColumn("complete", F.col("households") == F.col("mapped"))


@query(
    "meter_with_service_point",
    with_ctes(HOME_CHAIN, """SELECT replace(household_id, 'MAC', 'METER-') AS id, replace(household_id, 'MAC', 'SP-') AS service_point_id,
      'REGION-LONDON' AS region_code, 'ACTIVE' AS point_status FROM homes"""),
)
def _(spark, folder):
    master = warehouse.master_data(homes(spark, folder))
    nested = warehouse.meter_with_service_point(master["meter"], master["service_point"])
    return nested.select(
        "id", F.col("service_point.id").alias("service_point_id"), "service_point.region_code", F.col("service_point.status").alias("point_status")
    )


@query(
    "dim_tariff",
    with_ctes([READINGS], """SELECT DISTINCT CASE stdor_to_u WHEN 'Std' THEN 'UKPN-STD' WHEN 'ToU' THEN 'UKPN-TOU' END AS tariff_key,
      stdor_to_u AS source_tariff_code,
      CASE stdor_to_u WHEN 'Std' THEN 'Standard Tariff (Flat Rate)' WHEN 'ToU' THEN 'Time of Use Tariff (Variable Rate)' END AS tariff_description,
      'uk_power_networks' AS source_system, TIMESTAMP '2010-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
      FROM readings WHERE stdor_to_u IS NOT NULL"""),
)
def _(spark, folder):
    return warehouse.dim_tariff(adapters.readings(spark, folder), normalize.READING_SOURCE)


@query(
    "dim_meter_span",
    with_ctes(GOLD_CHAIN, """SELECT meter_id, household_id AS source_household_id, min(event_timestamp) AS first_reading_date,
      max(event_timestamp) AS last_reading_date FROM gold GROUP BY ALL"""),
)
def _(spark, folder):
    return warehouse.dim_meter_span(gold(spark, folder))


@query(
    "stage_reconciliation",
    with_ctes(GOLD_CHAIN, """SELECT 'source' AS stage, CASE WHEN event_type IN ('view', 'click') THEN 'Std'
        WHEN event_type IN ('purchase', 'signup') THEN 'ToU' END AS category, count(*) AS rows FROM events GROUP BY 1, 2
      UNION ALL SELECT 'standardized', stdor_to_u, count(*) FROM readings GROUP BY 1, 2
      UNION ALL SELECT 'gold', stdor_to_u, count(*) FROM gold GROUP BY 1, 2"""),
)
def _(spark, folder):
    source = adapters.source_rows(spark, folder).withColumn("tariff", F.when(F.col("stdorToU") != "", F.col("stdorToU")))
    return reconcile.stage_counts(
        {
            "source": (source, "tariff"),
            "standardized": (adapters.readings(spark, folder), "stdor_to_u"),
            "gold": (gold(spark, folder), "stdor_to_u"),
        }
    )
