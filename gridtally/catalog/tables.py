"""Versioned tables: merges, appends and snapshots through them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridtally import session
from gridtally.catalog.base_sql import GOLD_CHAIN
from gridtally.catalog.merges import FACT_CHAIN, LATE, LOADED, _corrections, _fact, _reading_merge, _readings
from gridtally.catalog.readings import AS_OF, gold
from gridtally.catalog.registry import ORACLES, query, with_ctes
from gridtally.functions import times
from gridtally.operators import cdc, normalize
from gridtally.plans.distinct_counts import DistinctCounts
from gridtally.sinks.tables import Conflict, Table
from gridtally.sources import adapters


def _readings_table(spark, folder) -> tuple[Table, object]:
    """The readings the warehouse knows, loaded in two runs, and the late corrections."""
    fact = session.materialize(_fact(spark, folder), "fact")
    table = Table(spark, session.fresh_path(spark, "readings"), fact.schema, ["reading_id"])
    first = F.crc32(F.col("meter_id").cast("binary")) % 2 == 0
    for run, part in (("run-1", first), ("run-2", ~first)):
        table.append(fact.filter(part), run)
    late = _corrections(spark, folder).filter("reading_type = 'INTERVAL'")
    return table, session.materialize(late, "late")


@query(
    "table_merge",
    with_ctes([*FACT_CHAIN, LATE], """SELECT coalesce(t.reading_id, s.reading_id) AS reading_id, coalesce(t.meter_id, s.meter_id) AS meter_id,
      CASE WHEN s.reading_id IS NOT NULL THEN s.reading_value ELSE t.reading_value END AS reading_value, 'kWh' AS unit,
      coalesce(t.reading_timestamp, s.reading_timestamp) AS reading_timestamp,
      CASE WHEN t.reading_id IS NULL OR (s.reading_id IS NOT NULL AND t.reading_value IS DISTINCT FROM s.reading_value)
        THEN TIMESTAMP '2026-01-01' ELSE t.dw_created_at END AS dw_created_at
      FROM fact t FULL OUTER JOIN late s ON s.reading_id = t.reading_id"""),
)
def _(spark, folder):
    """Late corrections merged into the files that may hold their keys, twice, which changes nothing more."""
    table, late = _readings_table(spark, folder)
    for _attempt in range(2):
        table.merge(late, _reading_merge(), "late-1")
    return table.read()


@query(
    "table_versions",
    with_ctes([*FACT_CHAIN, "f AS (SELECT CAST(regexp_extract(meter_id, '([0-9]+)$', 1) AS BIGINT) % 2 = 0 AS old FROM fact)"],
        "SELECT CAST(1 AS BIGINT) AS version, count(*) FILTER (WHERE old) AS rows FROM f UNION ALL SELECT 2, count(*) FROM f"),
)
def _(spark, folder):
    """Each version of a table stays readable, also after a writer lost against another one."""
    fact = session.materialize(_fact(spark, folder), "fact")
    table = Table(spark, session.fresh_path(spark, "readings"), fact.schema, ["reading_id"])
    old = F.regexp_extract("meter_id", "([0-9]+)$", 1).cast("bigint") % 2 == 0
    table.commit(fact.filter(old), 0, "append", "run-1")
    table.commit(fact.filter(~old), 1, "append", "run-2")
    try:
        table.commit(fact, 1, "append", "too late")
    except Conflict:
        pass
    counted = [table.read(v).agg(F.lit(v).cast("bigint").alias("version"), F.count(F.lit(1)).alias("rows")) for v in (1, 2)]
    return counted[0].union(counted[1])


@query("table_insert_if_absent", ORACLES["insert_if_absent"])
def _(spark, folder):
    """Unseen readings are added as files of their own; keys are looked up in the index."""
    target = _readings(spark, folder).filter("quality_flag = 'VALID'").select(
        "reading_id", "meter_id", "reading_value", F.col("reading_timestamp").alias("read_at"),
        F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz").alias("bq_insert_timestamp"),
    )
    table = Table(spark, session.fresh_path(spark, "readings"), target.schema, ["reading_id"])
    table.append(target, "run-1")
    landed = adapters.ops_readings(spark, folder).select(F.to_json(F.struct("reading_id", "meter_id", "reading_value", "reading_timestamp")).alias("payload"))
    columns = {"reading_id": "string", "meter_id": "string", "reading_value": "double", "reading_timestamp": "timestamp_ntz"}
    source = cdc.typed(landed, columns, keep=[]).withColumnRenamed("reading_timestamp", "read_at").withColumn("bq_insert_timestamp", times.at(LOADED))
    for _attempt in range(2):
        table.insert_new(source, "read_at", "reading_value", "meter_id")
    return table.read()


@query("table_append_runs", ORACLES["fact_load_partitions"])
def _(spark, folder):
    """Two runs that share their days, one of them repeated: the table holds both once."""
    rows = gold(spark, folder).withColumn("processed_at", F.lit(AS_OF).cast("timestamp_ntz"))
    fact = session.materialize(normalize.to_reading_fact(rows), "fact")
    table = Table(
        spark, session.fresh_path(spark, "fact"), fact.schema, ["source_household_id", "reading_timestamp"],
        cluster=["reading_timestamp", "source_household_id"],
    )
    of_first = F.crc32(F.col("source_household_id").cast("binary")) % 2 == 0
    for run, part in (("run-1", of_first), ("run-2", ~of_first), ("run-1", of_first)):
        table.append(fact.filter(part), run)
    return table.read().groupBy(F.col("reading_timestamp").cast("date").alias("reading_date")).agg(
        F.count("*").alias("rows"), F.countDistinct("source_household_id").alias("households")
    )


@query("table_snapshot", with_ctes(GOLD_CHAIN, "SELECT * FROM gold"))
def _(spark, folder):
    """The newest version is the newest whole one: a run that was cut off before its version was named is not seen."""
    rows = session.materialize(gold(spark, folder), "gold")
    table = Table(spark, session.fresh_path(spark, "gold"), rows.schema, ["household_id", "event_timestamp"])
    table.append(rows.filter("stdor_to_u = 'Std'"), "run-1")
    table.append(rows, "run-1")
    rows.limit(1).write.parquet(f"{table.root}/data/cut-off")
    return table.read()




@query(
    "distinct_households",
    with_ctes(GOLD_CHAIN, """SELECT strftime(event_timestamp, '%Y-%m') AS period, count(DISTINCT household_id) AS entities FROM gold
      WHERE event_timestamp >= TIMESTAMP '2024-01-03' GROUP BY 1"""),
)
def _(spark, folder):
    """Households by month from the sets that three runs stored, not from the readings."""
    rows = session.materialize(gold(spark, folder).select("event_timestamp", "household_id"), "gold")
    stored = DistinctCounts.at(spark, session.fresh_path(spark, "distinct"), rows.schema["household_id"].dataType)
    for run in range(3):
        stored.add(rows.filter(F.pmod(F.xxhash64("household_id", "event_timestamp"), F.lit(3)) == run), "event_timestamp", "household_id", f"run-{run}")
    return stored.exact(F.date_format("day", "yyyy-MM"), low="2024-01-03")
