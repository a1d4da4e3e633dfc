"""Lake writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridtally import schemas, session

ROWS_PER_CHUNK = 50_000


def write_raw_chunks(df: DataFrame, folder: str, run_id: str) -> str:
    """NDJSON chunks of one run and source file; rows without a meter are left out.

    Overwriting the run's own folder makes a rerun replace its earlier attempt.
    """
    path = f"{folder}/run={run_id}"
    (
        df.filter(F.col("meter_id").isNotNull())
        .write.mode("overwrite")
        .option("maxRecordsPerFile", ROWS_PER_CHUNK)
        .option("ignoreNullFields", "false")
        .json(path)
    )
    return path


def write_snapshot(df: DataFrame, root: str, run_id: str) -> str:
    """One run's Parquet snapshot (standardized or gold layer)."""
    path = f"{root}/run={run_id}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_gold(flagged: DataFrame, root: str, run_id: str) -> str | None:
    """Accepted rows without their flag columns; nothing is written for no rows, and
    what an earlier attempt of the run wrote goes."""
    accepted = flagged.filter("is_good").drop("is_complete", "is_valid", "is_unique", "is_good")
    if accepted.isEmpty():
        session.remove(flagged.sparkSession, f"{root}/run={run_id}")
        return None
    return write_snapshot(accepted, root, run_id)


def land_batch(df: DataFrame, base: str, dataset: str, run_id: str, run_date: str) -> str:
    """Raw landing below ``dataset/dt=<day>/run=<id>``, types unchanged."""
    path = f"{base}/{dataset}/dt={run_date}/run={run_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def partitioned(df: DataFrame, path: str, partition: str, by: Column, cluster: list[str], run_id: str) -> None:
    """Append ``df`` to a table split by a derived partition column, clustered inside it.

    The rebalance lets adaptive execution choose the tasks from real sizes: small
    days share one, a day that holds a large share of the rows is split over many,
    even if all its rows have one cluster key. Inside a partition each run owns a
    folder (column ``load_run``), so other runs' rows stay, and a run that is
    repeated replaces what it wrote before, also where it has no rows any more.
    """
    session.remove(df.sparkSession, f"{path}/{partition}=*/load_run={run_id}")
    (
        df.withColumn(partition, by)
        .withColumn("load_run", F.lit(run_id))
        .hint("rebalance", partition)
        .sortWithinPartitions(partition, *cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition, "load_run")
        .parquet(path)
    )


def write_reading_fact(fact: DataFrame, path: str, run_id: str) -> None:
    """Append a run's readings to the fact by day, clustered by household."""
    partitioned(fact, path, "reading_date", F.col("reading_timestamp").cast("date"), ["source_household_id"], run_id)


def write_monthly_fact(fact: DataFrame, path: str, day: str, cluster: list[str], run_id: str) -> None:
    """Append a run's bills, payments or consumption to their fact by month."""
    partitioned(fact, path, "month", F.trunc(day, "MM"), cluster, run_id)


def replace_partitions(rows: DataFrame, touched: DataFrame, path: str, partition: str) -> None:
    """Put merged rows in place of the touched partitions of a table.

    The rows may be read from that table, so they are stored first. A touched
    partition that has no rows left is removed; the driver sees the names of those.
    """
    spark = rows.sparkSession
    stored = session.materialize(rows, "merged")
    emptied = touched.select(partition).join(stored.select(partition).distinct(), partition, "left_anti").collect()
    (
        stored.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    for row in emptied:
        session.remove(spark, f"{path}/{partition}={row[0]}")


def export_entity(df: DataFrame, root: str, name: str) -> tuple[str, str]:
    """Full refresh of a master entity as Parquet and as CSV with a header."""
    parquet_path, csv_path = f"{root}/{name}/parquet", f"{root}/{name}/csv"
    df.write.mode("overwrite").option("compression", "snappy").parquet(parquet_path)
    df.write.mode("overwrite").option("header", "true").csv(csv_path)
    return parquet_path, csv_path


def write_manifest(spark: SparkSession, base: str, row: dict) -> str:
    """The one-row record of a run over one dataset."""
    path = f"{base}/_manifests/run={row['run_id']}/dataset={row['dataset']}"
    names = [part.strip().split(" ")[0] for part in schemas.RUN_MANIFEST.split(",")]
    values = [tuple(row.get(n) for n in names)]
    spark.createDataFrame(values, schemas.RUN_MANIFEST).coalesce(1).write.mode("overwrite").json(path)
    return path
