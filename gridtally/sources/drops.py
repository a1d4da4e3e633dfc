"""Files dropped by billing and payment systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtally.functions import times
from gridtally.sources import files

INCREMENTAL, BACKFILL = "INCREMENTAL", "BACKFILL"


def new_files(spark: SparkSession, folder: str, manifest: DataFrame, pattern: str) -> list[str]:
    """Paths no earlier load has recorded. Names only; file contents stay put."""
    fresh = files.unprocessed(files.listing(spark, folder, pattern), manifest)
    return sorted(r["path"] for r in fresh.select("path").collect())


def load(spark: SparkSession, paths: list[str], kind: str, schema, loaded_at: str, load_type: str = INCREMENTAL) -> DataFrame:
    """Rows of the given Parquet or CSV files with where and how they came in."""
    reader = spark.read.schema(schema)
    if kind == "csv":
        reader = reader.option("header", "true")
    rows = reader.format(kind).load(paths) if paths else spark.createDataFrame([], schema).select("*", F.struct(F.lit("").alias("file_path")).alias("_metadata"))
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file_path"),
        F.lit(load_type).alias("_load_type"),
        times.at(loaded_at).alias("_ingested_at"),
    ).drop("_metadata")
