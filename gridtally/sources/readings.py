"""Meter reading files in their three layers: source CSV, raw NDJSON, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtally import schemas, session


def source_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Half-hourly CSV, every column as text, header names trimmed.

    Files may differ in blanks around their header names. Header lines are known by
    their content: a line that holds the trimmed names in place is left out, and one
    that starts with a header name, but holds others or another order, is an error
    instead of a silent shift of columns.
    """
    names = [name.strip() for name in spark.read.option("header", "true").csv(paths).columns]
    raw = spark.read.schema(", ".join(f"_c{i} string" for i in range(len(names)))).csv(paths)
    cells = F.array(*[F.trim(c) for c in raw.columns])
    header = F.array(*[F.lit(n) for n in names])
    begins = F.coalesce(F.array_contains(header, F.trim(raw.columns[0])), F.lit(False))
    odd = F.raise_error(F.concat(F.lit("a file's header differs: "), F.array_join(cells, ",", "")))
    data = raw.filter(F.when(~begins, True).when(cells == header, False).otherwise(odd.cast("boolean")))
    return data.toDF(*names)


def sample(df: DataFrame, rows: int, *order) -> DataFrame:
    """The first ``rows`` rows in a stated order: the bounded trial read."""
    return df.orderBy(*order).limit(rows)


def raw_run(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """All NDJSON chunks one ingestion run left below ``root``.

    The run is a partition folder, so other runs' files are never opened. Empty
    chunks hold no lines and add no rows.
    """
    df = (
        spark.read.schema(schemas.RAW_READING)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .json(f"{root}/*/run={run_id}")
    )
    return df


def raw_run_bytes(df: DataFrame) -> DataFrame:
    """Total size of the files behind a raw scan."""
    per_file = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return per_file.agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"))


def layer(spark: SparkSession, path: str | None, schema) -> DataFrame:
    """Standardized or gold Parquet of one run; no rows when the run wrote none."""
    if path is None or not session.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def with_position(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with their file and position, which together identify a row
    and give 'first' the same meaning on every run."""
    return spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.row_index").alias("source_row")
    )
