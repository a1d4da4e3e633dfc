"""File-level questions answered by Spark's listing, without reading contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtally import session


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """One row per file below ``root``: path, modified_at, bytes.

    The binary-file source reads no content when only these columns are used.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes"))
    )


def choose_files(names: list[str], wanted: list[str]) -> list[str]:
    """Files picked by 1-based position, or every file for ``all``.

    Entries that are no number or point outside the list are ignored; a request
    without any usable number selects every file.
    """
    if "all" in wanted:
        return list(names)
    positions = [int(w) for w in wanted if w.strip().lstrip("-").isdigit()]
    if not positions:
        return list(names)
    return [names[p - 1] for p in positions if 1 <= p <= len(names)]


def latest_snapshot_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest whole snapshot below ``root``, or None if there is none.

    A snapshot is one folder of part files; its age is that of its newest file. It is
    whole once its writer has put ``_SUCCESS`` beside them. The driver looks at folders,
    newest first, until one is whole.
    """
    files = listing(spark, root, "*.parquet").withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
    newest = files.groupBy("folder").agg(F.max("modified_at").alias("modified_at")).orderBy(F.desc("modified_at"), F.desc("folder"))
    for row in newest.toLocalIterator():
        if session.exists(spark, f"{row['folder']}/_SUCCESS"):
            return row["folder"]
    return None


def latest_snapshot(spark: SparkSession, root: str, schema) -> DataFrame:
    """Rows of the newest snapshot; an empty frame when none was written."""
    path = latest_snapshot_path(spark, root)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def unprocessed(files: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Files that no earlier load has recorded."""
    return files.join(manifest.select(key).distinct(), key, "left_anti")
