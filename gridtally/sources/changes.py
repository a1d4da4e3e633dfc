"""Change files and the notifications that announce them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtally.sources import files


def _text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of exactly these files; a file that cannot be read to its end is an error."""
    plain = [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]  # names are no patterns
    return spark.read.option("ignoreCorruptFiles", "false").schema("value string").text(plain)


def change_lines(spark: SparkSession, path: str, without: list[str] | None = None) -> DataFrame:
    """One row per non-blank line of the change files (gzip is read as is).

    A file that cannot be read to its end is an error; ``unreadable`` finds such files,
    and ``without`` leaves out the paths it gave.
    """
    if without:
        whole = files.listing(spark, path).select("path").collect()
        lines = _text(spark, [r["path"] for r in whole if r["path"] not in set(without)])
    else:
        lines = spark.read.option("ignoreCorruptFiles", "false").text(path)
    return lines.filter(F.trim("value") != "")


def broken(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of some files that cannot be read to their end, found by halving."""
    if not paths:
        return []
    try:
        _text(spark, paths).agg(F.sum(F.length("value"))).collect()
        return []
    except Exception:
        if len(paths) == 1:
            return paths
        half = len(paths) // 2
        return broken(spark, paths[:half]) + broken(spark, paths[half:])


def unreadable(spark: SparkSession, path: str) -> DataFrame:
    """Change files that hold bytes, but cannot be read to their end: path, bytes."""
    landed = files.listing(spark, path).filter("bytes > 0").select("path", "bytes").collect()
    bad = set(broken(spark, [r["path"] for r in landed]))
    return spark.createDataFrame([tuple(r) for r in landed if r["path"] in bad], "path string, bytes long")


def change_file_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Paths of change files as an unbounded source that picks up new files; no content is read."""
    shape = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(shape).option("maxFilesPerTrigger", files_per_batch).load(path).select("path")


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Non-blank lines of some change files, each with its file."""
    lines = _text(spark, paths) if paths else spark.createDataFrame([], "value string").withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    # _metadata names files as URIs, a listing as they are
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return lines.select("value", file.alias("source_file")).filter(F.trim("value") != "")


def notified_paths(messages: DataFrame, body: str = "value") -> DataFrame:
    """Object path of each file notification; incomplete messages are dropped."""
    bucket = F.get_json_object(body, "$.bucket")
    name = F.get_json_object(body, "$.name")
    complete = (F.coalesce(bucket, F.lit("")) != "") & (F.coalesce(name, F.lit("")) != "")
    return messages.filter(complete).withColumn("path", F.concat(F.lit("gs://"), bucket, F.lit("/"), name)).drop(body)


def notification_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Notification messages, one JSON object a line, as an unbounded source."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def located(paths: DataFrame, stores: dict[str, str]) -> DataFrame:
    """Paths whose beginning ``stores`` names are moved to where it says, e.g. a bucket to its mount."""
    path = F.col("path")
    moved = path
    for begin, place in stores.items():
        moved = F.when(path.startswith(begin), F.concat(F.lit(place), F.substring(path, len(begin) + 1, 1 << 20))).otherwise(moved)
    return paths.withColumn("path", moved)
