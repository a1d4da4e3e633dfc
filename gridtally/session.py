"""Session helpers: settings the plans rely on and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings that keep plans sound when one key holds a large share of the rows:
# AQE splits oversized join partitions and merges small ones after a shuffle.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session."""
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session that runs in a single process, such as a test's, may do without the
    setting: it gets a temporary folder. On a cluster that would lose data.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local") or "cluster" in spark.conf.get("spark.master", ""):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = spark.sparkContext.applicationId
    if own not in _OF_SINGLE_PROCESS:
        _OF_SINGLE_PROCESS[own] = tempfile.mkdtemp(prefix="gridtally-")
    return _OF_SINGLE_PROCESS[own]


_OF_SINGLE_PROCESS: dict[str, str] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/gridtally/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Delete what this application stored in the shared folder. Call it when no result
    is needed any more: frames read their stored parts when they are evaluated."""
    remove(spark, _own_dir(spark))


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isDirectory()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is directly in a folder, in order; none if it is not there."""
    fs, where = _file_system(spark, folder)
    return sorted(found.getPath().getName() for found in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small file."""
    fs, where = _file_system(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write one small file unless it is there, and say whether that was done.

    The file is written aside and renamed without overwriting, so nobody sees half of it
    and of several writers one succeeds.
    """
    jvm = spark._jvm
    fs, target = _file_system(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.new")
    fs.mkdirs(target.getParent())
    out = fs.create(aside, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(target), keep)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    finally:
        fs.delete(aside, False)
    return True


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, 0 if it is not there."""
    fs, where = _file_system(spark, path)
    return fs.getFileStatus(where).getLen() if fs.exists(where) else 0


def remove(spark: SparkSession, pattern: str) -> None:
    """Delete the files and folders that a path or glob names, if there are any."""
    fs, where = _file_system(spark, pattern)
    for found in fs.globStatus(where) or []:
        fs.delete(found.getPath(), True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    The copy survives lost executors, and its file size gives Catalyst a real
    statistic for choosing join strategies.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
