"""What the training-data operators share: table reading, Arrow batches, byte-sized slices."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

import gridtally
from gridtally import session

#: Rows of one Arrow batch. Texts may be long, so a batch holds few of them.
ARROW_ROWS = 500
#: Bytes of text that one numpy step works on.
SLICE_BYTES = 4 << 20
#: Letters up to which the driver keeps a plan's text.
PLAN_LETTERS = 20_000


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors, which run parts of it, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(gridtally.__file__).parent
    # the driver serves this file as long as the application lives
    folder = tempfile.mkdtemp(prefix="gridtally-code-")
    context.addPyFile(shutil.make_archive(f"{folder}/gridtally", "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for operators that hand texts to Python tasks."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    # the driver keeps the text of each plan it ran, and iterative operators run many long ones
    spark.conf.set("spark.sql.maxPlanStringLength", str(PLAN_LETTERS))
    return session.configure(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to ``limit`` at most, or of one item."""
    low, total = 0, 0
    for at, size in enumerate(sizes):
        if at > low and total + size > limit:
            yield low, at
            low, total = at, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def beside_text(docs: DataFrame, keep: tuple) -> tuple[DataFrame, str]:
    """The kept columns and the text, sent once, and the text column's name."""
    if "text" in keep:
        return docs.select(*keep), "text"
    return docs.select(*keep, F.col("text").alias("_text")), "_text"


def over_batches(
    df: DataFrame, schema, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch]
) -> DataFrame:
    """``work`` on each Arrow batch of ``df``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                made = work(batch)
                if isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made

    return df.mapInArrow(run, schema)


#: Bytes up to which the smaller side of a join with texts is broadcast.
BROADCAST_BYTES = 64 << 20
#: Bytes that a row, or an element of an array in it, takes at most besides its letters.
SLOT_BYTES = 40


def _bytes_of(df: DataFrame) -> int:
    """A bound of the bytes that all rows take: slim columns, arrays of numbers or pairs of them, texts."""
    size = F.lit(SLOT_BYTES)
    for field in df.schema.fields:
        if isinstance(field.dataType, ArrayType):
            size = size + SLOT_BYTES * F.coalesce(F.size(field.name), F.lit(0))
        elif isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            size = size + 16
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def looked_up(df: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join that leaves ``df`` in place when the bytes of ``small``, a stored table, are counted to be few.

    Otherwise both sides are shuffled, and adaptive execution splits hot keys.
    """
    side = F.broadcast(small) if _bytes_of(small) <= BROADCAST_BYTES else small
    return df.join(side, on, how)


def set_aside(df: DataFrame, taken: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns renamed whose names an operator uses itself, and how to name them back."""
    used = {c.lower() for c in df.columns} | {t.lower() for t in taken}
    back = {}
    for column in df.columns:
        if column.lower() in {t.lower() for t in taken}:
            n = next(n for n in range(len(used) + 1) if f"aside{n}" not in used)
            used.add(f"aside{n}")
            back[f"aside{n}"] = column
    return df.withColumnsRenamed({old: new for new, old in back.items()}), back


def numbered_copy(df: DataFrame, label: str) -> DataFrame:
    """A stored copy of ``df`` with a column ``_row``: numbers that stay with their rows."""
    path = session.fresh_path(df.sparkSession, label)
    stored = df.withColumn("_row", F.monotonically_increasing_id())
    stored.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(stored.schema).parquet(path)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd ``base`` modulo 2^64 from 0 on, and their inverses."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < size:
        n = max(size, 1 << 18)
        held = tuple(
            np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64), dtype=np.uint64)))
            for b in (base, pow(base, -1, 1 << 64))
        )
        _POWERS[base] = held
    return held[0][:size], held[1][:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def run_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of the runs values[begin:end], from running sums."""
    up, down = powers(base, len(values) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values.astype(np.uint64) * up[: len(values)], dtype=np.uint64)))
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def spans_of(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True."""
    edge = np.concatenate(([False], inside, [False]))
    turn = np.flatnonzero(edge[1:] != edge[:-1])
    return turn[::2], turn[1::2]


def remainder(column: str, divisor: int):
    """crc32 of the id written as text, modulo ``divisor``: which rows are held out."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor
