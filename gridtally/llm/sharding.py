"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered from 0 in ascending order of (doc_id, checksum, size). A keyed
Feistel network permutes the numbers; where it leaves the range it is applied
again (cycle walking). The permuted number p gives shard p mod n and slot p div n,
so shard sizes differ by one row at most, and anybody who knows the seed, the row
count and the shard count can compute both, in either direction.

Everything here is a column expression or a join; the only values that reach the
driver are the row count, the counts per file partition and the walk's step count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import session

ROUNDS = 6


def _sides(rows: int) -> tuple[int, int]:
    """The smallest a x b box of numbers that holds ``rows`` of them."""
    a = max(1, int(rows**0.5))
    while a * a < rows:
        a += 1
    return a, max(1, -(-rows // a))


def _step(left: Column, right: Column, a: int, b: int, seed: int, turn: int) -> tuple[Column, Column]:
    if turn % 2 == 0:
        return F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), right), F.lit(a)), F.lit(a)), right
    return left, F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), left), F.lit(b)), F.lit(b))


def _unstep(left: Column, right: Column, a: int, b: int, seed: int, turn: int) -> tuple[Column, Column]:
    if turn % 2 == 0:
        return F.pmod(left - F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), right), F.lit(a)), F.lit(a)), right
    return left, F.pmod(right - F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), left), F.lit(b)), F.lit(b))


def _network(df: DataFrame, column: str, rows: int, seed: int, inverse: bool = False) -> DataFrame:
    """One pass of the network over ``column``, without walking.

    Each round is a column of its own, as rounds use their halves more than once.
    """
    a, b = _sides(rows)
    df = df.withColumns({"_l": F.col(column) % a, "_r": F.expr(f"{column} div {a}")})
    turns = range(ROUNDS)
    for turn in reversed(turns) if inverse else turns:
        left, right = (_unstep if inverse else _step)(F.col("_l"), F.col("_r"), a, b, seed, turn)
        df = df.withColumns({"_l": left, "_r": right})
    return df.withColumn(column, F.col("_l") + F.col("_r") * a).drop("_l", "_r")


def walk_steps(spark, rows: int, seed: int, inverse: bool = False) -> int:
    """The most further passes that any number needs to come back below ``rows``.

    A number that leaves the range lands among the less than a spare numbers of the
    box; how long each of these stays out is found by walking all of them together.
    """
    a, b = _sides(rows)
    if a * b <= rows:
        return 0
    steps, out = 1, spark.range(rows, a * b).select(F.col("id").alias("p"))
    while True:
        out = session.materialize(_network(out, "p", rows, seed, inverse).where(F.col("p") >= rows), "walk")
        if out.isEmpty():
            return steps
        steps += 1


def permute(df: DataFrame, column: str, rows: int, seed: int = 0, inverse: bool = False) -> DataFrame:
    """Replace the numbers 0..rows-1 in ``column`` by their permuted places.

    ``inverse`` leads back. Numbers outside the range must not be there.
    """
    if rows <= 0:
        return df
    df = _network(df, column, rows, seed, inverse)
    for _ in range(walk_steps(df.sparkSession, rows, seed, inverse)):
        again = _network(df.withColumn("_p", F.col(column)), "_p", rows, seed, inverse)
        df = again.withColumn(column, F.when(F.col(column) >= rows, F.col("_p")).otherwise(F.col(column))).drop("_p")
    return df


def number_rows(df: DataFrame, order: list[str], column: str = "row") -> DataFrame:
    """Number rows from 0 in ascending ``order`` (nulls first), without one big sort.

    The rows are dealt out by ranges and sorted there; a stored copy fixes that
    placement, and each partition's first number is the sum of the counts before it.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = session.materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    counts = sorted(stored.groupBy(part.alias("_part")).count().collect())  # a row per partition
    bases, total = [], 0
    for at, n in counts:
        bases.append((at, total))
        total += n
    base = spark.createDataFrame(bases, "_part long, _base long")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(base), "_part")
        .withColumn(column, F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_base", "_at")
    )


def assign(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """Shard and slot of every document: law ``rows``, counts at most one apart.

    Reads ``doc_id`` and ``text``; other columns are ignored. A null text has the
    size 16 and the checksum of no bytes; a null doc_id comes first in the order.
    Equal rows get neighbouring numbers and so unrelated shards. No rows, no result.
    """
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    numbered = number_rows(slim, ["doc_id", "text_crc32", "size"])
    rows = numbered.count()
    return permute(numbered, "row", rows, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("row") % shards).cast("int").alias("shard"),
        F.expr(f"row div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
