"""Which rows two tables do not share, found by exchanging sketches instead of keys.

Both sides first exchange a digest of each of ``PARTS`` parts of their rows. Rows of the
parts that differ go into an invertible Bloom lookup table: each row adds its hash to
three cells, which hold a count and two running XORs. In the difference of both tables
what both sides have cancels out; a cell with one row left names its hash, taking that
row out of its other cells uncovers more, until the cells are empty. The tables are as
large as the difference is, not as the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from gridtally import session

#: Parts whose digests are compared first.
PARTS = 4096
#: Cells a row is added to, and cells for each row expected to differ.
TIMES, SPACE = 3, 2
#: Cells of the smallest table; what more cells than ``MOST`` cannot tell is compared by keys.
LEAST, MOST = 96, 1 << 24
#: Turns of taking rows out; tables that can be decoded need about the logarithm of their cells.
TURNS = 60


def _hash(columns: list[str]) -> Column:
    """A row's hash; a missing value differs from every other."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.isnull(c) for c in columns])


def _check(h: Column) -> Column:
    return F.xxhash64(h, F.lit("check"))


def _part(h: Column) -> Column:
    return F.pmod(F.xxhash64(h, F.lit("part")), F.lit(PARTS)).cast("int")


def digests(rows: DataFrame) -> DataFrame:
    """Of rows with hash ``h``: part, n, and two XORs that change with any row."""
    h = F.col("h")
    return rows.groupBy(_part(h).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(_check(h)).alias("y"))


def _cells(rows: DataFrame, width: int) -> DataFrame:
    """Rows (h, n) at each of their cells; the cells of a row are in different thirds of the table."""
    place = lambda i: F.pmod(F.xxhash64("h", F.lit(i)), F.lit(width)) + i * width
    return rows.select("h", "n", F.explode(F.array(*[place(i) for i in range(TIMES)])).alias("cell"))


def _summed(parts: DataFrame) -> DataFrame:
    """Cells with something in them: cell, n, x, y."""
    made = parts.groupBy("cell").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    return made.filter("n != 0 OR x != 0 OR y != 0")


def sketch(rows: DataFrame, width: int) -> DataFrame:
    """The lookup table of rows with hash ``h``: cell, n, x, y."""
    at = _cells(rows.select("h", F.lit(1).cast("bigint").alias("n")), width)
    return _summed(at.select("cell", "n", F.col("h").alias("x"), _check(F.col("h")).alias("y")))


def decode(ours: DataFrame, theirs: DataFrame, width: int) -> tuple[DataFrame, bool]:
    """Hashes (h, n) that one side has more than the other, n > 0 for ours, and whether these are all."""
    spark = ours.sparkSession
    cells = session.materialize(_summed(ours.union(theirs.select("cell", (-F.col("n")).alias("n"), "x", "y"))), "cells")
    found = spark.createDataFrame([], "h bigint, n bigint")
    for _ in range(TURNS):
        pure = cells.filter((F.abs("n") == 1) & (F.col("y") == _check(F.col("x")))).select(F.col("x").alias("h"), "n").distinct()
        pure = session.materialize(pure, "pure")
        if pure.isEmpty():
            break
        found = found.union(pure)
        out = _cells(pure, width).select("cell", (-F.col("n")).alias("n"), F.col("h").alias("x"), _check(F.col("h")).alias("y"))
        cells = session.materialize(_summed(cells.union(out)), "cells")
    return found, cells.isEmpty()


def _apart(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """The same by comparing all hashes."""
    both = ours.select("h", F.lit(1).cast("bigint").alias("n")).union(theirs.select("h", F.lit(-1).cast("bigint").alias("n")))
    return both.groupBy("h").agg(F.sum("n").alias("n")).filter("n != 0")


def hashes_apart(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Hashes (h, n) of rows with hash ``h`` that one side has more often, n > 0 for ours.

    The table is laid out for the difference that the digests let expect; if it cannot be
    decoded, e.g. as one side repeats rows, it is made larger, and beyond ``MOST`` cells
    the hashes of the differing parts are compared one by one.
    """
    left, right = (session.materialize(digests(side), "digests") for side in (ours, theirs))
    other = right.select("part", F.col("n").alias("_n"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("x").eqNullSafe(F.col("_x")) & F.col("y").eqNullSafe(F.col("_y"))
    differ = session.materialize(left.join(other, "part", "full_outer").filter(~same).select("part"), "parts")
    parts = differ.count()  # at most PARTS
    if not parts:
        return ours.limit(0).select("h", F.lit(0).cast("bigint").alias("n"))
    expected = -PARTS * math.log1p(-min(parts, PARTS - 1) / PARTS)
    width = max(LEAST, math.ceil(SPACE * expected)) // TIMES + 1
    of_parts = lambda side: side.withColumn("part", _part(F.col("h"))).join(differ, "part", "left_semi").select("h")
    while TIMES * width <= MOST:
        found, all_of_it = decode(*(session.materialize(sketch(of_parts(side), width), "sketch") for side in (ours, theirs)), width)
        if all_of_it:
            return found
        width *= 4
    return _apart(of_parts(ours), of_parts(theirs))


def between(source: DataFrame, target: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """Keys of rows that source and target do not share: the keys and ``state``.

    missing   in the source only
    surplus   in the target only
    changed   in both, with different ``values``
    """
    columns = [*keys, *(values or [])]
    ours, theirs = (side.select(*keys, _hash(columns).alias("h")) for side in (source, target))
    apart = session.materialize(hashes_apart(ours.select("h"), theirs.select("h")), "apart")
    # the few keys that belong to these hashes are looked up on their side
    named = [
        side.join(apart.filter(F.col("n") * sign > 0).select("h"), "h", "left_semi").select(*keys, F.lit(state).alias("state"))
        for side, sign, state in ((ours, 1, "missing"), (theirs, -1, "surplus"))
    ]
    states = named[0].union(named[1]).groupBy(*keys).agg(F.min("state").alias("_low"), F.max("state").alias("_high"))
    return states.select(*keys, F.when(F.col("_low") != F.col("_high"), F.lit("changed")).otherwise(F.col("_low")).alias("state"))
