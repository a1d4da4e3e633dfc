"""Keeping one or a few rows per key.

Spark evaluates ``row_number() <= n`` filters with a limit per key *before* the
shuffle, so even a key that owns a third of the table sends at most n rows per
map task to the task that finishes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in ``order``, which must break ties."""
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], time: str, *ties: str) -> DataFrame:
    return top_per_key(df, keys, [F.desc(c) for c in (time, *ties)])


def first_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return top_per_key(df, keys, [F.asc(c) for c in order])


def first_flag(df: DataFrame, keys: list[str], row_id: list[str], flag: str) -> DataFrame:
    """Mark the first row of each key; every row is kept and NULL keys are equal.

    ``row_id`` columns identify a row and say what first means. The first row is
    found by a minimum, which combines before the shuffle, and is matched back
    on the row id, so the rows of a hot key spread over all tasks instead of
    being sorted in one.
    """
    # A single number stays in a hash aggregation; several columns compare as a struct.
    ident = F.struct(*[F.col(c).alias(f"_first_{c}") for c in row_id]) if len(row_id) > 1 else F.col(row_id[0])
    found = df.groupBy(*keys).agg(F.min(ident).alias("_first"))
    found = found.select("_first.*") if len(row_id) > 1 else found.select(F.col("_first").alias(f"_first_{row_id[0]}"))
    firsts = found.withColumn("_is_first", F.lit(True))
    same = None
    for c in row_id:
        match = df[c].eqNullSafe(firsts[f"_first_{c}"])
        same = match if same is None else same & match
    return df.join(firsts, same, "left").select(
        *[df[c] for c in df.columns], F.col("_is_first").isNotNull().alias(flag)
    )


def repeated_keys(df: DataFrame, keys: list[str], count_name: str = "record_count") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).filter(F.col(count_name) > 1)


def surplus_copies(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier row in every column."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
