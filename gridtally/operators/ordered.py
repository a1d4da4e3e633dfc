"""Questions about a row's neighbours in time, without sorting a whole key in one task.

Rows are ordered inside (key, bucket) groups, where the bucket is a monotone image
of the first order column. Only one summary row per bucket is then compared across
buckets. The result equals the same window over the whole key, whatever the bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from gridtally import session

ROWS_PER_BUCKET = 1_000_000


def time_groups(df: DataFrame, keys: list[str], moment: str, name: str = "_group", limit: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add a group of keys and bucket: the month, or slices of it where a key is crowded.

    A (key, month) with more than ``limit`` rows is cut at quantiles of its rows, so
    slices hold about equally many rows however these are spread over the month; only
    rows of one instant stay together. Usually one cheap count finds no crowded group
    and nothing more is done.
    """
    month = F.trunc(F.col(moment).cast("date"), "MM")
    sizes = df.groupBy(*keys, month.alias("_m")).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit)
    most = sizes.agg(F.max("_rows")).first()[0]
    if most is None:
        return df.select("*", F.struct(*keys, month.alias("month"), F.lit(0).cast("bigint").alias("slice")).alias(name))
    slices = min(1000, -(-most // limit))
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(moment).cast("timestamp_ntz"))
    same = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys]
    crowded = sizes.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_m")
    inside = df.join(crowded, reduce(lambda a, b: a & b, same, month.eqNullSafe(F.col("_m"))), "left_semi")
    cuts = inside.groupBy(*[F.col(k).alias(f"_c_{k}") for k in keys], month.alias("_m")).agg(
        F.percentile_approx(at, [i / slices for i in range(1, slices)] or [0.5], F.lit(10 * slices)).alias("_cuts")
    )
    joined = df.join(cuts, reduce(lambda a, b: a & b, same, month.eqNullSafe(F.col("_m"))), "left")
    slice_no = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= at)).cast("bigint"), F.lit(0))
    slice_no = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(slice_no).cast("bigint")
    return joined.select(*df.columns, F.struct(*keys, month.alias("month"), slice_no.alias("slice")).alias(name))


def _join_back(rows: DataFrame, summary: DataFrame, group: str, *wanted: str) -> DataFrame:
    """Rows with their group's summary. The group is never NULL, so the join is a
    plain equality and keeps the placement the window already asked for."""
    return rows.join(summary.select(F.col(group).alias("_e"), *wanted), F.col(group) == F.col("_e"), "inner")


def with_neighbours(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], group: str,
    previous: str | None = None, following: str | None = None,
) -> DataFrame:
    """Add struct columns holding ``values`` of the previous / following row.

    ``group`` names a column made of the keys and a bucket. It stays in the result,
    whose rows are still placed by it: a second question costs no second shuffle.
    """
    at = F.struct(*[F.col(c) for c in order]).alias("at")
    picked = F.struct(*[F.col(c) for c in values])
    edge = F.struct(at, picked.alias("row"))
    edges = df.groupBy(*keys, group).agg(F.max(edge).alias("_last"), F.min(edge).alias("_first"))
    across = Window.partitionBy(*keys).orderBy(group)
    edges = edges.select(
        group, F.lag("_last.row").over(across).alias("_before"), F.lead("_first.row").over(across).alias("_after")
    )

    inside = Window.partitionBy(group).orderBy(*order)
    rows = df
    if previous:
        rows = rows.withColumn("_prev", F.lag(picked).over(inside))
    if following:
        rows = rows.withColumn("_next", F.lead(picked).over(inside))
    out = _join_back(rows, edges, group, "_before", "_after")
    columns = [F.col(c) for c in df.columns]
    if previous:
        columns.append(F.coalesce("_prev", "_before").alias(previous))
    if following:
        columns.append(F.coalesce("_next", "_after").alias(following))
    return out.select(*columns)


def carry_forward(df: DataFrame, keys: list[str], order: list[str], value: str, group: str, name: str) -> DataFrame:
    """Add the latest ``value`` that is not NULL at or before each row of its key."""
    inside = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("_here", F.last(value, ignorenulls=True).over(inside))
    at = F.struct(*[F.col(c) for c in order])
    ends = df.groupBy(*keys, group).agg(F.max_by(value, F.when(F.col(value).isNotNull(), at)).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(group, F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    out = _join_back(rows, ends, group, "_carried")
    return out.select(*df.columns, F.coalesce("_here", "_carried").alias(name))


def sequence_gaps(df: DataFrame, number: str) -> DataFrame:
    """Runs of missing numbers: first missing, last missing, how many.

    The numbers are dealt out by sampled ranges, which hold about equally many of them
    even if a few stray far off, and a stored copy fixes that placement. The one
    sequence that spans everything is compared over one summary row per range.
    """
    distinct = df.filter(F.col(number).isNotNull()).select(F.col(number).alias("_n")).distinct()
    placed = session.materialize(distinct.repartitionByRange("_n").withColumn("_block", F.spark_partition_id()), "numbers")
    pairs = with_neighbours(placed, [], ["_n"], ["_n"], "_block", following="_then")
    return pairs.filter(F.col("_then._n") > F.col("_n") + 1).select(
        (F.col("_n") + 1).alias("gap_start"),
        (F.col("_then._n") - 1).alias("gap_end"),
        (F.col("_then._n") - F.col("_n") - 1).alias("missing"),
    )
