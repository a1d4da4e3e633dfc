"""Joins on an interval, without comparing every pair of one key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtally.operators import ordered


def valid_at(
    events: DataFrame, versions: DataFrame, key: str, moment: str, start: str, end: str, how: str = "inner",
    limit: int = ordered.ROWS_PER_BUCKET,
) -> DataFrame:
    """Each event with the version that was valid at its moment.

    ``end`` is exclusive and NULL means still valid; versions of one key do not
    overlap. Events and versions are put on one time line per key and the latest
    version is carried forward, so the work is linear in both even for a key that
    has very many of them. Only the distinct (key, moment) pairs go onto the line, so
    an instant at which very many events happen is one point there; the events then
    look their point up, a join that adaptive execution splits where it is crowded.
    A NULL key, moment or start matches nothing.
    """
    attributes = [c for c in versions.columns if c != key]
    known = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        key, F.col(start).alias("_t"), F.lit(0).alias("_kind"), F.struct(*attributes).alias("_version")
    )
    points = events.filter(F.col(key).isNotNull() & F.col(moment).isNotNull()).select(key, F.col(moment).alias("_t")).distinct()
    asked = points.select(key, "_t", F.lit(1).alias("_kind"), F.lit(None).cast(known.schema["_version"].dataType).alias("_version"))
    line = ordered.time_groups(known.unionByName(asked), [key], "_t", limit=limit)
    seen = ordered.carry_forward(line, [key], ["_t", "_kind"], "_version", "_group", "_found").filter("_kind = 1")
    open_or_later = F.col(f"_found.{end}").isNull() | (F.col("_t") < F.col(f"_found.{end}"))
    hits = seen.filter(F.col("_found").isNotNull() & open_or_later).select(F.col(key).alias("_k"), "_t", F.col("_found").alias("_hit"))
    out = events.join(hits, (F.col(key) == F.col("_k")) & (F.col(moment) == F.col("_t")), "inner" if how == "inner" else "left")
    return out.select(*[events[c] for c in events.columns], *[F.col(f"_hit.{c}").alias(c) for c in attributes])


def period_months(periods: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Distinct (key, start, end) periods, one row per calendar month they touch.

    Bills of one site often share a period, so this is bounded by the calendar
    and not by the number of bills.
    """
    distinct = periods.select(*keys, start, end).distinct().filter(F.col(start) <= F.col(end))
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    return distinct.withColumn("_month", F.explode(months))


def _covering(daily: DataFrame, periods: DataFrame, keys: list[str], start: str, end: str, how: str) -> DataFrame:
    """Daily rows with the periods that contain them, matched month by month.

    The optimizer does not see that the months multiply the period rows, so a
    sort-merge join is asked for instead of trusting its size estimate with a
    broadcast. A (site, month) has at most 31 daily rows.
    """
    cut = period_months(periods, keys, start, end).withColumnsRenamed({k: f"_p_{k}" for k in keys}).hint("merge")
    placed = daily.withColumn("_day_month", F.trunc("day", "MM"))
    on = (F.col("_day_month") == F.col("_month")) & F.col("day").between(F.col(start), F.col(end))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_p_{k}"))
    return placed.join(cut, on, how)


def usage_in_periods(
    periods: DataFrame, daily: DataFrame, keys: list[str], start: str, end: str, usage: str, total: str
) -> DataFrame:
    """Usage summed over each period of a list (both ends in), from one row per
    key and day. Periods without any usage are left out."""
    joined = _covering(daily.select(*keys, "day", usage), periods, keys, start, end, "inner")
    return joined.groupBy(*keys, start, end).agg(F.sum(usage).alias(total))


def covered_days(daily: DataFrame, periods: DataFrame, keys: list[str], start: str, end: str, flag: str) -> DataFrame:
    """Daily rows with a flag telling whether some period contains the day.

    ``daily`` has one row per key and day. The periods of a key and month are gathered
    first, of which the calendar allows few, so that a daily row meets one row at most and
    nothing is held or grouped after the join.
    """
    cut = period_months(periods, keys, start, end).groupBy(*keys, "_month").agg(F.collect_list(F.struct(F.col(start).alias("low"), F.col(end).alias("high"))).alias("_spans"))
    cut = cut.withColumnsRenamed({k: f"_p_{k}" for k in keys}).hint("merge")
    on = F.trunc("day", "MM") == F.col("_month")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_p_{k}"))
    within = F.exists("_spans", lambda s: F.col("day").between(s.low, s.high))
    return daily.join(cut, on, "left").select(*daily.columns, F.coalesce(within, F.lit(False)).alias(flag))
