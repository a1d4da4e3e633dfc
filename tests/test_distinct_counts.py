"""Stored distinct counts against the base rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridtally import session
from gridtally.plans.distinct_counts import ERROR, DistinctCounts

START = dt.datetime(2024, 1, 20)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = [(START + dt.timedelta(days=rng.randrange(20), hours=rng.randrange(24)), f"h{min(rng.randrange(3000), rng.randrange(3000))}") for _ in range(9000)]
    return made + [(None, "h1"), (START, None)] + [(START, "hot")] * 3000


@pytest.fixture(scope="module")
def counts(spark, rows):
    stored = DistinctCounts.at(spark, session.fresh_path(spark, "distinct"), StringType())
    frame = spark.createDataFrame(rows, "at timestamp_ntz, household string")
    parts = [frame.filter(F.crc32(F.col("household").cast("binary")) % 3 == n) for n in range(3)]
    for run, part in enumerate([*parts, parts[1]]):  # runs share their days; the last one repeats the second
        stored.add(part, "at", "household", f"run-{1 if run == 3 else run}")
    return stored


def want(rows, low, high, period):
    made = {}
    for at, household in rows:
        if at is not None and household is not None and low <= str(at.date()) <= high:
            made.setdefault(period(at.date()), set()).add(household)
    return {p: len(x) for p, x in made.items()}


@pytest.mark.parametrize(("low", "high"), [("2024-01-01", "2024-12-31"), ("2024-01-25", "2024-02-03"), ("2025-01-01", "2025-01-02")])
def test_any_range(rows, counts, low, high):
    month = F.date_format("day", "yyyy-MM")
    exact = {r["period"]: r["entities"] for r in counts.exact(month, low, high).collect()}
    assert exact == want(rows, low, high, lambda d: f"{d:%Y-%m}")
    estimated = {r["period"]: r["entities"] for r in counts.estimated(month, low, high).collect()}
    assert estimated.keys() == exact.keys()
    assert all(abs(estimated[p] - exact[p]) <= max(1, 3 * ERROR * exact[p]) for p in exact)


def test_all_days(rows, counts):
    everything = want(rows, "2000", "3000", lambda _: "all")["all"]
    assert counts.exact().first()["entities"] == everything
    got = counts.estimated().first()
    assert abs(got["entities"] - everything) <= 3 * ERROR * everything
    assert got["rows"] == sum(at is not None and h is not None for at, h in rows)


def test_nothing_stored(spark):
    empty = DistinctCounts.at(spark, session.fresh_path(spark, "distinct"), StringType())
    assert empty.exact().first() is None
    assert empty.estimated(F.col("day"), "2024-01-01").collect() == []
