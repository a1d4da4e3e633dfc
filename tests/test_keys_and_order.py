"""Dedup, neighbours, gaps, history and ranges against brute force in Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridtally.operators import dedup, history, ordered, ranges


def hot_rows(seed: int, n: int = 400):
    """Rows of which a third share one key."""
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.34 else f"k{rnd.randrange(20)}", rnd.randrange(60), i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_first_flag_matches_brute_force(spark, seed):
    data = hot_rows(seed) + [(None, 5, 1000), (None, 5, 1001), ("k1", None, 1002), ("k1", None, 1003)]
    df = spark.createDataFrame(data, "k string, t int, n int").repartition(7)
    got = {r["n"]: r["first"] for r in dedup.first_flag(df, ["k", "t"], ["n"], "first").collect()}
    seen, want = set(), {}
    for k, t, n in sorted(data, key=lambda r: r[2]):
        want[n] = (k, t) not in seen
        seen.add((k, t))
    assert got == want


def test_first_flag_with_a_two_column_row_id(spark):
    df = spark.createDataFrame([("a", "f2", 0), ("a", "f1", 9), ("b", "f1", 3)], "k string, file string, pos int")
    got = {(r["file"], r["pos"]): r["first"] for r in dedup.first_flag(df, ["k"], ["file", "pos"], "first").collect()}
    assert got == {("f2", 0): False, ("f1", 9): True, ("f1", 3): True}


def test_latest_breaks_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "n")], "k string, t int, v string")
    assert rows(dedup.latest_per_key(df, ["k"], "t", "v")) == [(None, 1, "n"), ("a", 2, "z")]
    assert rows(dedup.top_per_key(df, ["k"], [F.desc("t"), F.desc("v")], 2), "v") == [("n",), ("y",), ("z",)]


def test_surplus_copies(spark):
    df = spark.createDataFrame([(1, None)] * 4 + [(2, "b")], "a int, b string")
    assert dedup.surplus_copies(df).first()["duplicates"] == 3
    assert dedup.surplus_copies(df.limit(0)).first()["duplicates"] == 0


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_neighbours_do_not_depend_on_the_bucket(spark, width):
    data = hot_rows(4) + [(None, 3, 900), (None, 4, 901)]
    df = spark.createDataFrame(data, "k string, t int, n int")
    placed = df.withColumn("b", F.struct("k", F.floor(F.col("t") / width)))
    out = ordered.with_neighbours(placed, ["k"], ["t", "n"], ["n"], "b", previous="before", following="after")
    assert out.columns == ["k", "t", "n", "b", "before", "after"]
    got = {r["n"]: (r["before"] and r["before"]["n"], r["after"] and r["after"]["n"]) for r in out.collect()}
    want = {}
    for key in {r[0] for r in data}:
        line = [n for _, n in sorted((t, n) for k, t, n in data if k == key)]
        for i, n in enumerate(line):
            want[n] = (line[i - 1] if i else None, line[i + 1] if i + 1 < len(line) else None)
    assert got == want


def test_sequence_gaps(spark, rows):
    present = [1, 2, 3, 7, 8, 20, 20, 40]
    df = spark.createDataFrame([(n,) for n in present], "lsn bigint")
    assert rows(ordered.sequence_gaps(df, "lsn")) == [(21, 39, 19), (4, 6, 3), (9, 19, 11)]


def test_a_stray_number_does_not_fill_one_block(spark):
    df = spark.range(4000).selectExpr("id as lsn").union(spark.createDataFrame([(10**15,)], "lsn bigint"))
    gaps = ordered.sequence_gaps(df, "lsn").collect()
    assert [tuple(g) for g in gaps] == [(4000, 10**15 - 1, 10**15 - 4000)]


def test_crowded_months_are_sliced_in_order(spark):
    start = dt.datetime(2024, 1, 1)
    data = [("hot", start + dt.timedelta(minutes=7 * i)) for i in range(9000)] + [("cold", start), (None, None)]
    df = spark.createDataFrame(data, "k string, at timestamp_ntz")
    out = ordered.time_groups(df, ["k"], "at", "b", limit=500)
    sizes = out.groupBy("k", "b").agg(F.count("*").alias("n"), F.min("at").alias("a"), F.max("at").alias("z")).collect()
    assert sum(r["n"] for r in sizes) == len(data) and max(r["n"] for r in sizes) <= 600
    hot = sorted((r["b"]["month"], r["b"]["slice"], r["a"], r["z"]) for r in sizes if r["k"] == "hot")
    assert len(hot) > 15 and all(x[3] < y[2] for x, y in zip(hot, hot[1:]))


@pytest.mark.parametrize("width", [1, 9, 1000])
def test_carry_forward(spark, width):
    rnd = random.Random(9)
    data = [(k, t, n, rnd.choice([None, None, f"v{n}"])) for k, t, n in hot_rows(8)]
    df = spark.createDataFrame(data, "k string, t int, n int, v string").withColumn("b", F.struct("k", F.floor(F.col("t") / width)))
    got = {r["n"]: r["seen"] for r in ordered.carry_forward(df, ["k"], ["t", "n"], "v", "b", "seen").collect()}
    want = {}
    for key in {r[0] for r in data}:
        last = None
        for _, n, v in sorted((t, n, v) for k, t, n, v in data if k == key):
            last = v or last
            want[n] = last
    assert got == want


def day(text: str):
    return dt.datetime.fromisoformat(text)


CHANGES = "k string, at timestamp_ntz, v string, n int, deleted boolean"


@pytest.mark.parametrize("limit", [1, 2, 1000])
def test_history(spark, limit):
    data = [
        ("a", day("2024-01-01"), "x", 1, False),
        ("a", day("2024-01-15"), "x", 2, False),
        ("a", day("2024-02-01"), "y", 3, False),
        ("a", day("2024-02-01"), "z", 4, False),
        ("a", day("2024-05-01"), "z", 5, True),
        ("a", day("2024-06-01"), "z", 6, False),
        ("b", day("2024-01-01"), None, 7, False),
        ("b", day("2024-01-02"), None, 8, False),
    ]
    df = spark.createDataFrame(data, CHANGES)
    out = history.versions(df, "k", "at", ["v"], "n", F.col("deleted"), limit=limit)
    got = sorted((r["k"], str(r["v"]), r["valid_from"], r["valid_to"], r["is_current"]) for r in out.collect())
    assert got == [
        ("a", "x", day("2024-01-01"), day("2024-02-01"), False),
        ("a", "z", day("2024-02-01"), day("2024-05-01"), False),
        ("a", "z", day("2024-06-01"), None, True),
        ("b", "None", day("2024-01-01"), None, True),
    ]
    again = history.versions(df.union(df), "k", "at", ["v"], "n", F.col("deleted"))
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_deleted_entity_has_no_current_version(spark):
    df = spark.createDataFrame([("a", day("2024-01-01"), "x", 1, False), ("a", day("2024-01-09"), "x", 2, True)], CHANGES)
    got = history.versions(df, "k", "at", ["v"], "n", F.col("deleted")).collect()
    assert [(r["valid_to"], r["is_current"]) for r in got] == [(day("2024-01-09"), False)]


def test_soft_delete(spark, rows):
    now = spark.createDataFrame([("a", "ACTIVE"), ("b", "ACTIVE")], "k string, status string")
    gone = spark.createDataFrame([("b", 1), ("b", 2)], "k string, at int")
    assert rows(history.soft_delete(now, gone, "k", "status", "at")) == [("a", "ACTIVE", None), ("b", "INACTIVE", 2)]


@pytest.mark.parametrize("limit", [10, 100_000])
def test_valid_at_matches_every_pair_tested(spark, limit):
    rnd = random.Random(5)
    base = dt.datetime(2023, 1, 1)
    cuts = sorted({rnd.randrange(800) for _ in range(12)})
    versions = []
    for i, c in enumerate(cuts):
        end = base + dt.timedelta(days=cuts[i + 1]) if i + 1 < len(cuts) else None
        versions.append(("hot", f"v{i}", base + dt.timedelta(days=c), end))
    versions.append(("cold", "w", base + dt.timedelta(days=100), base + dt.timedelta(days=130)))
    events = [(n, rnd.choice(["hot", "hot", "cold"]), base + dt.timedelta(days=rnd.randrange(1000))) for n in range(300)]
    left = spark.createDataFrame(events, "n int, k string, at timestamp_ntz")
    right = spark.createDataFrame(versions, "k string, version string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = ranges.valid_at(left, right, "k", "at", "valid_from", "valid_to", limit=limit)
    got = sorted((r["n"], r["version"]) for r in out.collect())
    want = sorted(
        (n, v) for n, k, at in events for key, v, a, b in versions if key == k and a <= at and (b is None or at < b)
    )
    assert got == want and want
    every = ranges.valid_at(left, right, "k", "at", "valid_from", "valid_to", how="left", limit=limit)
    assert every.count() == 300 and every.filter("version is null").count() == 300 - len(want)


def test_usage_and_coverage_match_every_pair_tested(spark):
    rnd = random.Random(6)
    base = dt.date(2023, 1, 20)
    daily = [(s, base + dt.timedelta(days=d), rnd.randrange(100)) for s in ("hot", "cold") for d in range(0, 200, 3)]
    periods = []
    for i in range(60):
        start = base + dt.timedelta(days=rnd.randrange(-40, 220))
        periods.append(("hot" if i % 3 else "cold", start, start + dt.timedelta(days=rnd.randrange(-1, 75))))
    d = spark.createDataFrame(daily, "site string, day date, usage int")
    p = spark.createDataFrame(periods * 2, "site string, a date, b date")
    got = {(r["site"], r["a"], r["b"]): r["total"] for r in ranges.usage_in_periods(p, d, ["site"], "a", "b", "usage", "total").collect()}
    want = {}
    for s, a, b in set(periods):
        hits = [u for site, day_, u in daily if site == s and a <= day_ <= b]
        if hits:
            want[(s, a, b)] = sum(hits)
    assert got == want
    flags = {(r["site"], r["day"]): r["billed"] for r in ranges.covered_days(d, p, ["site"], "a", "b", "billed").collect()}
    assert flags == {(s, x): any(s == q and a <= x <= b for q, a, b in periods) for s, x, _ in daily}


def test_coverage_groups_nothing_after_its_join(spark):
    day = dt.date(2024, 5, 10)
    d = spark.createDataFrame([("a", day, 1), ("a", None, 2), (None, day, 3), ("b", day, 4)], "site string, day date, usage int")
    p = spark.createDataFrame([("a", day, day), ("a", dt.date(2024, 4, 1), dt.date(2024, 6, 1)), ("b", None, day), (None, day, day)], "site string, a date, b date")
    made = ranges.covered_days(d, p, ["site"], "a", "b", "billed")
    assert {r["usage"]: r["billed"] for r in made.collect()} == {1: True, 2: False, 3: False, 4: False}
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" in plan and "Aggregate" not in plan.split("Join")[0]
