"""Histories that grow by batches equal those computed from all changes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridtally import session
from gridtally.operators import history
from gridtally.plans.stored_history import History

CHANGES = "k string, at timestamp_ntz, v string, w int, n int, deleted boolean"


def kept(spark, frame):
    return History.at(spark, session.fresh_path(spark, "history"), frame.schema, "k", "at", ["v", "w"], "n")


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def apply(stored, frame):
    stored.apply(frame, F.col("deleted"))
    return sorted((r["k"], r["v"], (r["valid_from"] - day(0)).days, None if r["valid_to"] is None else (r["valid_to"] - day(0)).days) for r in stored.rows().collect())


def test_late_changes_split_shorten_and_remove(spark):
    make = lambda rows: spark.createDataFrame([(k, day(d), v, 0, n, gone) for k, d, v, n, gone in rows], CHANGES)
    stored = kept(spark, make([("a", 0, "x", 0, False)]).limit(0))
    first = make([("a", 10, "x", 1, False), ("a", 30, "x", 2, False), ("b", 5, "p", 3, False)])
    assert apply(stored, first) == [("a", "x", 10, None), ("b", "p", 5, None)]
    # a late change splits the version; the one at day 30, which altered nothing, starts one now
    assert apply(stored, make([("a", 20, "y", 4, False)])) == [("a", "x", 10, 20), ("a", "x", 30, None), ("a", "y", 20, 30), ("b", "p", 5, None)]
    # a correction at the same instant removes two of them again; a weaker one does nothing
    assert apply(stored, make([("a", 20, "x", 9, False), ("a", 10, "z", 0, False)])) == [("a", "x", 10, None), ("b", "p", 5, None)]
    # a late deletion shortens; one that comes first of all leaves nothing before it
    assert apply(stored, make([("a", 25, "x", 10, True), ("b", 1, "p", 11, True), (None, 1, "q", 12, False)])) == [
        ("a", "x", 10, 25),
        ("a", "x", 30, None),
        ("b", "p", 5, None),
    ]
    # an entity whose only versions go
    assert apply(stored, make([("b", 5, "p", 13, True)])) == [("a", "x", 10, 25), ("a", "x", 30, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_equals_all_at_once(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("abcdefg"), day(rng.randrange(60)), rng.choice(("x", "y", None)), rng.randrange(2), n, rng.random() < 0.15) for n in range(150)
    ]
    rows += [("hot", day(n), "xy"[n // 3 % 2], 0, 1000 + n, False) for n in range(100)]
    frame = spark.createDataFrame(rows, CHANGES)
    want = sorted(map(str, history.versions(frame, "k", "at", ["v", "w"], "n", F.col("deleted")).collect()))
    rng.shuffle(rows)
    stored = kept(spark, frame)
    parts = [rows[:20], rows[20:150], rows[10:40], rows[150:]]  # of different sizes, one partly repeated
    for part in parts:
        stored.apply(spark.createDataFrame(part, CHANGES), F.col("deleted"), limit=30)
    assert sorted(map(str, stored.rows().select("k", "v", "w", "valid_from", "valid_to", "is_current").collect())) == want


def test_only_files_of_touched_keys_are_replaced(spark):
    make = lambda rows: spark.createDataFrame([(k, day(d), v, 0, n, False) for k, d, v, n in rows], CHANGES)
    stored = kept(spark, make([("a", 0, "x", 0)]))
    for part in range(3):
        stored.apply(make([(f"k{part}-{i}", i, "x", i) for i in range(20)]), F.col("deleted"))
    before = {r["path"] for r in stored.versions.files().collect()}
    stored.apply(make([("k1-3", 40, "y", 99)]), F.col("deleted"))
    after = {r["path"] for r in stored.versions.files().collect()}
    assert len(before - after) == 1
    assert stored.rows().count() == 61
    # what changes no version replaces none
    version = stored.versions.version()
    stored.apply(make([("k1-3", 40, "y", 99)]), F.col("deleted"))
    assert {r["path"] for r in stored.versions.files().collect()} == after
    assert stored.versions.version() == version


def test_a_batch_cut_off_between_both_tables_is_applied_again(spark, monkeypatch):
    make = lambda rows: spark.createDataFrame([(k, day(d), v, 0, n, False) for k, d, v, n in rows], CHANGES)
    stored = kept(spark, make([("a", 0, "x", 0)]))
    stored.apply(make([("a", 1, "x", 1)]), F.col("deleted"))
    batch = make([("a", 5, "y", 2), ("b", 1, "z", 3)])

    def stop(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(History, "_changed", stop)
        with pytest.raises(OSError):
            stored.apply(batch, F.col("deleted"))
    assert apply(stored, make([])) == [("a", "x", 1, None)]
    assert apply(stored, batch) == [("a", "x", 1, 5), ("a", "y", 5, None), ("b", "z", 1, None)]
