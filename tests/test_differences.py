"""Differing keys by sketches against set differences."""

import random

import pytest

from gridtally.operators import differences

SHAPE = "k string, n int, v double"


def expected(source, target):
    ours, theirs = ({r[:2]: r[2] for r in rows} for rows in (source, target))
    made = [(*k, "missing") for k in ours.keys() - theirs.keys()] + [(*k, "surplus") for k in theirs.keys() - ours.keys()]
    return sorted(made + [(*k, "changed") for k in ours.keys() & theirs.keys() if ours[k] != theirs[k]], key=str)


def found(spark, source, target, values=("v",)):
    make = lambda rows: spark.createDataFrame(rows, SHAPE).repartition(3)
    return sorted((tuple(r) for r in differences.between(make(source), make(target), ["k", "n"], list(values)).collect()), key=str)


@pytest.mark.parametrize("size", [0, 1, 30, 900])
def test_any_number_of_differences(spark, size):
    rng = random.Random(size)
    rows = [(f"k{i}", i % 7, rng.random()) for i in range(2000)]
    source, target = list(rows), list(rows)
    for i in rng.sample(range(2000), size):
        kind = rng.randrange(3)
        if kind == 0:
            source.remove(rows[i])
        elif kind == 1:
            target.remove(rows[i])
        else:
            target[target.index(rows[i])] = (*rows[i][:2], -1.0)
    got = found(spark, source, target)
    assert got == expected(source, target)
    assert len(got) == size


def test_missing_values_and_one_empty_side(spark):
    rows = [("a", None, 1.0), (None, 1, 1.0), ("b", 2, None), (None, None, None)]
    assert found(spark, rows, []) == expected(rows, [])
    assert found(spark, [], rows) == expected([], rows)
    assert found(spark, [], []) == []
    assert found(spark, rows, [("a", None, None), *rows[1:]]) == [("a", None, "changed")]


def test_repeated_rows_end_in_a_plain_comparison(spark, monkeypatch):
    monkeypatch.setattr(differences, "MOST", 1000)
    rows = [("a", 1, 1.0), ("b", 1, 1.0)]
    assert found(spark, [*rows, *rows[:1] * 2], rows[1:]) == [("a", 1, "missing")]


def test_a_table_that_is_too_small_is_made_larger(spark, monkeypatch):
    monkeypatch.setattr(differences, "SPACE", 0.02)
    monkeypatch.setattr(differences, "LEAST", 3)
    source = [(f"k{i}", i, 1.0) for i in range(120)]
    assert found(spark, source, []) == expected(source, [])


def test_exchanged_rows_follow_the_difference(spark):
    """A hundred times the rows with the same difference need the same sketch."""
    from pyspark.sql import functions as F

    for rows in (1000, 100_000):
        ours, theirs = (spark.range(first, rows).select(F.xxhash64("id").alias("h")) for first in (0, 5))
        width = differences.LEAST // differences.TIMES + 1
        parts = differences.digests(ours).count()
        assert parts <= differences.PARTS
        found, all_of_it = differences.decode(differences.sketch(ours, width), differences.sketch(theirs, width), width)
        assert all_of_it and found.count() == 5
        assert differences.sketch(ours, width).count() <= differences.TIMES * width
