"""Results that must not depend on how the input is spread over files, and edge rows."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from gridtally import schemas, session
from gridtally.operators import evolve, quality, ranges, reconcile, runs
from gridtally.plans import pipelines
from gridtally.sinks import files as sink
from gridtally.sources import changes as change_files
from gridtally.sources import readings as meter_files
from gridtally.streaming import changes, readings

START = dt.datetime(2024, 1, 1)
SHAPE = "event_id bigint, ts timestamp_ntz, value double"


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(1)
    rows = [(i, START + dt.timedelta(minutes=rng.randrange(30 * 24 * 60)), float(rng.randrange(100))) for i in range(1000)]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module", params=[1, 350])
def folder(request, spark, events, tmp_path_factory):
    """The same events as one file, and as many files in no order of time."""
    path = str(tmp_path_factory.mktemp("events") / str(request.param))
    events.repartition(request.param, F.xxhash64("event_id")).write.parquet(path)
    return path


def stream(spark, folder):
    return readings.file_stream(spark, folder, SHAPE)


def test_repeats_are_stored_once_and_nothing_is_lost(spark, events, folder, tmp_path):
    twice = stream(spark, folder)
    out = str(tmp_path / "out")
    changes.append_once(twice.union(twice), out, str(tmp_path / "at"), ["event_id"], "ts").awaitTermination()
    stored = changes.stored_feed(spark, out)
    assert sorted(map(tuple, stored.select("event_id", "value").collect())) == sorted(map(tuple, events.select("event_id", "value").collect()))


def test_closed_days_hold_all_their_readings(spark, events, folder, tmp_path):
    out = str(tmp_path / "out")
    readings.daily_partials(stream(spark, folder), out, str(tmp_path / "at"), "ts", "value", "6 hours").awaitTermination()
    got = {r["day_start"].date(): (float(r["total_kwh"]), r["reading_count"]) for r in readings.closed_days(spark, out, "6 hours").collect()}
    want = {}
    newest = max(r["ts"] for r in events.collect())
    for r in events.collect():
        kwh, n = want.get(r["ts"].date(), (0.0, 0))
        want[r["ts"].date()] = (kwh + r["value"], n + 1)
    closed = {d for d in want if dt.datetime.combine(d, dt.time()) + dt.timedelta(days=1) <= newest - dt.timedelta(hours=6)}
    assert got == {d: want[d] for d in closed}


def test_a_redelivery_in_a_later_batch_is_recognized(spark, tmp_path):
    source, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    for ids in ([1, 2], [2, 3], [None, 1], [None]):
        spark.createDataFrame([(i, START, 1.0) for i in ids], SHAPE).coalesce(1).write.mode("append").parquet(source)
        changes.append_once(stream(spark, source), out, at, ["event_id"], "ts").awaitTermination()
    assert sorted(str(r["event_id"]) for r in changes.stored_feed(spark, out).collect()) == ["1", "2", "3", "None", "None"]


def test_unreadable_change_files_are_counted(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    record = '{"customer_id":"C1","_metadata":{"change_type":"UPDATE","table":"customers"}}'
    (folder / "a.txt").write_text(f"{record}\n\nnot json\n")
    (folder / "b.txt.gz").write_bytes(b"this is no gzip file")
    (folder / "c.txt").write_text("")
    assert [r["path"].rsplit("/")[-1] for r in change_files.unreadable(spark, str(folder)).collect()] == ["b.txt.gz"]
    out = str(tmp_path / "out")
    changes.run_split(spark, str(folder), out, str(tmp_path / "at"), "2026-01-01 00:00:00")
    assert changes.counters(spark, str(folder), out).first().asDict() == {
        "notifications": 2, "files_read": 1, "read_errors": 1, "processed": 2, "invalid": 1,
    }


def test_headers_may_differ_in_blanks_only(spark, tmp_path):
    a, b, c = (tmp_path / n for n in ("a.csv", "b.csv", "c.csv"))
    a.write_text("LCLid,KWH/hh (per half hour) \nM1,0.5\n")
    b.write_text("LCLid,KWH/hh (per half hour)\nM2,0.7\n")
    c.write_text("KWH/hh (per half hour),LCLid\n0.9,M3\n")
    both = meter_files.source_csv(spark, [str(a), str(b)])
    assert both.columns == ["LCLid", "KWH/hh (per half hour)"] and sorted(map(tuple, both.collect())) == [("M1", "0.5"), ("M2", "0.7")]
    with pytest.raises(Exception, match="header differs"):
        meter_files.source_csv(spark, [str(a), str(c)]).collect()


def test_a_rerun_without_good_rows_leaves_no_gold(spark, tmp_path):
    shape = "meter_id string, is_complete boolean, is_valid boolean, is_unique boolean, is_good boolean"
    good, bad = (spark.createDataFrame([("m", True, True, True, ok)], shape) for ok in (True, False))
    path = sink.write_gold(good, str(tmp_path), "r1")
    assert sink.write_gold(bad, str(tmp_path), "r1") is None
    assert not session.exists(spark, path)


def test_gold_is_the_good_part_of_the_flags(spark):
    rows = [(i, m, t, v) for i, (m, t, v) in enumerate([("a", START, 1.0), ("a", START, 2.0), ("b", START, None), (None, START, 1.0), ("b", START, 3.0), ("c", None, 1.0), ("d", START, 101.0)])]
    df = spark.createDataFrame(rows, "no int, meter_id string, event_timestamp timestamp_ntz, consumption_kwh double")
    flags = quality.split(quality.flag_readings(df, ["no"]))[0].select("no")
    assert sorted(map(tuple, quality.accepted(df, ["no"]).select("no").collect())) == sorted(map(tuple, flags.collect())) == [(0,)]


@pytest.mark.parametrize("limit", [3, 100, 1_000_000])
def test_point_in_time_with_nulls_and_a_crowded_instant(spark, limit):
    versions = spark.createDataFrame(
        [("a", START, None, 1), ("a", None, None, 2), (None, START, None, 3)], "k string, since timestamp_ntz, until timestamp_ntz, v int"
    )
    moments = [("a", START + dt.timedelta(days=1))] * 400 + [("a", None), (None, START + dt.timedelta(days=1)), ("a", START - dt.timedelta(days=1)), ("b", START)]
    asked = spark.createDataFrame(moments, "k string, at timestamp_ntz")
    out = ranges.valid_at(asked, versions, "k", "at", "since", "until", limit=limit).collect()
    assert len(out) == 400 and {r["v"] for r in out} == {1}
    every = ranges.valid_at(asked, versions, "k", "at", "since", "until", how="left", limit=limit).collect()
    assert len(every) == 404 and sum(r["v"] is None for r in every) == 4


def test_repeated_keys_do_not_cancel(spark):
    source, target = (spark.createDataFrame([(k,) for k in keys], "k string") for keys in ("AAB", "CCB"))
    assert [r["keys_match"] for r in reconcile.compare(source, target, "k", F.lit(1), F.lit(1)).collect()] == [False]
    assert [r["keys_match"] for r in reconcile.compare(source, source, "k", F.lit(1), F.lit(1)).collect()] == [True]


def test_volume_is_compared_with_the_days_before(spark):
    days = [(dt.date(2024, 1, 1), 1000), (dt.date(2024, 3, 1), 10), (dt.date(2024, 3, 2), 100), (dt.date(2024, 3, 3), 20)]
    df = spark.createDataFrame([("p", d, n) for d, n in days], "p string, day date, n bigint")
    assert [r["day"] for r in runs.volume_alerts(df, "p", "day", "n").collect()] == [dt.date(2024, 3, 3)]


def test_whole_and_fractional_numbers_are_one_type(spark):
    shape = "table_name string, field string, dtype string"
    old = spark.createDataFrame([("t", "amount", "int"), ("t", "amount", "float"), ("t", "name", "str")], shape)
    new = spark.createDataFrame([("t", "amount", "float"), ("t", "name", "str"), ("t", "name", "int")], shape)
    assert {r["field"]: r["change"] for r in evolve.diff(old, new).collect()} == {"amount": "SAME", "name": "RETYPED"}


def test_a_backfill_reads_its_source_once_and_records_times(spark, tmp_path):
    base, seen = str(tmp_path / "base"), spark.sparkContext.accumulator(0)
    source = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1))], "id int, day date")

    def load(start, end):
        return source

    def write(df):
        seen.add(1)
        df.write.mode("overwrite").parquet(f"{base}/rows")

    ticks = iter(["2026-01-01 00:00:00", "2026-01-01 00:05:00"])
    done = pipelines.backfill(spark, base, "r1", "t", load, "day", "2024-01-01", "2024-01-31", write, clock=lambda: next(ticks))
    assert done == {"status": "SUCCESS", "records_processed": 1} and seen.value == 1
    row = spark.read.schema(schemas.RUN_MANIFEST).option("recursiveFileLookup", "true").json(f"{base}/_manifests").first()
    assert (row["start_time"], row["end_time"]) == (dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1, 0, 5))


def test_the_whole_error_is_recorded(spark, tmp_path):
    base = str(tmp_path / "base")

    def broken(start, end):
        raise ValueError("x" * 5000)

    with pytest.raises(RuntimeError):
        pipelines.backfill(spark, base, "r1", "t", broken, "day", "2024-01-01", "2024-01-31", lambda df: None)
    row = spark.read.schema(schemas.RUN_MANIFEST).option("recursiveFileLookup", "true").json(f"{base}/_manifests").first()
    assert row["status"] == "FAILED" and row["error"] == "x" * 5000


def test_a_truncated_change_file_is_not_half_read(spark, tmp_path):
    import gzip

    folder = tmp_path / "in"
    folder.mkdir()
    record = '{"customer_id":"C%d","note":"%s","_metadata":{"change_type":"UPDATE","table":"customers"}}'
    many = "\n".join(record % (i, os.urandom(40).hex()) for i in range(5000)).encode()
    whole = gzip.compress(many)
    (folder / "half.txt.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "whole.txt.gz").write_bytes(gzip.compress((record % (7, "")).encode()))
    (folder / "odd [1].txt").write_text(record % (8, ""))
    bad = [r["path"] for r in change_files.unreadable(spark, str(folder)).collect()]
    assert [p.rsplit("/")[-1] for p in bad] == ["half.txt.gz"]
    with pytest.raises(Exception):
        change_files.change_lines(spark, str(folder)).count()
    assert change_files.change_lines(spark, str(folder), without=bad).count() == 2
    out = str(tmp_path / "out")
    changes.run_split(spark, str(folder), out, str(tmp_path / "at"), "2026-01-01 00:00:00")
    assert changes.counters(spark, str(folder), out).first().asDict() == {
        "notifications": 3, "files_read": 2, "read_errors": 1, "processed": 2, "invalid": 0,
    }
    assert [r["path"].rsplit("/")[-1] for r in changes.unread(spark, out).collect()] == ["half.txt.gz"]
