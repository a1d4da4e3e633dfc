"""Runs, sources and sinks against files."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from gridtally import schemas, session
from gridtally.operators import normalize
from gridtally.plans import pipelines
from gridtally.sinks import files as sink
from gridtally.sources import drops, extracts, files, readings
from gridtally.streaming import readings as stream

T0 = "2026-01-01 00:00:00"


def customers(spark, n=3):
    return spark.range(n).select(
        F.col("id").cast("string").alias("customer_id"),
        F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).alias("updated_at"),
    )


def dataset(df, field="updated_at"):
    return pipelines.Dataset("customers", lambda _: df, field)


def landed(spark, base):
    return spark.read.option("basePath", f"{base}/customers").parquet(f"{base}/customers")


def test_full_then_incremental_extract(spark, tmp_path):
    base = str(tmp_path)
    done = pipelines.extract(spark, base, "r1", [dataset(customers(spark))], T0)
    assert done["customers"]["rows_extracted"] == 3 and done["customers"]["watermark_end"] == "2025-01-03 00:00:00"
    mark = {"customers": done["customers"]["watermark_end"]}
    later = pipelines.extract(spark, base, "r2", [dataset(customers(spark, 5))], T0, mark)
    assert later["customers"]["rows_extracted"] == 2 and later["customers"]["watermark_end"] == "2025-01-05 00:00:00"
    again = pipelines.extract(spark, base, "r3", [dataset(customers(spark, 5))], T0, {"customers": "2030-01-01 00:00:00"})
    assert again["customers"]["rows_extracted"] == 0 and again["customers"]["watermark_end"] == "2030-01-01 00:00:00"
    everything = pipelines.extract(spark, base, "r4", [dataset(customers(spark, 5))], T0, {"customers": "2000-01-01 00:00:00"})
    assert everything["customers"]["rows_extracted"] == 5
    assert landed(spark, base).count() == 10


def test_inclusive_watermark_rereads_the_last_value(spark):
    df = customers(spark)
    assert extracts.incremental(df, "updated_at", "2025-01-03 00:00:00").count() == 0
    assert extracts.incremental(df, "updated_at", "2025-01-03 00:00:00", inclusive=True).count() == 1


def test_rerun_of_a_finished_run_is_skipped(spark, tmp_path):
    base = str(tmp_path)
    pipelines.extract(spark, base, "r1", [dataset(customers(spark))], T0)
    assert pipelines.extract(spark, base, "r1", [dataset(customers(spark))], T0) == {"customers": {"status": "SKIPPED"}}
    assert landed(spark, base).count() == 3


def test_failed_run_is_recorded_and_can_be_repeated(spark, tmp_path):
    base = str(tmp_path)

    def broken(_):
        raise ValueError("source is down")

    with pytest.raises(RuntimeError, match="extract of customers failed"):
        pipelines.extract(spark, base, "r1", [pipelines.Dataset("customers", broken)], T0)
    row = spark.read.schema(schemas.RUN_MANIFEST).option("recursiveFileLookup", "true").json(f"{base}/_manifests").first()
    assert row["status"] == "FAILED" and "source is down" in row["error"]
    assert pipelines.extract(spark, base, "r1", [dataset(customers(spark))], T0)["customers"]["status"] == "SUCCESS"


def test_backfill_filters_tags_and_runs_once(spark, tmp_path):
    base, out = str(tmp_path / "base"), str(tmp_path / "rows")
    source = spark.createDataFrame([("r1", dt.date(2020, 5, 1)), ("r2", dt.date(2020, 12, 31)), ("r3", dt.date(2021, 1, 1))], "id string, day date")
    write = lambda df: df.write.mode("append").parquet(out)
    args = (spark, base, "bf_2026_retro", "meter_readings", lambda a, b: source, "day", "2020-01-01", "2020-12-31", write)
    assert pipelines.backfill(*args) == {"status": "SUCCESS", "records_processed": 2}
    assert pipelines.backfill(*args) == {"status": "SKIPPED", "reason": "Already processed successfully."}
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2 and all(r["_metadata_is_backfill"] and r["_metadata_run_id"] == "bf_2026_retro" for r in rows)


def test_failed_backfill_can_be_repeated(spark, tmp_path):
    source = customers(spark).withColumn("day", F.col("updated_at").cast("date"))
    kept = []

    def write(df):
        if not kept:
            kept.append(1)
            raise OSError("disk")
        df.write.parquet(str(tmp_path / "rows"))

    args = (spark, str(tmp_path / "base"), "bf", "customers", lambda a, b: source, "day", "2025-01-01", "2025-12-31", write)
    with pytest.raises(RuntimeError, match="Backfill failed: disk"):
        pipelines.backfill(*args)
    assert pipelines.backfill(*args)["records_processed"] == 3


def meter_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("LCLid,stdorToU,DateTime,KWH/hh (per half hour) \n" + "".join(r + "\n" for r in rows))


def test_meter_file_to_gold(spark, tmp_path):
    stamp = "2012-10-12 0{}:00:00.0000000"
    meter_file(
        tmp_path / "csv", "a.csv",
        [f"MAC000002,Std,{stamp.format(h)},0.{h}" for h in range(5)]
        + [f"MAC000002,Std,{stamp.format(4)},0.4", f"MAC000002,Std,{stamp.format(5)}, Null ", f",Std,{stamp.format(6)},1", f"MAC000002,Std,{stamp.format(7)},500"],
    )
    paths = pipelines.meter_batch(spark, str(tmp_path / "csv"), str(tmp_path / "lake"), "run-1", T0)
    assert spark.read.parquet(paths["standardized"]).count() == 8
    gold = readings.layer(spark, paths["gold"], schemas.GOLD_READING)
    assert gold.count() == 5 and set(gold.columns) == set(spark.read.parquet(paths["standardized"]).columns)
    why = sorted(r["reasons"] for r in spark.read.parquet(paths["dead_letter"]).collect())
    assert why == ["Anomalous consumption value", "Anomalous consumption value", "Duplicate reading"]
    again = pipelines.meter_batch(spark, str(tmp_path / "csv"), str(tmp_path / "lake"), "run-1", T0)
    assert spark.read.parquet(again["gold"]).count() == 5
    zero = pipelines.meter_batch(spark, str(tmp_path / "csv"), str(tmp_path / "lake"), "run-2", T0, null_as_zero=True)
    assert spark.read.parquet(zero["gold"]).count() == 6


def test_header_with_and_without_trailing_space(spark, tmp_path):
    for name, head in (("a", "LCLid,stdorToU,DateTime,KWH/hh (per half hour) "), ("b", "LCLid,stdorToU,DateTime,KWH/hh (per half hour)")):
        (tmp_path / name).write_text(head + "\nMAC1,Std,2012-10-12 00:30:00.0000000,0.5\n")
        df = normalize.normalize_source(readings.source_csv(spark, str(tmp_path / name)))
        assert df.first()["consumption_kwh"] == 0.5


def test_no_gold_is_written_without_good_rows(spark, tmp_path):
    flags = "v int, is_complete boolean, is_valid boolean, is_unique boolean, is_good boolean"
    bad = spark.createDataFrame([(1, True, False, True, False)], flags)
    assert sink.write_gold(bad, str(tmp_path / "gold"), "r") is None and not (tmp_path / "gold").exists()


def test_choose_files():
    names = ["a.csv", "b.csv", "c.csv"]
    assert files.choose_files(names, ["all", "1"]) == names
    assert files.choose_files(names, ["3", "1", "9", "0", "x"]) == ["c.csv", "a.csv"]
    assert files.choose_files(names, ["x"]) == names


def test_latest_snapshot(spark, tmp_path):
    root = str(tmp_path / "snap")
    os.makedirs(root)
    assert files.latest_snapshot(spark, root, "v int").count() == 0
    for i in (1, 2):
        sink.write_snapshot(spark.createDataFrame([(i,)] * i, "v int").repartition(2), root, f"run-{9 - i}")
        time.sleep(0.05)
    assert [r["v"] for r in files.latest_snapshot(spark, root, "v int").collect()] == [2, 2]


def test_raw_chunks_hold_a_bounded_number_of_rows_and_skip_rows_without_meter(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "ROWS_PER_CHUNK", 10)
    df = spark.range(35).coalesce(1).select(
        F.when(F.col("id") < 30, "m").alias("meter_id"), F.lit("h").alias("household_id"), F.lit("2024-01-01T00:00:00").alias("event_timestamp"),
        F.lit(1.0).alias("consumption_kwh"), F.lit("Std").alias("stdorToU"), F.lit("s").alias("source_system"),
    )
    path = sink.write_raw_chunks(df, str(tmp_path / "raw" / "file-a"), "r1")
    sink.write_raw_chunks(df, str(tmp_path / "raw" / "file-b"), "r2")
    assert len([f for f in os.listdir(path) if f.endswith(".json")]) == 3
    scanned = readings.raw_run(spark, str(tmp_path / "raw"), "r1")
    assert scanned.count() == 30
    size = readings.raw_run_bytes(scanned).first()
    assert size["files"] == 3 and size["bytes"] == sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".json"))


def test_partition_writes_append_and_replace_only_their_run(spark, tmp_path):
    path = str(tmp_path / "fact")
    shape = "source_household_id string, reading_timestamp timestamp_ntz, consumption_kwh double"
    rows = [(f"h{i % 7}", dt.datetime(2024, 1, 1 + i % 2), float(i)) for i in range(50)]
    one = spark.createDataFrame([("h", dt.datetime(2024, 1, 2), 1.0)], shape)

    def counts():
        return {str(r["reading_date"]): r["count"] for r in spark.read.parquet(path).groupBy("reading_date").count().collect()}

    for run, df in (("r1", spark.createDataFrame(rows, shape)), ("r2", one), ("r2", one)):
        sink.write_reading_fact(df, path, run)
    assert counts() == {"2024-01-01": 25, "2024-01-02": 26}
    # the repeated first run has rows of one day only; its other day goes
    sink.write_reading_fact(one, path, "r1")
    assert counts() == {"2024-01-02": 2}


def test_file_drop_reads_only_new_files(spark, tmp_path):
    folder = str(tmp_path / "drop")
    spark.createDataFrame([("b1",)], "bill_id string").write.parquet(f"{folder}/one")
    seen = files.listing(spark, folder, "*.parquet")
    seen.write.parquet(str(tmp_path / "manifest"))
    spark.createDataFrame([("b2",)], "bill_id string").write.parquet(f"{folder}/two")
    manifest = spark.read.parquet(str(tmp_path / "manifest"))
    paths = drops.new_files(spark, folder, manifest, "*.parquet")
    rows = drops.load(spark, paths, "parquet", "bill_id string", T0).collect()
    assert [(r["bill_id"], r["_load_type"]) for r in rows] == [("b2", "INCREMENTAL")] and "/two/" in rows[0]["_file_path"]
    assert drops.load(spark, [], "parquet", "bill_id string", T0).count() == 0


def test_jdbc_options_split_the_key_range():
    got = extracts.jdbc_options("jdbc:postgresql://h/db", "utility.customers", "id", 0, 1000, 8)
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "8" and got["dbtable"] == "utility.customers"


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_materialized_frames_have_the_same_rows(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    assert sorted(map(tuple, session.materialize(df, "t").collect())) == sorted(map(tuple, df.collect()))


def test_daily_stream_with_late_rows_equals_batch(spark, tmp_path):
    shape = "at timestamp_ntz, kwh double"
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([(dt.datetime(2024, 1, 1), 0.1), (dt.datetime(2024, 1, 2), 0.2)], shape).write.parquet(folder)
    run = lambda: stream.daily_partials(stream.file_stream(spark, folder, shape, files_per_batch=1), out, check, "at", "kwh").awaitTermination()
    run()
    late = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), 0.2), (dt.datetime(2024, 1, 3), None), (None, 9.0)], shape)
    late.write.mode("append").parquet(folder)
    run()
    run()
    got = sorted((str(r["day"]), r["total_kwh"], r["reading_count"]) for r in stream.daily_totals(spark, out).collect())
    assert got == [("2024-01-01", 0.3, 2), ("2024-01-02", 0.2, 1), ("2024-01-03", None, 0)]


def test_streams_read_a_table_that_is_a_folder(spark, tmp_path):
    from gridtally.catalog import QUERIES

    shape = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3), i % 5, "view", 1.5, "{}") for i in range(30)]
    spark.createDataFrame(rows, shape).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got = sorted((str(r["day"]), r["total_kwh"]) for r in QUERIES["stream_daily_consumption"](spark, str(tmp_path)).collect())
    assert got == [("2024-01-01", 15.0), ("2024-01-02", 15.0), ("2024-01-03", 15.0)]
