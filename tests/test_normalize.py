import datetime as dt

from pyspark.sql import functions as F

from gridtally.operators import normalize, quality

HEAD = "LCLid string, stdorToU string, DateTime string, `KWH/hh (per half hour)` string"
GOOD_TIME = "2012-10-12 00:30:00.0000000"


def test_rows_of_a_meter_file(spark):
    df = spark.createDataFrame(
        [
            ("MAC000002", "Std", GOOD_TIME, "0.25"),
            ("MAC000002", "ToU", GOOD_TIME, " Null "),
            ("MAC000003", "Std", "yesterday", "1"),
            ("", "Std", GOOD_TIME, "1"),
            (None, "Std", GOOD_TIME, "1"),
            ("MAC000004", "Std", GOOD_TIME, "abc"),
            ("MAC000005", "Std", GOOD_TIME, None),
        ],
        HEAD,
    )
    out = normalize.normalize_source(df).collect()
    assert out[0]["meter_id"] == "METER-000002" and out[0]["event_timestamp"] == "2012-10-12T00:30:00"
    assert out[0]["consumption_kwh"] == 0.25 and out[0]["source_system"] == "uk_power_networks"
    assert out[1]["consumption_kwh"] is None and out[1]["reject_reason"] is None
    assert out[2]["event_timestamp"] is None and out[2]["reject_reason"] is None
    assert [r["reject_reason"] for r in out[3:6]] == ["no household", "no household", "value is no number"]
    assert out[6]["consumption_kwh"] == 0.0
    zero = normalize.normalize_source(df, null_as_zero=True).collect()
    assert zero[1]["consumption_kwh"] == 0.0
    counts = normalize.scan_counts(normalize.normalize_source(df)).first()
    assert tuple(counts) == (7, 4, 3)


def test_standardize_keeps_missing_ids_and_adds_tariff(spark):
    raw = spark.createDataFrame(
        [(None, "MAC1", "2012-10-12T00:30:00", None, "s")],
        "meter_id string, household_id string, event_timestamp string, consumption_kwh double, source_system string",
    )
    row = normalize.standardize(raw, "i", "s", "2026-01-01 00:00:00").first()
    assert row["meter_id"] is None and row["stdor_to_u"] is None and row["consumption_kwh"] is None
    assert row["event_timestamp"] == dt.datetime(2012, 10, 12, 0, 30)
    assert normalize.standardize(raw, "i", "s", "2026-01-01 00:00:00", null_as_zero=True).first()["consumption_kwh"] == 0.0


def _file(spark, tariff: str, rows: int, household: str):
    """Half-hourly rows whose last one repeats the one before."""
    start = F.lit("2012-10-12 00:00:00").cast("timestamp_ntz")
    n = F.least(F.col("id"), F.lit(rows - 2)).cast("int")
    stamp = F.date_format(F.timestamp_add("MINUTE", n * 30, start), "yyyy-MM-dd HH:mm:ss")
    return spark.range(rows).select(
        F.lit(household).alias("LCLid"), F.lit(tariff).alias("stdorToU"), F.concat(stamp, F.lit(".0000000")).alias("DateTime"),
        F.lit("0.1").alias(normalize.VALUE_COLUMN), F.col("id").alias("n"),
    )


def _good(spark, *files):
    parts = []
    for f in files:
        raw = normalize.accepted(normalize.normalize_source(f))
        parts.append(normalize.standardize(raw, "i", "s", "2026-01-01 00:00:00"))
    both = normalize.union_batches(*parts).withColumn("row_no", F.monotonically_increasing_id())
    flagged = quality.flag_readings(both, ["row_no"])
    return quality.split(flagged)


def test_thousand_rows_give_999_good_and_one_rejected(spark):
    good, bad = _good(spark, _file(spark, "Std", 1000, "MAC000002"))
    assert (good.count(), bad.count()) == (999, 1)


def test_two_tariffs_of_500_rows_give_499_each(spark):
    good, bad = _good(spark, _file(spark, "Std", 500, "MAC000002"), _file(spark, "ToU", 500, "MAC000003"))
    counts = {r["stdor_to_u"]: r["count"] for r in good.groupBy("stdor_to_u").count().collect()}
    assert counts == {"Std": 499, "ToU": 499} and bad.count() == 2
