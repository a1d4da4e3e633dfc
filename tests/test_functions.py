import datetime as dt

from pyspark.sql import functions as F

from gridtally.functions import keys, numbers, payload, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_surrogate_key_keeps_null_and_repeats(spark):
    assert one(spark, keys.surrogate_key(F.lit(None).cast("string"))) is None
    assert one(spark, keys.surrogate_key(F.lit("a"))) == int("0cc175b9c0f1b6a", 16)


def test_record_id_tells_null_from_empty(spark):
    a = one(spark, keys.record_id(F.lit(None).cast("string"), F.lit("b")))
    b = one(spark, keys.record_id(F.lit(""), F.lit("b")))
    assert a != b


def test_date_key(spark):
    assert one(spark, keys.date_key(F.lit("2024-03-07 23:59:59").cast("timestamp_ntz"))) == 20240307


def test_meter_stamp_accepts_only_the_file_format(spark):
    assert one(spark, times.meter_stamp(F.lit("2012-10-12 00:30:00.0000000"))) == dt.datetime(2012, 10, 12, 0, 30)
    for other in ("2012-10-12 00:30:00", "2012-10-12 00:30:00.0000001", "12/10/2012", "2012-13-40 00:00:00.0000000", ""):
        assert one(spark, times.meter_stamp(F.lit(other))) is None


def test_utc_stamp_applies_offsets_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, times.utc_stamp(F.lit("2026-10-06T12:00:00Z"))) == dt.datetime(2026, 10, 6, 12)
        assert one(spark, times.utc_stamp(F.lit("2026-10-06T12:00:00+02:00"))) == dt.datetime(2026, 10, 6, 10)
        assert one(spark, times.utc_stamp(F.lit("2026-03-08T02:30:00"))) == dt.datetime(2026, 3, 8, 2, 30)
        assert one(spark, times.utc_stamp(F.lit("soon"))) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_half_hour(spark):
    at = F.lit("2024-01-01 10:59:59.5").cast("timestamp_ntz")
    assert one(spark, times.half_hour(at)) == dt.datetime(2024, 1, 1, 10, 30)


def test_within_rejects_null_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (100.01,), (-1.0,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in df.select(numbers.within(F.col("v"), 0, 100)).collect()] == [True, True, False, False, False, False]


def test_percent_of_nothing_is_null(spark):
    assert one(spark, numbers.percent(F.lit(0), F.lit(0))) is None


def test_exact_sum_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)] * 1000, "v double")
    assert df.agg(numbers.exact_sum(F.col("v"), 2)).first()[0] == 600.0


def test_messages_and_codes(spark):
    assert one(spark, text.messages("; ", [(F.lit(True), "a"), (F.lit(False), "b"), (F.lit(True), "c")])) == "a; c"
    assert one(spark, text.messages("; ", [(F.lit(False), "a")])) == ""
    assert one(spark, text.code(F.lit("  residential "))) == "RESIDENTIAL"


def test_value_types(spark):
    body = '{"s":"x","i":5,"f":1.5,"b":true,"o":{"a":1},"l":[1],"n":null}'
    df = spark.createDataFrame([(body,)], "value string").select(F.explode(payload.fields(F.col("value"))).alias("k", "v"))
    got = {r["k"]: r["t"] for r in df.select("k", payload.value_type(F.col("v")).alias("t")).collect()}
    assert got == {"s": "str", "i": "int", "f": "float", "b": "bool", "o": "dict", "l": "list", "n": None}
