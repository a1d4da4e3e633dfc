import pytest
from pyspark.sql import functions as F

from gridtally.operators import dlq, quality, records, rules

COLUMNS = "n int, meter_id string, event_timestamp timestamp_ntz, consumption_kwh double, stdor_to_u string"


@pytest.fixture
def readings(spark):
    at = "2024-01-01 00:00:00"
    df = spark.createDataFrame(
        [
            (1, "m1", at, 5.0, "Std"),
            (2, "m1", at, 6.0, "Std"),
            (3, "m2", at, -1.0, None),
            (4, "m3", at, 0.0, "ToU"),
            (5, "m4", at, 100.0, "ToU"),
            (6, "m5", at, 100.01, "ToU"),
            (7, "m6", at, None, "ToU"),
            (8, "m7", at, float("nan"), "ToU"),
            (9, None, at, 1.0, "ToU"),
            (10, None, at, 1.0, "ToU"),
            (11, "m8", None, 1.0, "ToU"),
        ],
        COLUMNS.replace("timestamp_ntz", "string"),
    )
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def test_flags(readings):
    flagged = quality.flag_readings(readings, ["n"])
    got = {r["n"]: (r["is_complete"], r["is_valid"], r["is_unique"]) for r in flagged.collect()}
    assert got == {
        1: (True, True, True), 2: (True, True, False), 3: (True, False, True), 4: (True, True, True), 5: (True, True, True),
        6: (True, False, True), 7: (True, False, True), 8: (True, False, True), 9: (False, True, True), 10: (False, True, False),
        11: (False, True, True),
    }


def test_reasons_and_split(readings):
    flagged = quality.flag_readings(readings, ["n"])
    good, bad = quality.split(flagged)
    assert sorted(r["n"] for r in good.collect()) == [1, 4, 5] and bad.count() == 8
    reasons = {r["n"]: r["reasons"] for r in quality.rejects(flagged).collect()}
    assert reasons[10] == "Missing required fields | Duplicate reading"
    assert reasons[3] == "Anomalous consumption value"


def test_split_counts_a_missing_flag_as_bad(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "is_good boolean")
    good, bad = quality.split(df)
    assert (good.count(), bad.count()) == (1, 2)


def test_scores_and_gate(readings):
    flagged = quality.flag_readings(readings, ["n"])
    score = quality.scores(flagged).first()
    assert score["total_rows"] == 11 and score["overall_score"] == pytest.approx(300 / 11)
    with pytest.raises(quality.QualityGateError):
        quality.gate(flagged)
    assert quality.gate(flagged, 0.2).count() == 3


def test_average_scores_default_only_without_runs(spark):
    shape = "overall_score double, completeness double, validity double, uniqueness double"
    assert quality.average_scores(spark.createDataFrame([], shape)).first()["overall_score"] == 100.0
    zero = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0)], shape)
    assert quality.average_scores(zero).first()["overall_score"] == 0.0


def test_snapshot_quality_of_nothing_and_of_copies(spark):
    empty = quality.snapshot_quality(spark.createDataFrame([], "stdor_to_u string, consumption_kwh double")).first()
    assert (empty["total_rows"], empty["quality_score"], empty["completeness"]) == (0, 0.0, 100.0)
    copies = spark.createDataFrame([("Std", 1.0)] * 3 + [(None, 2.0)], "stdor_to_u string, consumption_kwh double")
    got = quality.snapshot_quality(copies).first()
    assert (got["duplicates"], got["null_tariff"], got["valid_rows"], got["uniqueness"]) == (2, 1, 1, 50.0)


def errors(spark, table, shape, *values):
    return records.validate(spark.createDataFrame([values], shape), table).first()["errors"]


def test_record_validators(spark):
    assert errors(spark, "customers", "status string", "ACTIVE") == records.NO_ID
    reading = "reading_id string, reading_value double, read_at string"
    assert errors(spark, "meter_readings", reading, "123", -50.0, "2026-01-01") == "Negative reading_value not allowed"
    assert errors(spark, "meter_readings", reading, "123", 10000000.0, "2026-01-01") == "reading_value exceeds realistic maximum"
    assert errors(spark, "meter_readings", reading, "123", 999999.0, "2026-01-01") == ""
    assert errors(spark, "meter_readings", reading, "123", 1.0, None) == "read_at timestamp is required"
    legacy = reading.replace("reading_id", "meter_reading_id")
    assert errors(spark, "meter_readings", legacy, "123", 1.0, "2026-01-01") == ""
    text = reading.replace("double", "string")
    assert errors(spark, "meter_readings", text, "123", "lots", "2026-01-01") == "reading_value must be numeric"
    assert errors(spark, "bills", "bill_id string, total_amount double", "123", -100.0) == "Financial amount cannot be negative"
    assert errors(spark, "payments", "payment_id string, amount string", "1", "x") == "Amount must be numeric"
    both = "bill_id string, total_amount double, amount double"
    assert errors(spark, "bills", both, "1", 0.0, -5.0) == "", "a zero total is an amount, not a missing one"
    assert errors(spark, "bills", "bill_id string, due_date string", "1", "0000-00-00") == "Invalid zero-timestamp in due_date"
    assert errors(spark, "customers", "customer_id string", " ") == records.NO_ID


def test_dead_letters_and_replay(spark):
    shape = "reading_id string, reading_value string, read_at string"
    df = spark.createDataFrame([("1", "bad", "2026-01-01"), (None, "5", "2026-01-01")], shape)
    bad = records.validate(df, "meter_readings").filter("errors != ''")
    letters = dlq.dead_letters(bad, "errors", "ops", "meter_readings", "2026-01-01 00:00:00")
    first = letters.collect()
    assert {r["status"] for r in first} == {"UNRESOLVED"} and {r["processing_attempt_count"] for r in first} == {1}
    assert sorted(r["dlq_id"] for r in first) == sorted(
        r["dlq_id"] for r in dlq.dead_letters(bad, "errors", "ops", "meter_readings", "2027-01-01 00:00:00").collect()
    )
    repaired = lambda x: records.validate(
        x.withColumn("reading_value", F.when(F.col("reading_value") == "bad", "7").otherwise(F.col("reading_value"))), "meter_readings"
    )
    resolved, failed = dlq.replay(letters, shape, repaired)
    assert [r["reading_value"] for r in resolved.collect()] == ["7"]
    left = failed.collect()
    assert len(left) == 1 and left[0]["processing_attempt_count"] == 2 and left[0]["status"] == "PROCESSING"


def test_long_payloads_are_cut_to_500_characters_in_events_only(spark):
    df = spark.createDataFrame([("r", "x" * 900)], "reasons string, note string")
    event = dlq.events(df, "reasons", "s", "d", ["note"]).first()
    assert len(event["payload_reference"]) == 500
    letter = dlq.dead_letters(df, "reasons", "s", "d", "2026-01-01 00:00:00").first()
    assert len(letter["original_payload"]) > 900


def test_rule_kinds(spark):
    df = spark.createDataFrame(
        [(1, "A", 5.0, None, "x"), (None, "Z", -1.0, 3, "10"), (3, None, None, 1, None)], "id int, kind string, v double, w int, t string"
    )
    kinds = [
        rules.required("id"), rules.allowed("kind", ["A", "B"]), rules.minimum("v", 0, "low"), rules.implies("w_given", "kind = 'A'", "w"),
        rules.numeric("t"), rules.ordered("id", "w"), rules.flagged_when("big", "v > 4", "big value"),
    ]
    got = rules.check(df, kinds).collect()
    assert got[0]["errors"] == "w is required when kind = 'A'; t must be numeric" and got[0]["warnings"] == "big value"
    assert got[1]["errors"] == "id is required; Invalid kind; low"
    assert got[2]["errors"] == "w is before id"
    log = {r["rule_name"]: (r["rows_checked"], r["rows_failed"]) for r in rules.run_log(df, kinds, "t", "r").collect()}
    assert log["id_required"] == (3, 1) and log["big"] == (3, 1) and log["kind_allowed"] == (3, 1)


def test_rules_of_all_tables_compile(spark):
    for table in ("customers", "accounts", "contracts", "meters", "meter_readings", "bills", "payments"):
        names = [r.name for r in rules.table_rules(table)]
        assert names and len(names) == len(set(names))
    bills = spark.createDataFrame([(-1.0, "2024-01-02", "2024-01-01")], "tax_amount double, created_at string, updated_at string")
    chosen = [r for r in rules.table_rules("bills") if r.name in ("tax_amount_min", "updated_at_after_created_at")]
    assert rules.check(bills, chosen).first()["errors"] == "tax_amount is negative; updated_at is before created_at"
    readings = spark.createDataFrame([("gallons", "GUESSED")], "unit_of_measure string, quality_flag string")
    chosen = [r for r in rules.table_rules("meter_readings") if r.name in ("unit_of_measure_allowed", "quality_flag_allowed")]
    assert rules.check(readings, chosen).first()["errors"] == "Invalid unit_of_measure; Invalid quality_flag"
