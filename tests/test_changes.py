import datetime as dt
import json

import pytest

from gridtally import schemas
from gridtally.operators import cdc, evolve
from gridtally.sources import changes, extracts
from gridtally.streaming import changes as stream

ARRIVED = "2026-10-06 12:05:00"
META = {"change_type": "INSERT", "table": "customers", "schema": "utility", "timestamp": "2026-10-06T12:00:00Z"}


def lines(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def normalized(spark, *records, guess=False):
    return cdc.normalize(lines(spark, *records), ARRIVED, guess).collect()


def test_valid_record(spark):
    record = {"customer_id": "c200c821-1234", "status": "ACTIVE", "first_name": "John", "last_name": "Doe", "_metadata": META}
    row = normalized(spark, record)[0]
    assert row["error"] is None
    assert (row["source_table"], row["operation"], row["source_primary_key"]) == ("customers", "INSERT", "c200c821-1234")
    assert row["event_timestamp"] == dt.datetime(2026, 10, 6, 12) and row["schema_version"] == "1.0"
    assert json.loads(row["payload"]) == {k: v for k, v in record.items() if k != "_metadata"}


def test_payload_keeps_value_types(spark):
    record = {"meter_id": "M", "n": 5, "x": 1.25, "flag": True, "none": None, "nested": {"b": 1, "a": [1, "2"]}, "_metadata": {**META, "table": "meters"}}
    assert json.loads(normalized(spark, record)[0]["payload"]) == {k: v for k, v in record.items() if k != "_metadata"}


def test_invalid_records(spark):
    bare = {"customer_id": "c200c821-1234", "status": "ACTIVE"}
    got = [
        r["error"]
        for r in normalized(
            spark, bare, "nope", "[1]", {"customer_id": "", "_metadata": META}, {"customer_id": "1", "_metadata": {"table": "customers"}},
            {"customer_id": "1", "_metadata": {"table": "", "change_type": "INSERT"}}, {"_metadata": META},
        )
    ]
    assert "Missing required _metadata fields" in got[0] and got[1] == got[2] == cdc.NOT_AN_OBJECT
    assert got[3] == cdc.NO_KEY and got[4] == got[5] == cdc.NO_METADATA and got[6] == cdc.NO_KEY


def test_zero_is_a_key(spark):
    assert normalized(spark, {"customer_id": 0, "_metadata": META})[0]["source_primary_key"] == "0"


def test_delete_without_time_uses_arrival(spark):
    row = normalized(spark, {"customer_id": "c", "_metadata": {"change_type": "DELETE", "table": "customers"}})[0]
    assert row["event_timestamp"] == row["ingestion_timestamp"] == dt.datetime(2026, 10, 6, 12, 5)


def test_keys_by_table_and_by_guessing(spark):
    reading = {"reading_id": "r1", "meter_id": "m1", "_metadata": {**META, "table": "meter_readings"}}
    unknown = {"code": "x9", "value": 1, "_metadata": {**META, "table": "codes"}}
    assert [r["source_primary_key"] for r in normalized(spark, reading, unknown)] == ["r1", "x9"]
    assert [r["source_primary_key"] for r in normalized(spark, reading, unknown, guess=True)] == ["m1", "x9"]


def test_repeated_deliveries_collapse_but_operations_stay(spark):
    update = {"customer_id": "c", "status": "B", "_metadata": {**META, "change_type": "UPDATE"}}
    insert = {"customer_id": "c", "status": "A", "_metadata": META}
    events = cdc.valid(cdc.normalize(lines(spark, insert, insert, update), ARRIVED))
    assert sorted(r["operation"] for r in cdc.latest_events(events).collect()) == ["INSERT", "UPDATE"]
    assert [r["source_primary_key"] for r in stream.current_state(events).collect()] == ["c"]


def test_typed_payload_turns_bad_values_into_null(spark):
    record = {"reading_id": "r", "reading_value": "lots", "n": 3, "_metadata": {**META, "table": "meter_readings"}}
    events = cdc.valid(cdc.normalize(lines(spark, record), ARRIVED))
    row = cdc.typed(events, {"reading_value": "double", "n": "int", "absent": "string"}, "meter_readings").first()
    assert (row["reading_value"], row["n"], row["absent"]) == (None, 3, None)


def test_notifications(spark):
    df = lines(spark, {"bucket": "b", "name": "p/f.json"}, {"bucket": "b"}, {"name": "n", "bucket": ""}, "not json")
    assert [r["path"] for r in changes.notified_paths(df).collect()] == ["gs://b/p/f.json"]


def test_pages(spark):
    pages = [(1, '{"data":[{"temp":70},{"temp":72}]}'), (2, '[{"temp":75}]'), (3, '{"data":[]}'), (4, "[]"), (5, "{}"), (6, "oops")]
    df = spark.createDataFrame(pages, "page int, body string")
    item = spark.createDataFrame([], "temp int").schema
    assert sorted((r["page"], r["temp"]) for r in extracts.unnest_pages(df, "body", item).collect()) == [(1, 70), (1, 72), (2, 75)]


def registry(spark, version, **fields):
    return spark.createDataFrame([("customers", version, f, t) for f, t in fields.items()], "table_name string, version int, field string, dtype string")


def proposed(spark, **fields):
    return registry(spark, 0, **fields).drop("version")


def test_schema_evolution(spark):
    first, grown = evolve.evolve(registry(spark, 0).limit(0), proposed(spark, customer_id="str", name="str"))
    assert grown == ["customers"] and {r["version"] for r in first.collect()} == {0}
    second, grown = evolve.evolve(first, proposed(spark, customer_id="str", name="str", email="str"))
    assert grown == ["customers"] and evolve.latest(second).select("version").first()[0] == 1
    same, grown = evolve.evolve(second, proposed(spark, customer_id="str", name="str", email="str"))
    assert grown == [] and same.count() == second.count()
    with pytest.raises(evolve.IncompatibleSchemaError, match="changed type from int to str"):
        evolve.evolve(registry(spark, 0, customer_id="str", age="int"), proposed(spark, customer_id="str", age="str"))
    with pytest.raises(evolve.IncompatibleSchemaError, match="was removed. This is a breaking change."):
        evolve.evolve(registry(spark, 0, customer_id="str", age="int"), proposed(spark, age="int"))


def test_other_tables_of_the_registry_are_left_alone(spark):
    two = registry(spark, 0, customer_id="str").unionByName(
        spark.createDataFrame([("meters", 3, "meter_id", "str")], "table_name string, version int, field string, dtype string")
    )
    out, grown = evolve.evolve(two, proposed(spark, customer_id="str", email="str"))
    assert grown == ["customers"] and out.filter("table_name = 'meters'").count() == 1


def test_payload_types(spark):
    fields = registry(spark, 0, customer_id="str", age="int", score="float")
    bodies = [
        ("ok", '{"customer_id":"a","age":3,"score":2}'), ("missing", '{"customer_id":"a"}'), ("null", '{"customer_id":null,"age":null}'),
        ("extra", '{"customer_id":"a","other":1}'), ("bad", '{"customer_id":5,"age":"3","score":"x"}'),
    ]
    df = spark.createDataFrame([(i, "customers", b) for i, b in bodies], "id string, source_table string, payload string")
    got = sorted((r["id"], r["error"]) for r in evolve.type_errors(df, fields, "id").collect())
    assert got == [
        ("bad", "Field 'age' expected int, got str"), ("bad", "Field 'customer_id' expected str, got int"), ("bad", "Field 'score' expected float, got str"),
    ]


def test_old_and_new_records_read_together(spark):
    old = spark.createDataFrame([("1",)], "customer_id string")
    new = spark.createDataFrame([("2", "a@b")], "customer_id string, email string")
    assert sorted(map(tuple, evolve.read_together(old, new).collect())) == [("1", None), ("2", "a@b")]


def test_stream_over_several_files_and_restarts(spark, tmp_path):
    def drop(name, *records):
        (tmp_path / "in").mkdir(exist_ok=True)
        body = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records)
        (tmp_path / "in" / name).write_text(body + "\n\n")

    def customer(key, status, at):
        return {"customer_id": key, "status": status, "_metadata": {**META, "timestamp": at}}

    def run():
        stream.run_split(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), ARRIVED, files_per_batch=1)

    drop("a.json", customer("1", "A", "2026-01-01T00:00:00Z"), "broken", customer("2", "A", "2026-01-01T00:00:00Z"))
    drop("b.json", customer("1", "B", "2026-02-01T00:00:00Z"))
    run()
    drop("c.json", customer("2", "OLD", "2025-01-01T00:00:00Z"))
    run()
    run()
    events = {r["source_primary_key"]: json.loads(r["payload"])["status"] for r in stream.events(spark, str(tmp_path / "out")).collect()}
    assert events == {"1": "B", "2": "A"}
    assert [r["raw"] for r in stream.errors(spark, str(tmp_path / "out")).collect()] == ["broken"]
    stored = spark.read.schema(schemas.CHANGE_EVENT).parquet(str(tmp_path / "out" / "events"))
    assert stored.count() == 4


def test_counters_are_observed(spark, tmp_path):
    normalized_df, seen = stream.batch_counters(cdc.normalize(lines(spark, "x", {"customer_id": "1", "_metadata": META}), ARRIVED))
    normalized_df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"processed": 2, "invalid": 1}


def test_stream_counters(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("x\n" + json.dumps({"customer_id": "1", "_metadata": META}) + "\n")
    out = str(tmp_path / "out")
    stream.run_split(spark, str(tmp_path / "in"), out, str(tmp_path / "check"), ARRIVED)
    seen = stream.counters(spark, str(tmp_path / "in"), out).first()
    assert (seen["processed"], seen["invalid"], seen["files_read"], seen["read_errors"]) == (2, 1, 1, 0)


def test_lag(spark):
    events = cdc.valid(cdc.normalize(lines(spark, {"customer_id": "1", "_metadata": META}), ARRIVED))
    assert cdc.lag(events).first()["max_lag_seconds"] == 300
    assert cdc.counters(cdc.normalize(lines(spark, "x"), ARRIVED)).first()["invalid"] == 1


def test_snapshot_and_changes(spark):
    snap = spark.createDataFrame([("1", "a", 1), ("2", "a", 1), ("3", "a", 9)], "k string, v string, t int")
    feed = spark.createDataFrame([("1", "b", 1, "UPDATE"), ("2", None, 5, "DELETE"), ("3", "late", 2, "UPDATE"), ("4", "n", 1, "INSERT")], "k string, v string, t int, operation string")
    out = cdc.unify(snap, feed, ["k"], "t")
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [("1", "b"), ("3", "a"), ("4", "n")]


def test_growing_a_registry_reads_its_proposal_once(spark):
    """What is proposed may stand for all events, so it is computed once."""
    read = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    fields = [("meters", "meter_id", "str"), ("meters", "status", "str")]
    shape = "table_name string, field string, dtype string"
    proposed = spark.createDataFrame(fields, shape).mapInArrow(rows, shape)
    registry = spark.createDataFrame([("meters", 0, "meter_id", "str")], "table_name string, version int, field string, dtype string")
    grown, tables = evolve.evolve(registry, proposed)
    assert tables == ["meters"]
    assert sorted(map(tuple, grown.collect())) == [("meters", 0, "meter_id", "str"), ("meters", 1, "meter_id", "str"), ("meters", 1, "status", "str")]
    assert read.value == 2
