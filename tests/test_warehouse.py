"""Integrity, reconciliation, runs, marts and dimensions on small inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridtally import session
from gridtally.operators import integrity, privacy, reconcile, runs
from gridtally.plans import analytics, marts, warehouse
from gridtally.sources import staging


def d(text):
    return dt.date.fromisoformat(text)


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_orphans_include_null_references(spark, rows):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "x")], "id int, fk string")
    parent = spark.createDataFrame([("a",), ("b",)], "pk string")
    assert rows(integrity.orphans(child, parent, "fk", "pk"), "id") == [(2,), (3,), (4,)]
    assert integrity.orphan_count(child, parent, "fk", "pk", "t").first()["orphan_records"] == 3
    assert integrity.orphan_count(child.limit(0), parent, "fk", "pk", "t").first()["orphan_records"] == 0


def test_mismatches_and_order_in_time(spark, rows):
    left = spark.createDataFrame([(1, "k", "a"), (2, "k", "b"), (3, "k", None), (4, "gone", "z")], "id int, fk string, v string")
    right = spark.createDataFrame([("k", "a")], "fk string, v string")
    assert rows(integrity.mismatches(left, right, "fk", "v", "v"), "id") == [(2,)]
    events = spark.createDataFrame([(1, "m", ts("2024-01-01 23:59:59")), (2, "m", ts("2024-01-02"))], "id int, m string, at timestamp_ntz")
    owners = spark.createDataFrame([("m", d("2024-01-02"))], "m string, since date")
    assert rows(integrity.before_start(events, owners, "m", "at", "since"), "id") == [(1,)]


def test_matching_rows_of_nobody(spark):
    events = spark.createDataFrame([("m", "INTERVAL")], "m string, kind string")
    nobody = spark.createDataFrame([], "m string")
    assert tuple(integrity.matching_rows(events, nobody, "m", F.col("kind") == "INTERVAL").first()) == (0, False)


def test_count_rules(spark):
    counts = integrity.table_counts({"bills": spark.range(9), "payments": spark.range(4)})
    rules = [("half", "payments >= bills div 2"), ("same", "payments = bills")]
    assert {r["rule_name"]: r["passed"] for r in integrity.count_rules(counts, rules).collect()} == {"half": True, "same": False}


def test_reconciliation_reports_only_problems(spark, rows):
    use = spark.createDataFrame([(a, d("2024-01-10"), 5.0) for a in ("ok", "none", "zero")] + [("zero", d("2024-01-11"), 1.0)], "account string, day date, kwh double")
    bills = spark.createDataFrame(
        [("ok", d("2024-01-31"), 10.0, "PAID", 1), ("zero", d("2024-01-31"), 0.0, "ISSUED", 2), ("none", d("2024-01-31"), 9.0, "CANCELLED", 3)],
        "account string, day date, amount double, status string, bill int",
    )
    out = reconcile.metered_against_billed(
        reconcile.monthly_consumption(use, "account", "day", "kwh"),
        reconcile.monthly_billing(bills, "account", "day", "amount", "status", "bill"), "account",
    )
    assert rows(out, "account", "reconciliation_status") == [("none", "NO_BILL_ISSUED"), ("zero", "ZERO_BILL_WITH_CONSUMPTION")]


def test_variance_counts_the_last_day_of_the_period(spark):
    bills = spark.createDataFrame([("b1", "s", d("2024-01-01"), d("2024-01-31"), 10), ("b2", "s", d("2024-01-01"), d("2024-01-31"), 3)], "bill string, site string, a date, b date, billed int")
    daily = spark.createDataFrame([("s", d("2023-12-31"), 100), ("s", d("2024-01-01"), 1), ("s", d("2024-01-31"), 2), ("s", d("2024-02-01"), 100)], "site string, day date, usage int")
    got = {r["bill"]: r["variance"] for r in reconcile.billed_variance(bills, daily, "site", "a", "b", "billed").collect()}
    assert got == {"b1": 7, "b2": 0}


def test_compare_finds_swapped_keys(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "day int, id int")
    b = spark.createDataFrame([(1, 1), (1, 9), (3, 4)], "day int, id int")
    got = {r["bucket"]: (r["source_rows"], r["target_rows"], r["keys_match"]) for r in reconcile.compare(a, b, "id", F.col("day"), F.col("day")).collect()}
    assert got == {1: (2, 2, False), 2: (1, 0, False), 3: (0, 1, False)}
    assert all(r["keys_match"] for r in reconcile.compare(a, a, "id", F.col("day"), F.col("day")).collect())


def test_run_state_and_status(spark):
    log = spark.createDataFrame(
        [("r1", "RUNNING", 1, 0, "a"), ("r1", "SUCCESS", 2, 50, "b"), ("r2", "RUNNING", 3, 0, "c"), ("r3", "FAILED", 3, 0, "d"), ("r3", "RUNNING", 3, 0, "c")],
        "run_id string, status string, event_time int, rows int, event_id string",
    )
    now = {r["run_id"]: (r["status"], r["completed_at"]) for r in runs.current(log).collect()}
    assert now == {"r1": ("SUCCESS", 2), "r2": ("RUNNING", None), "r3": ("FAILED", 3)}
    got = runs.status(runs.current(log), "rows", "event_time", "Connected").first()
    assert (got["total_runs"], got["total_rows"], got["processed_resources"], got["status"]) == (3, 50, 1, "Connected")
    empty = runs.status(log.limit(0), "rows", "event_time", "Connected").first()
    assert (empty["total_runs"], empty["total_rows"], empty["status"]) == (0, 0, "Not configured")


def test_pages_do_not_overlap(spark):
    df = spark.range(10).repartition(4)
    pages = [[r["id"] for r in runs.page(df, "id", skip, 4).collect()] for skip in (0, 4, 8)]
    assert pages == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]


def test_dashboard_without_any_run(spark):
    none = spark.createDataFrame([], "rows int, status string, source string, overall_score double")
    got = runs.dashboard(none, none, none, "rows", "source").first()
    assert tuple(got) == (0, 0, 0, 0, 0.0)


def test_volume_alert_needs_a_drop_of_more_than_a_fifth(spark, rows):
    data = [("p", d("2024-01-01") + dt.timedelta(days=i), 100) for i in range(7)] + [("p", d("2024-01-08"), 80), ("p", d("2024-01-09"), 70)]
    df = spark.createDataFrame(data, "p string, day date, n int")
    assert [str(x[0]) for x in rows(runs.volume_alerts(df, "p", "day", "n"), "day")] == ["2024-01-09"]


def test_payments_do_not_multiply_bills(spark):
    bills = spark.createDataFrame([("b1", "a", d("2024-01-05"), 100.0), ("b2", "a", d("2024-01-06"), 50.0)], "bill_id string, account_id string, bill_date date, total_amount double")
    pays = spark.createDataFrame(
        [("b1", "a", ts("2024-01-07"), 30.0, "CLEARED"), ("b1", "a", ts("2024-01-08"), 30.0, "CLEARED"), ("b1", "a", ts("2024-01-08"), 9.0, "FAILED"), ("b1", "z", ts("2024-02-01"), 5.0, "CLEARED")],
        "bill_id string, account_id string, payment_date timestamp_ntz, amount double, payment_status string",
    )
    got = {(r["account_id"], str(r["month"])): tuple(r)[2:] for r in marts.revenue_monthly(bills, pays).collect()}
    assert got == {("a", "2024-01-01"): (150.0, 60.0, 0.4, 2, 2), ("z", "2024-02-01"): (0.0, 5.0, None, 0, 1)}


def test_payment_lag(spark):
    bills = spark.createDataFrame([("b1", "a", d("2024-01-01"), d("2024-01-10")), ("b2", "a", d("2024-01-01"), d("2024-01-10"))], "bill_id string, account_id string, bill_date date, due_date date")
    pays = spark.createDataFrame([("b1", ts("2024-01-12 08:00:00"), None), ("b1", ts("2024-01-11"), ts("2024-01-13"))], "bill_id string, payment_date timestamp_ntz, settled_at timestamp_ntz")
    got = {r["bill_id"]: (r["days_to_first_payment"], r["days_to_settlement"], r["is_overdue"]) for r in marts.payment_lag(bills, pays).collect()}
    assert got == {"b1": (10, 12, True), "b2": (None, None, None)}


def test_calendar(spark):
    df = spark.createDataFrame([(ts("2024-02-28 10:00:00"),), (ts("2024-03-02"),)], "at timestamp_ntz")
    got = warehouse.dim_date(df, "at").orderBy("date_sk").collect()
    assert [r["date_sk"] for r in got] == [20240228, 20240229, 20240301, 20240302]
    assert [r["is_weekend"] for r in got] == [False, False, False, True] and got[2]["quarter"] == 1
    assert warehouse.dim_date(df.limit(0), "at").count() == 0


def test_unknown_tariffs_are_described_by_their_code(spark, rows):
    df = spark.createDataFrame([("Std",), ("Std",), ("Eco",), (None,)], "stdor_to_u string")
    assert rows(warehouse.dim_tariff(df, "s"), "tariff_key", "tariff_description") == [("UKPN-ECO", "Eco"), ("UKPN-STD", "Standard Tariff (Flat Rate)")]


def test_master_data_of_a_household(spark):
    gold = spark.createDataFrame([("MAC000002", "Std", 2), ("MAC000002", "ToU", 1)], "household_id string, stdor_to_u string, n int")
    got = warehouse.master_mapping(warehouse.master_data(warehouse.households(gold, "n"))).collect()
    assert [tuple(r) for r in got] == [("MAC000002", "METER-000002", "SP-000002", "CTR-000002", "ACC-000002", "CUS-000002", "ToU")]


def test_unknown_fact_keys_are_kept_apart(spark, rows):
    facts = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "n int, k string")
    dim = spark.createDataFrame([("a", 7)], "k string, sk int")
    known, unknown = warehouse.resolve_keys(facts, dim, "k", "sk")
    assert rows(known) == [(1, "a", 7)] and rows(unknown) == [(2, None), (3, "x")]


def test_personal_data_is_replaced(spark):
    df = spark.createDataFrame([("1", "Ann", None, d("1980-05-06"), " residential ")], "customer_id string, first_name string, phone string, date_of_birth date, customer_type string")
    row = privacy.pseudonymize(df).first().asDict()
    assert row["phone_hash"] is None and len(row["first_name_hash"]) == 64 and row["date_of_birth_year"] == 1980
    assert row["customer_type"] == "RESIDENTIAL" and not {"first_name", "phone", "date_of_birth"} & set(row)


def test_staging_renames_and_prunes(spark):
    df = spark.createDataFrame([("1", "m", 2.0, "kWh", "t", "extra")], "id string, meter_id string, reading_value double, unit string, reading_timestamp string, other string")
    assert staging.stage(df, "readings").columns == ["reading_id", "meter_id", "reading_value", "unit", "reading_timestamp"]


def test_aggregates_of_no_readings(spark):
    none = spark.createDataFrame([], "household_id string, event_timestamp timestamp_ntz, consumption_kwh double, stdor_to_u string")
    assert analytics.gold_stats(none).first()["total_rows"] == 0
    for plan in (analytics.tariff_distribution, analytics.daily_series, analytics.top_households, analytics.recent_days):
        assert plan(none).count() == 0
    assert analytics.columns_of(none)[0] == "household_id"


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_orphans_of_many_references_in_one_pass_a_table(spark, rows):
    from gridtally.operators.integrity import Reference, orphan_count, orphan_counts

    parents = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None)], "id int, code string")
    children = spark.createDataFrame([(1, "a"), (1, "x"), (3, "b"), (3, None), (None, "x")] + [(9, "a")] * 50, "parent int, code string")
    empty = parents.limit(0)
    references = [
        Reference(children, "parent", parents, "id", "c.parent"),
        Reference(children, "code", parents, "code", "c.code"),
        Reference(parents, "id", children, "parent", "p.id"),
        Reference(children, "code", empty, "code", "c.none"),
        Reference(empty, "id", parents, "id", "none.id"),
    ]
    want = [rows(orphan_count(r.child, r.parent, r.child_key, r.parent_key, r.label))[0] for r in references]
    assert rows(orphan_counts(references)) == sorted(want)
    assert dict(want) == {"c.parent": 53, "c.code": 3, "p.id": 3, "c.none": 55, "none.id": 0}
