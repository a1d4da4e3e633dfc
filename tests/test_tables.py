"""Versioned tables: whole versions, key lookup, merges through files."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally import session
from gridtally.operators import upsert
from gridtally.sinks.tables import Conflict, Table

SCHEMA = StructType().add("id", "string").add("day", "date").add("value", "double").add("note", "string")
HOW = upsert.Merge(["id"], ["value", "note"], upsert.differs("value"))


def rows_of(spark, rows):
    return spark.createDataFrame([(i, None, v, n) for i, v, n in rows], SCHEMA)


@pytest.fixture
def table(spark):
    return Table(spark, session.fresh_path(spark, "table"), SCHEMA, ["id"])


def content(df):
    return {r["id"]: (r["value"], r["note"]) for r in df.collect()}


def filled(spark, table, commits=8, rows=100):
    """Commits with keys of their own, dealt by a shuffle, so that ranges of keys overlap."""
    names = [f"k{i:04d}" for i in range(commits * rows)]
    random.Random(1).shuffle(names)
    for c in range(commits):
        table.append(rows_of(spark, [(k, 1.0, f"c{c}") for k in names[c * rows : (c + 1) * rows]]), f"run-{c}")
    return names


def test_empty_table(spark, table):
    assert table.version() == 0
    assert table.read().collect() == []
    assert table.history().collect() == []
    assert table.merge(rows_of(spark, [("a", 1.0, "x")]), HOW) == 1
    assert content(table.read()) == {"a": (1.0, "x")}
    assert content(table.read(0)) == {}


def test_versions_stay_readable(spark, table):
    table.append(rows_of(spark, [("a", 1.0, "x"), ("b", 2.0, "x")]), "run-1")
    table.merge(rows_of(spark, [("b", 3.0, "y"), ("c", 4.0, "y"), (None, 5.0, "no key")]), HOW, "run-2")
    assert content(table.read(1)) == {"a": (1.0, "x"), "b": (2.0, "x")}
    assert content(table.read()) == {"a": (1.0, "x"), "b": (3.0, "y"), "c": (4.0, "y")}
    assert [(r["version"], r["operation"], r["run_id"], r["rows"]) for r in table.history().orderBy("version").collect()] == [
        (1, "append", "run-1", 2),
        (2, "merge", "run-2", 3),
    ]


def test_repeated_run_replaces_its_rows(spark, table):
    table.append(rows_of(spark, [("a", 1.0, "x"), ("b", 1.0, "x")]), "run-1")
    table.append(rows_of(spark, [("c", 1.0, "x")]), "run-2")
    table.append(rows_of(spark, [("a", 2.0, "y")]), "run-1")
    assert content(table.read()) == {"a": (2.0, "y"), "c": (1.0, "x")}


@pytest.mark.parametrize("cut", ["data", "list", "name"])
def test_reader_gets_the_old_version_whole_when_a_merge_is_cut_off(spark, table, monkeypatch, cut):
    filled(spark, table, commits=2, rows=50)
    before, version = content(table.read()), table.version()
    change = rows_of(spark, [(k, 9.0, "new") for k in list(before)[:20]] + [("z", 9.0, "new")])

    def stop(*_args, **_kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if cut == "data":
            m.setattr(Table, "_write", stop)
        elif cut == "list":
            written = Table._write

            def half(self, rows, commit, run_id):
                written(self, rows, commit, run_id)
                stop()

            m.setattr(Table, "_write", half)
        else:
            m.setattr(session, "put_if_absent", stop)
        with pytest.raises(OSError):
            table.merge(change, HOW)
        assert table.version() == version
        assert content(table.read()) == before
    table.merge(change, HOW)
    assert content(table.read()) == before | {r["id"]: (9.0, "new") for r in change.collect()}


def test_of_two_writers_one_must_begin_anew(spark, table, monkeypatch):
    table.append(rows_of(spark, [("a", 1.0, "x")]), "run-1")
    base = table.version()
    assert table.commit(rows_of(spark, [("b", 1.0, "x")]), base, "append") == 2
    with pytest.raises(Conflict):
        table.commit(rows_of(spark, [("c", 1.0, "x")]), base, "append")
    assert content(table.read()) == {"a": (1.0, "x"), "b": (1.0, "x")}
    # an append is tried again by itself
    seen = iter([base, base, 2])
    monkeypatch.setattr(Table, "version", lambda self: next(seen, 2))
    assert table.append(rows_of(spark, [("c", 1.0, "x")]), "run-2") == 3
    assert content(table.read(3)) == {"a": (1.0, "x"), "b": (1.0, "x"), "c": (1.0, "x")}


def test_put_if_absent(spark):
    path = session.fresh_path(spark, "put") + "/000000000001"
    assert [session.put_if_absent(spark, path, t) for t in ("é one", "two")] == [True, False]
    assert session.read_text(spark, path) == "é one"
    assert session.names(spark, path.rsplit("/", 1)[0]) == ["000000000001"]


def test_small_batch_opens_few_files(spark, table):
    """Every file spans nearly all keys here, so that only the filters can tell them apart."""
    names = filled(spark, table, commits=12, rows=60)
    assert table.files().count() >= 12
    batch = rows_of(spark, [(names[3], 5.0, "new"), (names[10], 5.0, "new"), ("k9999", 5.0, "beyond all"), ("k0000x", 5.0, "between")])
    opened = {r["path"] for r in table.holding(batch).collect()}
    assert 1 <= len(opened) <= 2
    before = {r["path"] for r in table.files().collect()}
    table.merge(batch, HOW)
    after = {r["path"] for r in table.files().collect()}
    assert before - after == opened
    got = content(table.read())
    assert len(got) == 12 * 60 + 2
    assert {k for k, v in got.items() if v[0] == 5.0} == {names[3], names[10], "k9999", "k0000x"}


def test_no_file_with_a_key_is_missed(spark, monkeypatch, table):
    names = filled(spark, table, commits=4, rows=50)
    for at in range(0, 200, 17):
        found = table.holding(rows_of(spark, [(names[at], 0.0, "")]))
        assert names[at] in content(table.read(files=found))
    monkeypatch.setattr("gridtally.sinks.tables.LOOKED_UP", 1)
    some = rows_of(spark, [(n, 0.0, "") for n in names[:9]])
    assert set(names[:9]) <= set(content(table.read(files=table.holding(some))))


def test_insert_new(spark, table):
    names = filled(spark, table, commits=3, rows=40)
    before = {r["path"] for r in table.files().collect()}
    table.insert_new(rows_of(spark, [(names[0], 7.0, "known"), ("new", 2.0, "b"), ("new", 1.0, "a"), (None, 1.0, "no key")]), "value")
    assert before < {r["path"] for r in table.files().collect()}  # nothing is rewritten
    got = content(table.read())
    assert (got[names[0]][0], got["new"], len(got)) == (1.0, (1.0, "a"), 121)


def test_replace_by_other_columns_than_the_key(spark):
    table = Table(spark, session.fresh_path(spark, "table"), SCHEMA, ["id"], index=["note"])
    table.append(rows_of(spark, [("a", 1.0, "x"), ("b", 1.0, "x"), ("c", 1.0, "y"), ("d", 1.0, None)]), "run-1")
    stale = spark.createDataFrame([("x",), ("w",)], "note string")
    table.replace(stale, rows_of(spark, [("b", 2.0, "x")]))
    assert content(table.read()) == {"b": (2.0, "x"), "c": (1.0, "y"), "d": (1.0, None)}


def test_vacuum_keeps_what_kept_versions_read(spark, table, monkeypatch):
    names = filled(spark, table, commits=3, rows=30)
    table.merge(rows_of(spark, [(n, 2.0, "new") for n in names]), HOW)
    monkeypatch.setattr(session, "put_if_absent", lambda *_: False)
    with pytest.raises(Conflict):
        table.merge(rows_of(spark, [(names[0], 3.0, "lost")]), HOW)
    monkeypatch.undo()
    want = content(table.read())
    gone = table.vacuum(keep=1)
    assert len(gone) == 4  # three appends and the change that lost
    assert content(table.read()) == want
    assert table.version() == 4
    assert table.vacuum(keep=1) == []
    table.append(rows_of(spark, [("z", 1.0, "x")]), "run-9")
    assert set(content(table.read())) == set(want) | {"z"}


def test_stream_batches_are_known(spark, table):
    table.merge(rows_of(spark, [("a", 1.0, "x")]), HOW, applied={"feed": 4})
    table.append(rows_of(spark, [("b", 1.0, "x")]), "run-1")
    assert table.record()["applied"] == {"feed": 4}
    assert table.record(0)["applied"] == {}


def test_empty_changes(spark, table):
    filled(spark, table, commits=1, rows=10)
    before = content(table.read())
    nothing = rows_of(spark, [])
    table.merge(nothing, HOW)
    table.insert_new(nothing, "value")
    table.append(nothing, "run-none")
    table.replace(nothing, nothing)
    assert content(table.read()) == before
    assert table.read().filter(F.col("id").isNull()).count() == 0


def test_a_lookup_is_bounded_by_keys_times_files(spark, table, monkeypatch):
    """Four keys and eight overlapping files are 32 looks: above the bound all files in the range are taken, below it those of the keys."""
    names = filled(spark, table)
    inside = sorted(names)[200:600]
    batch = rows_of(spark, [(k, 0.0, "") for k in (inside[0], inside[100], inside[200], inside[-1])])
    ranges = {r["path"] for r in table.files().filter((F.col("low") <= inside[-1]) & (F.col("high") >= inside[0])).collect()}
    few = {r["path"] for r in table.holding(batch).collect()}
    monkeypatch.setattr("gridtally.sinks.tables.LOOKED_UP", 4 * len(ranges) - 1)
    assert {r["path"] for r in table.holding(batch).collect()} == ranges
    assert few < ranges
