"""Compacted events, files announced by messages, and replays of files that could not be read."""

import gzip
import json

from gridtally import session
from gridtally.operators import cdc
from gridtally.sources import changes as sources
from gridtally.streaming import changes

ARRIVED = "2026-01-01 00:00:00"


def record(key, at=0, kind="UPDATE"):
    meta = {"change_type": kind, "table": "customers", "timestamp": f"2025-01-01T00:{at:02d}:00Z"}
    return json.dumps({"customer_id": str(key), "note": f"n{at}", "_metadata": meta})


def notes(spark, out):
    return {(r["source_primary_key"], r["operation"]): json.loads(r["payload"])["note"] for r in changes.events(spark, out).collect()}


def test_stored_runs_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(changes, "RUNS", 2)
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    want = {}
    for n in range(7):
        # every batch has a key of its own and a newer state of a common one; one comes out of order
        at = 50 if n == 2 else n
        (source / f"{n}.txt").write_text(f"{record('own%d' % n, n)}\n{record('common', at)}\n")
        want[(f"own{n}", "UPDATE")] = f"n{n}"
    want[("common", "UPDATE")] = "n50"
    changes.run_split(spark, str(source), out, str(tmp_path / "at"), ARRIVED, files_per_batch=1)
    assert notes(spark, out) == want
    runs = {level: session.names(spark, f"{out}/events/{level}") for level in session.names(spark, f"{out}/events") if level.startswith("level=")}
    assert set(runs) == {"level=0", "level=1", "level=2"}
    assert all(len([r for r in names if r.startswith("run=")]) <= 3 for names in runs.values())
    # a batch that is made again, its compactions included, changes nothing
    for number in (6, 5):
        changes._take(spark, out, number, [str(source / f"{number}.txt")], ARRIVED, False)
        assert notes(spark, out) == want


def test_announced_files_are_read_once(spark, tmp_path):
    store, told, out = tmp_path / "store", tmp_path / "told", str(tmp_path / "out")
    store.mkdir()
    told.mkdir()
    for n in range(3):
        (store / f"f{n}.txt").write_text(record(n) + "\n")
    message = lambda n: json.dumps({"bucket": "b", "name": f"f{n}.txt"})
    (told / "1.json").write_text("\n".join([message(0), message(0), message(1), '{"bucket": "b"}', "no json"]))

    def run():
        stream = sources.notification_stream(spark, str(told), 1)
        changes.write_notified(stream, out, str(tmp_path / "at"), ARRIVED, {"gs://b": str(store)}).awaitTermination()
        return changes.counters(spark, None, out).first().asDict()

    assert run() == {"notifications": 3, "files_read": 2, "read_errors": 0, "processed": 2, "invalid": 0}
    (told / "2.json").write_text("\n".join([message(1), message(2)]))
    assert run() == {"notifications": 5, "files_read": 3, "read_errors": 0, "processed": 3, "invalid": 0}
    assert set(notes(spark, out)) == {(str(n), "UPDATE") for n in range(3)}


def test_files_that_landed_whole_later_are_replayed(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    whole = gzip.compress("\n".join(record(n, n % 60) for n in range(2000)).encode())
    (source / "late.txt.gz").write_bytes(whole[: len(whole) // 2])
    (source / "bad.txt.gz").write_bytes(b"never an archive")
    (source / "fine.txt").write_text(record("x", 3) + "\nno json\n")
    changes.run_split(spark, str(source), out, str(tmp_path / "at"), ARRIVED)
    before = {"notifications": 3, "files_read": 1, "read_errors": 2, "processed": 2, "invalid": 1}
    assert changes.counters(spark, str(source), out).first().asDict() == before
    assert changes.replay(spark, out, ARRIVED) == 0
    assert changes.counters(spark, str(source), out).first().asDict() == before
    (source / "late.txt.gz").write_bytes(whole)
    assert changes.replay(spark, out, ARRIVED) == 1
    assert changes.counters(spark, str(source), out).first().asDict() == {**before, "files_read": 2, "read_errors": 1, "processed": 2002}
    assert len(notes(spark, out)) == 2001
    assert [r["path"].rsplit("/")[-1] for r in changes.unread(spark, out).collect()] == ["bad.txt.gz"]
    assert changes.replay(spark, out, ARRIVED) == 0
    assert changes.errors(spark, out).count() == 1


def test_state_after_any_number_of_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    rows = [record(n % 5, n, "DELETE" if n % 7 == 0 else "UPDATE") for n in range(18)]
    for n, row in enumerate(rows):
        (source / f"{(n * 7) % 18:02d}.txt").write_text(row + "\n")
    changes.run_split(spark, str(source), out, str(tmp_path / "at"), ARRIVED, files_per_batch=2)
    everything = cdc.valid(cdc.normalize(spark.createDataFrame([(r,) for r in rows], "value string"), ARRIVED))
    state = lambda events: sorted(map(str, changes.current_state(events).collect()))
    assert state(changes.events(spark, out)) == state(cdc.latest_events(everything))
