import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridtally.llm import common, queries, substring_dedup

SAMPLE = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, width):
    """Words, removed words and kept text of each row, by counting all windows."""
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    made = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        made.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return made


def key(row):
    return tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in row)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 511), st.integers(0, 70000)), min_size=1, max_size=60))
def test_places_round_trip(found):
    places = np.array(sorted(t << 32 | w for t, w in found), np.int64)
    assert substring_dedup._unpacked(substring_dedup._packed(places)).tolist() == places.tolist()


def test_small_width_against_counting(docs):
    rng = random.Random(4)
    rows = []
    for d in range(120):
        text = [rng.choice("abc") for _ in range(rng.randrange(0, 30))]
        rows.append((d, rng.choice([" ", "\n", " \t "]).join(text)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "a " * 40), (None, "x y z"), (None, "x y z"), (204, "é b c\u0085d e f"), (205, "é b c\u0085d e f g")]
    rows += [(300 + k, "the same six words in here") for k in range(30)]
    for width in (1, 2, 5, 6, 9):
        got = [tuple(r)[:4] for r in substring_dedup.dedup(docs(rows), width=width).collect()]
        assert sorted(got, key=key) == sorted(brute(rows, width), key=key), width


def test_spans_are_the_removed_words(docs):
    rows = [(1, "p q a b c d r"), (2, "a b c d s"), (3, "t u")]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in substring_dedup.dedup(docs(rows), width=3).collect()}
    assert got == {1: [(2, 6)], 2: [(0, 4)], 3: []}


def test_no_documents(docs):
    assert substring_dedup.dedup(docs([])).collect() == []


def test_sample(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()]
    want = sorted((d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in brute(rows, 35))
    got = sorted(tuple(r) for r in queries.QUERIES["op10_block_anchors"](spark, SAMPLE).collect())
    assert got == want
    assert sum(r[2] for r in got) > 0


def in_tasks(spark, docs, monkeypatch, rows, width, broadcast, chunk):
    """The result of dedup, and how many packed rows each task sent to each bucket, by step."""
    sent, real = [], substring_dedup._answers

    def counted(dealt, *rest):
        by_task = dealt.groupBy(F.spark_partition_id().alias("task"), "bucket").count()
        sent.append([r["count"] for r in by_task.collect()])
        return real(dealt, *rest)

    monkeypatch.setattr(substring_dedup, "_answers", counted)
    monkeypatch.setattr(substring_dedup, "CHUNK_WINDOWS", chunk, raising=False)
    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.execution.arrow.maxRecordsPerBatch": "40"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        got = [tuple(r)[:4] for r in substring_dedup.dedup(docs(rows).coalesce(1), width=width).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return got, sent


def many_texts(n):
    rng = random.Random(7)
    rows = [(d, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20))) for d in range(n)]
    return [(d, rows[d // 3][1] if d % 3 == 1 else t + " " + t if d % 50 == 0 else t) for d, t in rows]


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_task_sends_one_packed_row_a_bucket(spark, docs, monkeypatch, broadcast):
    # a row per bucket and few texts grows with the square of the input, as buckets follow it, too
    rows = many_texts(1500)
    got, sent = in_tasks(spark, docs, monkeypatch, rows, 5, broadcast, 1 << 21)
    assert sorted(got, key=key) == sorted(brute(rows, 5), key=key)
    assert len(sent) == 2 and all(sent) and {n for step in sent for n in step} == {1}


@pytest.mark.parametrize("broadcast", [True, False])
def test_texts_of_a_group_in_several_chunks(spark, docs, monkeypatch, broadcast):
    rows = many_texts(300) + [(900, " ".join("ab" * 300)), (901, " ".join(str(n) for n in range(70000)))]
    got, sent = in_tasks(spark, docs, monkeypatch, rows, 5, broadcast, 100)
    assert sorted(got, key=key) == sorted(brute(rows, 5), key=key)
    assert max(sent[0]) > 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.tuples(st.integers(0, 63), st.integers(0, 1 << 20), st.integers(1, 1 << 20)), min_size=1, max_size=30), max_size=3))
def test_spans_round_trip(pieces):
    want, data = {}, b""
    for piece in map(sorted, pieces):
        data += substring_dedup._packed_spans(*np.array(piece).T)
        for text, begin, length in piece:
            want.setdefault(text, []).append((begin, begin + length))
    got = substring_dedup._unpacked_spans(data)
    assert {t: runs(spans) for t, spans in want.items()} == got


def runs(spans):
    made = []
    for begin, end in sorted(spans):
        if made and begin <= made[-1][1]:
            begin, end = made[-1][0], max(made.pop()[1], end)
        made.append((begin, end))
    return made


def test_turns(spark, docs, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(40)]
    rows = list(enumerate(texts + texts[:30] + [texts[0] + " z " + texts[1], "a b c", None]))
    want = [tuple(r) for r in substring_dedup.dedup(docs(rows), width=5).collect()]
    assert sorted(tuple(r[:4]) for r in want) == sorted(brute(rows, 5))
    sent, real = [], substring_dedup._answers
    monkeypatch.setattr(substring_dedup, "_answers", lambda dealt, *rest: sent.append(dealt.count()) or real(dealt, *rest))
    monkeypatch.setattr(substring_dedup, "TURN_BYTES", 2.0)
    got = [tuple(r) for r in substring_dedup.dedup(docs(rows), width=5).collect()]
    assert sorted(got) == sorted(want)
    assert len(sent) > 3 and min(sent) > 0
