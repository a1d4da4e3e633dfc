import math
import random

import numpy as np
import pytest

from gridtally.llm import topk


def brute(rows, k, every):
    usable = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(64 * x) for x in v]))
    made = set()
    for i, q in {(i, tuple(v)) for i, v in usable if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)[:k]
        made |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)}
    return made


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)


@pytest.mark.parametrize("scale, block", [(1.0, 8192), (1.0, 50), (30.0, 64), (1e7, 64)])
def test_against_brute_force(spark, monkeypatch, scale, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, scale) for _ in range(8)], 1) for i in range(300)]
    rows += [(400 + i, [0.5] * 8, 1) for i in range(40)]  # ties
    rows += [(900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1), (904, [], 1), (None, [1.0] * 8, 1), (960, [1.0, 2.0], 1), (-20, [1.0] * 8, 1)]
    got = {tuple(r) for r in topk.top_k(frame(spark, rows), k=7).collect()}
    assert got == brute([r[:2] for r in rows], 7, 20)


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0], 1), (20, [2.0], 1), (21, [-1.0], 1)]
    assert {tuple(r) for r in topk.top_k(frame(spark, rows)).collect()} == brute([r[:2] for r in rows], 20, 20)
    assert topk.top_k(frame(spark, [(1, [1.0], 1)])).collect() == []
    assert topk.top_k(frame(spark, [])).collect() == []
    assert topk.top_k(frame(spark, [(0, [0.0], 1)])).collect() == []


def test_proof_stops_before_the_last_segment():
    rng = np.random.default_rng(3)
    rows = np.zeros((2000, 16), np.int64)
    rows[:, 0] = rng.integers(0, 3, 2000)
    rows[:30, 0] = 4000 + np.arange(30)  # a few rows tower above the rest
    rows[:, 1] = 1000
    made = topk.Index(np.arange(2000), rows)
    query = np.zeros((1, 16), np.int64)
    query[0, :2] = 5, 1
    ids, score = made.search(np.array([-1]), query, 20)[0]
    assert ids.tolist() == list(range(29, 9, -1)) and score[0] == 5 * 4029 + 1000
    assert made.read < made.total and made.scored <= 30 * 16


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_postings_read_on_the_sample(folder):
    """On the given vectors no query needs all postings, and the rows scored instead cost less than those left out."""
    import pyarrow.parquet as pq

    table = pq.read_table(f"/root/testdata/{folder}/embeddings.parquet").to_pydict()
    usable = [(i, v) for i, v in zip(table["vec_id"], table["embedding"]) if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ids = np.array([i for i, _ in usable])
    rows = np.floor(64 * np.array([v for _, v in usable], float)).astype(np.int64)
    asked = np.flatnonzero(ids % 20 == 0)
    made = topk.Index(ids, rows)
    found = made.search(ids[asked], rows[asked], 20)
    for at, (best, score) in zip(asked[::7], found[::7]):
        full = rows @ rows[at]
        want = sorted((-s, i) for i, s in zip(ids, full) if i != ids[at])[:20]
        assert [(-s, i) for i, s in zip(best, score)] == want
    print(folder, "read", made.read / made.total, "scored", made.scored / made.total)
    assert made.read <= 0.9 * made.total
    assert made.read + made.scored < made.total
    # a bound from elsewhere saves more
    again = topk.Index(ids, rows)
    again.search(ids[asked], rows[asked], 20, np.array([s[-1] for _, s in found], float))
    assert again.read <= made.read
