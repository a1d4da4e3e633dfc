import zlib
from collections import Counter

import pytest
import xxhash

from gridtally.llm import queries, sharding

SAMPLE = "/root/testdata/sf0.001"


def network(number, rows, seed):
    """One pass in plain Python, with the same hash from another library."""
    a, b = sharding._sides(rows)
    left, right = number % a, number // a

    def f(turn, half):
        h = 42
        for value, size in ((seed, 4), (turn, 4), (half, 8)):
            h = xxhash.xxh64_intdigest(value.to_bytes(size, "little"), seed=h) if size == 8 else spark_int(value, h)
        return h - (1 << 64) if h >= 1 << 63 else h

    for turn in range(sharding.ROUNDS):
        if turn % 2 == 0:
            left = (left + f(turn, right) % a) % a
        else:
            right = (right + f(turn, left) % b) % b
    return left + right * a


def spark_int(value, seed):
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), seed=seed % (1 << 64))


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 40, 41, 99, 1000, 5003])
def test_permutation_and_its_inverse(spark, rows):
    numbers = spark.range(rows).withColumnRenamed("id", "n").selectExpr("n", "n as p")
    made = {r["n"]: r["p"] for r in sharding.permute(numbers, "p", rows, 3).collect()}
    assert sorted(made.values()) == list(range(rows))
    want = {}
    for n in range(rows):
        p = network(n, rows, 3)
        while p >= rows:
            p = network(p, rows, 3)
        want[n] = p
    assert made == want
    back = sharding.permute(sharding.permute(numbers, "p", rows, 3), "p", rows, 3, inverse=True)
    assert all(r["n"] == r["p"] for r in back.collect())


def check(rows, texts, shards):
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    want = [(d, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for d, t in texts]
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"]) for r in rows], key=key) == sorted(want, key=key)
    assert {(r["law"], r["grown_shard"]) for r in rows} <= {("rows", None)}
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter({s: 0 for s in range(shards)}) + Counter({s: len(x) for s, x in slots.items()})
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))


def test_odd_rows(docs):
    texts = [(1, "a"), (2, ""), (3, None), (None, "é"), (None, None), (5, "x" * 100_000)] + [(7, "same")] * 50 + [(100 + i, "copy") for i in range(60)]
    frame = docs(texts)
    rows = sharding.assign(frame, shards=7).collect()
    check(rows, texts, 7)
    again = sharding.assign(docs(texts, partitions=8), shards=7).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert sharding.assign(docs([])).collect() == []


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()]
    df = queries.QUERIES["op4_feistel_sharding"](spark, SAMPLE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
    check(df.collect(), texts, 40)
