"""Clashing names, benchmark items without an id, joins beyond the broadcast bound, crowded groups."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gridtally.llm import common, line_dedup, near_dedup, quality, queries


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, 7, "mine", [1]) for i, t in rows], "doc_id long, text string, _row long, _SPANS string, aside0 array<int>")


LONG = "a line that is long enough to count as a run of its own\nand another long one after it"


@pytest.mark.parametrize("bound", [64 << 20, 0])
def test_columns_that_operators_use_themselves(spark, monkeypatch, bound):
    monkeypatch.setattr(common, "BROADCAST_BYTES", bound)
    common.prepare(spark)
    docs = clashing(spark, [(1, LONG), (2, f"x\n{LONG}"), (3, "something quite different in it")])
    made = line_dedup.dedup(docs)
    assert made.columns == [*docs.columns, "n_lines", "n_removed", "runs"]
    assert sorted((r["doc_id"], r["_row"], r["_SPANS"], r["aside0"], r["n_removed"]) for r in made.collect()) == [
        (1, 7, "mine", [1], 0), (2, 7, "mine", [1], 2), (3, 7, "mine", [1], 0),
    ]
    kept = near_dedup.one_of_each(clashing(spark, [(1, LONG), (2, LONG), (3, "something quite different in it")]))
    assert kept.columns == docs.columns
    assert sorted(tuple(r)[:3] for r in kept.collect()) == [(1, LONG, 7), (3, "something quite different in it", 7)]


def test_size_of_a_join_side(spark):
    few = spark.range(10).withColumn("spans", F.array_repeat(F.lit(1), 5)).withColumn("name", F.lit("äx"))
    many = few.withColumn("spans", F.array_repeat(F.lit(1), 100_000))
    assert 10 * 5 * 4 < common._bytes_of(few) < 10_000
    assert common._bytes_of(many) > 10 * 100_000 * 8
    assert common._bytes_of(few.limit(0)) == 0
    assert common._bytes_of(few.withColumn("spans", F.lit(None).cast("array<int>"))) > 0


def test_items_without_id_repeated_and_empty(spark, docs, tmp_path):
    items = [(None, "alpha beta"), (None, "gamma delta"), (5, "gamma delta"), (5, "epsilon zeta"), (6, ""), (7, None), (None, None), (10, " .. ")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = [(1, "alpha beta gamma"), (2, "Gamma, Delta! alpha"), (3, "epsilon zeta gamma delta alpha beta"), (4, "none of it"), (5, ""), (6, None)]
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    name = "op9_benchmark_decontamination"
    got = queries.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {r[0]: r[3] for r in want} == {1: 1, 2: 2, 3: 2, 4: 0, 5: 0, 6: 0}


def test_pairs_behind_one_passage_stay_few(spark, docs, monkeypatch):
    """Texts of ten common and four own words are never linked, and hardly any two are compared."""
    compared = []
    verified = near_dedup._verified

    def counted(pairs, words):
        compared.append(pairs.count())
        return verified(pairs, words)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    rng = random.Random(9)
    total = []
    for size in (150, 600):
        compared.clear()
        passage = [f"p{i}" for i in range(10)]
        texts = [(k, " ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(4)])) for k in range(size)]
        classes = near_dedup.class_of(docs(texts)).select("class_id").distinct().count()
        assert classes == size
        total.append(sum(compared))
        assert sum(compared[1:]) <= size  # beyond the pairs with the first text of each bucket
    assert total[1] <= 5 * total[0]


@pytest.mark.parametrize("crowd", [4, 1024])
def test_pairs_between_large_classes_are_found_in_turns(docs, monkeypatch, crowd):
    monkeypatch.setattr(near_dedup, "FIRST_PAIRS", 1)
    monkeypatch.setattr(near_dedup, "MORE_PAIRS", 2)
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(10)
    base = [f"w{i}" for i in range(20)]
    texts = []
    for k in range(40):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(20)] = f"v{rng.randrange(30)}"
        texts.append((k, " ".join(words)))
    import numpy as np

    code = {}
    arrays = [np.array([code.setdefault(w, len(code)) for w in t.split()], np.uint32) for _, t in texts]
    root = list(range(40))
    for _ in range(40):
        for i in range(40):
            for j in range(i):
                if near_dedup.within(arrays[i], arrays[j], 4) is not None:
                    root[i] = root[j] = min(root[i], root[j])
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.class_of(docs(texts)).collect()} == dict(enumerate(root))


def test_labels_without_id_or_with_two_values(spark, docs):
    common.prepare(spark)
    rng = random.Random(11)
    texts = [(i, " ".join(rng.choice(("good words here" if i % 2 else "bad junk there").split()) for _ in range(40))) for i in range(60)]
    labels = [(i, i % 2) for i in range(60)] + [(None, 1), (2, None), (3, 0), (99, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(docs(texts), frame, F.lit(True))
    got = {r["doc_id"]: r["predicted"] for r in quality.score(docs(texts), model, threshold=0.5).collect()}
    assert got == {i: i % 2 for i in range(60)}  # of two labels the larger counts
    nothing = quality.fit(docs(texts).where("false"), frame, F.lit(True))
    assert {round(r["score"], 3) for r in quality.score(docs(texts[:3]), nothing).collect()} == {0.5}


def test_near_copies_in_many_buckets_are_compared_few_times(docs, monkeypatch):
    """A class of near copies that share nearly all buckets takes two or three comparisons a text, not one a bucket."""
    compared = []
    for name in ("_verified", "_verified_pairs"):
        real = getattr(near_dedup, name, None)
        monkeypatch.setattr(near_dedup, name, lambda pairs, words, real=real: compared.append(pairs.count()) or real(pairs, words), raising=False)
    rng = random.Random(12)
    texts = []
    for k in range(120):
        words = [f"w{i}" for i in range(120)]
        for _ in range(3):
            words[rng.randrange(120)] = f"v{rng.randrange(10**6)}"
        texts.append((k, " ".join(words)))
    assert [r["class_id"] for r in near_dedup.class_of(docs(texts)).collect()] == [0] * 120
    assert sum(compared) <= 3 * 120


def test_long_texts_behind_one_passage_pass_on_no_pairs(docs, monkeypatch):
    """Texts of so many words that each bit a word is set are told apart where their words are, not as pairs."""
    compared = []
    verified = near_dedup._verified
    monkeypatch.setattr(near_dedup, "_verified", lambda pairs, words: compared.append(pairs.count()) or verified(pairs, words))
    rng = random.Random(13)
    passage = [f"p{i}" for i in range(400)]
    texts = [(k, " ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(240)])) for k in range(60)]
    assert near_dedup.class_of(docs(texts)).select("class_id").distinct().count() == 60
    assert sum(compared[1:]) <= 60


def test_bucket_rows_are_shuffled_once(spark, monkeypatch):
    plans = []

    def seen(df, label):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return df

    monkeypatch.setattr(near_dedup.session, "materialize", seen)
    rows = [(i, 5 + i % 3, i % 4, i // 8) for i in range(64)]
    made = near_dedup._shared(spark.createDataFrame(rows, "id long, n_words int, band int, key long")).collect()
    assert len(made) == 64 and {r["n"] for r in made} == {2}
    assert [p.count("ReusedExchange") for p in plans] == [1]
