import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtally.llm import near_dedup, queries
from gridtally.llm.components import components

SAMPLE = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 3), max_size=25), st.integers(0, 12))
def test_banded_alignment(a, b, limit):
    want = distance(a, b)
    assert near_dedup.within(np.array(a, np.uint32), np.array(b, np.uint32), limit) == (want if want <= limit else None)


def words(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def brute_classes(rows):
    """Class of each row by comparing all pairs; texts of under five words only when equal."""
    of = [tuple(words(t)) for _, t in rows]
    number = {w: i for i, w in enumerate({w for t in of for w in t})}
    code = [np.array([number[w] for w in t], np.uint32) for t in of]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = of[i], of[j]
            n = max(len(a), len(b))
            if a == b or (min(len(a), len(b)) >= 5 and min(len(a), len(b)) >= 0.8 * n and near_dedup.within(code[i], code[j], int(0.2 * n + 1e-9)) is not None):
                root[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        names.setdefault(find(i), []).append(d)
    return {d: min(x for x in names[find(i)] if x is not None) for i, (d, _) in enumerate(rows) if d is not None}


def test_sample_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op6_order_minhash"](spark, SAMPLE).collect()}
    want = brute_classes(rows)
    # a link between texts that are barely alike may have no sketch in common
    assert set(got) == set(want)
    missed = [d for d in want if got[d] != want[d]]
    assert len(missed) <= 0.01 * len(want)
    assert all(want[got[d]] == want[d] for d in got)  # nothing is linked that should not be


def varied(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.randrange(len(out))
        out[k : k + 1] = rng.choice([[], ["new%d" % rng.randrange(99)], [out[k], "more"]])
    return " ".join(out)


def test_groups_and_odd_rows(docs, rows):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(3000)}" for _ in range(200)] for _ in range(4)]
    texts, group = [], {}
    for g, (words_, size) in enumerate(zip(base, (2, 5, 60, 1))):
        for k in range(size):
            d = 100 * g + k
            texts.append((d, varied(rng, words_, 3 if k else 0)))
            group[d] = 100 * g
    # the same long passage in otherwise different texts
    passage = [f"p{i}" for i in range(80)]
    for k in range(40):
        d = 1000 + k
        texts.append((d, " ".join(passage + [f"q{rng.randrange(9999)}" for _ in range(120)])))
        group[d] = d
    texts += [(2000, ""), (2001, None), (2002, " .,; "), (2003, "one two"), (2004, "One, two!"), (2005, "one two three"), (2006, "x " * 4000), (2007, "x " * 3990)]
    group |= {2000: 2000, 2001: 2000, 2002: 2000, 2003: 2003, 2004: 2003, 2005: 2005, 2006: 2006, 2007: 2006}
    texts += [(3000, "the very same row of text")] * 3
    group[3000] = 3000
    got = near_dedup.class_of(docs(texts)).collect()
    assert len(got) == len(texts)
    assert {r["doc_id"]: r["class_id"] for r in got} == group
    kept = near_dedup.one_of_each(docs(texts))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "words"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(group.values()))


def test_no_documents(docs):
    assert near_dedup.class_of(docs([])).collect() == []
    assert near_dedup.one_of_each(docs([])).collect() == []


def test_null_ids(docs):
    got = near_dedup.one_of_each(docs([(None, "a b c d e f"), (5, "a b c d e f"), (None, "quite another text")])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, "quite another text"), (5, "a b c d e f")]


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(2)
    links = {"chain": [(i, i + 1) for i in range(70)], "star": [(0, i) for i in range(1, 90)], "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]}[shape]
    root = {x: x for link in links for x in link}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


def swapped(rng, text, share):
    """``text`` with a share of its words replaced."""
    out = list(text)
    for k in rng.sample(range(len(out)), int(share * len(out))):
        out[k] = "new%d" % rng.randrange(99999)
    return out


def test_near_pairs_behind_one_passage(docs):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(160)]
    texts, group = [], {}
    for k in range(400):
        pair = k % 2 and k < 200  # every second of the first 200 is a near copy of the one before
        own = swapped(rng, own, 0.25) if pair else [f"q{rng.randrange(5000)}" for _ in range(100)]
        texts.append((k, " ".join(passage + own)))
        group[k] = k - 1 if pair else k
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.class_of(docs(texts)).collect()} == group


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9])
def test_sketches_of_near_pairs(similarity):
    rng = random.Random(6)
    pairs = [[f"w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 120, 300]))] for _ in range(400)]
    texts = [" ".join(t) for a in pairs for t in (a, swapped(rng, a, 1 - similarity + 1e-9))]
    made = near_dedup.sketches(*near_dedup.word_runs(texts))
    assert (made[::2] == made[1::2]).any(axis=1).mean() >= 0.99


def test_bucket_rows_are_not_stored_again(docs, monkeypatch):
    rng = random.Random(7)
    base = [[f"w{rng.randrange(3000)}" for _ in range(120)] for _ in range(30)]
    # 29 pairs, whose buckets are small, and one group with large ones, in which ten texts stay apart
    texts = [(2 * k + j, varied(rng, words_, 2 * j)) for k, words_ in enumerate(base[1:]) for j in (0, 1)]
    texts += [(100 + j, varied(rng, base[0], 2 * bool(j))) for j in range(40)]
    texts += [(200 + j, " ".join(base[0][:100] + [f"q{rng.randrange(9999)}" for _ in range(80)])) for j in range(10)]
    texts += [(300 + j, texts[j][1]) for j in range(5)]
    stored, store = {}, near_dedup.session.materialize

    def kept(df, label):
        out = store(df, label)
        stored.setdefault(label, []).append(out)
        return out

    monkeypatch.setattr(near_dedup.session, "materialize", kept)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.class_of(docs(texts)).collect()}
    assert got == {d: d // 2 * 2 if d < 100 else 100 if d < 200 else d if d < 300 else (d - 300) // 2 * 2 for d, _ in texts}
    # sketches are stored once, and only texts of large buckets are given roots row by row
    assert [label for label, tables in stored.items() for t in tables if "sketch" in t.columns] == ["sketches"]
    large = {r["key"]: r["n"] for r in stored["rooted"][0].select("key", "n").collect()}
    assert large and min(large.values()) > near_dedup.ALL_PAIRS


def test_buckets_hold_all_texts_that_share_a_sketch(spark):
    rng = random.Random(8)
    sketches = [[rng.randrange(-(2**40), 2**40) if rng.random() < 0.5 else rng.randrange(3) - 1 for _ in range(48)] for _ in range(30)]
    want = [[i for i, s in enumerate(sketches) if s[b] == v] for b in range(48) for v in {s[b] for s in sketches}]
    rows = [(i, 10 + i, b, v) for i, s in enumerate(sketches) for b, v in enumerate(s)]
    got = {}
    for r in near_dedup._shared(spark.createDataFrame(rows, "id long, n_words int, band int, key long")).collect():
        assert len(r["m"]) == (r["n"] if r["n"] <= near_dedup.ALL_PAIRS else 1)
        assert r["m"][r["at"]]["id"] == r["id"]
        got.setdefault(r["key"], []).append(r["id"])
    assert sorted(map(sorted, got.values())) == sorted(w for w in want if len(w) > 1)
