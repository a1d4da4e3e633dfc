import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridtally.llm import quality, queries, toxicity
from gridtally.llm.common import remainder

SAMPLE, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD = ["", "x", "a b " * 40_000, "y" * 600_000, "\n\n", "漢字 ퟿ ﬁ İ", "\x00\x01", " lead and trail "]


def test_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    texts = [t.encode("utf-8", "replace") for t in [*ODD, *ODD[::-1]]]
    alone = [model.score([t])[0] for t in texts]
    assert np.allclose(model.score(texts), alone, atol=1e-6)
    assert np.isfinite(alone).all() and len(model.score([])) == 0


def test_features_by_hand():
    made = quality.features([b"ab cd", b"", b"ab ab"])
    (three, b3), (four, _), (words, bw), (pairs, bp) = made
    assert (b3[:, 1] - b3[:, 0]).tolist() == [8, 3, 8] and (bw[:, 1] - bw[:, 0]).tolist() == [2, 0, 2]
    assert words[0] == words[2] == words[3] != words[1]  # "ab" wherever it stands
    assert (bp[:, 1] - bp[:, 0]).tolist() == [1, 0, 1] and pairs[bp[2, 0]] == 0
    assert three[b3[0, 0]] == three[b3[2, 0]]


def test_training_tells_two_kinds_apart():
    rng = random.Random(1)
    good, bad = ("the of and to in is was for on".split(), "### $$$ %%% &&& | *** ~~".split())
    texts = [(k % 2, " ".join(rng.choices(good if k % 2 else bad, k=30)).encode()) for k in range(200)]
    model = quality.train([(y, *quality._sparse(t)) for y, t in texts[:150]], epochs=8)
    scores = model.score([t for _, t in texts[150:]])
    assert all((s > 0.5) == bool(y) for s, (y, _) in zip(scores, texts[150:]))


@pytest.mark.parametrize("rows, low, high", [([], 0.5, 0.5), ([(1, b"", b"")] * 3, 0.9, 1.0), ([(0, b"", b"")] * 3, 0.0, 0.1)])
def test_without_both_labels_the_share_is_the_score(rows, low, high):
    assert low <= quality.train(rows).score([b"any"])[0] <= high


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    above = (scores[labels == 1][:, None] > scores[labels == 0][None, :]).mean()
    return above + 0.5 * (scores[labels == 1][:, None] == scores[labels == 0][None, :]).mean()


@pytest.mark.parametrize("name, label, part, least", [("op8_subword_quality", "quality", "0 of 5", 0.98), ("op3_toxicity_automaton", "toxic", "1 of 3", 0.8)])
def test_held_out_rows(spark, name, label, part, least):
    rows = queries.QUERIES[name](spark, LARGER)
    held, of = int(part[0]), int(part[-1])
    assert rows.where(F.col("held_out") != (remainder("doc_id", of) == held)).isEmpty()
    assert rows.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    assert rows.where("score < 0 or score > 1 or score is null").isEmpty()
    threshold = 0.3 if label == "quality" else 0.7
    assert rows.where((F.col("score") >= threshold).cast("int") != F.col("predicted")).isEmpty()
    known = rows.where("held_out").join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").select("score", label).collect()
    assert auc([r[0] for r in known], [r[1] for r in known]) >= least


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=3, max_size=9), st.booleans()), min_size=1, max_size=4, unique_by=lambda t: t[0]), st.lists(st.text("abcd", min_size=1, max_size=12), min_size=1, max_size=12))
def test_automaton_allows_the_stated_errors(terms, words):
    made = toxicity.Automaton(terms)
    text = " ".join(words)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    begin, end = toxicity.word_spans(code)
    at, what = made.read(code, begin, end)
    got = {int(i): int(w) & 3 for i, w in zip(at, what)}
    want = {}
    for i, w in enumerate(words):
        errors = []
        for term, stem in terms:
            e = min(distance(term, w[:n]) for n in range(len(w) + 1)) if stem else distance(term, w)
            if e <= toxicity.errors_allowed(term):
                errors.append(e)
        if errors:
            want[i] = min(errors)
    assert got == want


def test_hits_are_placed_and_quotes_are_seen():
    made = toxicity.Automaton([("idiot", False), ("lowei", True)])
    text = 'He said "you idiot" once.\nYou IDIOTT, Loweiwörter, İ idiot'
    (n, hits), (zero, none) = toxicity.find(made, [text, ""])
    assert [(text[h[0] : h[1]], h[3], h[4]) for h in hits] == [("idiot", 0, True), ("IDIOTT", 1, False), ("Loweiwörter", 0, False), ("idiot", 0, False)]
    assert n == 10 and (zero, none) == (0, [])


def test_quotation_lowers_the_score():
    model = toxicity.Model([("idiot", False)])
    plain, quoted = ([(0, 5, 0, 0, q, [])] for q in (False, True))
    assert model.score(20, plain) > model.score(20, quoted) > model.score(20, [])


def test_learned_stems_and_misspellings(spark, docs):
    rng = random.Random(2)
    clean = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    texts, labels = [], []
    for d in range(400):
        words, toxic = clean(40), d % 4 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["vermin", "grubel" + rng.choice(["a", "isch", "ung", "ei"])])
        texts.append((d, " ".join(words)))
        labels.append((d, int(toxic), int(toxic)))
    texts += [(1000, "what a vermn this w1 w2 w3"), (1001, "w1 w2 grubelhaft w3"), (1002, None), (1003, ""), (1004, "vermouth w5 w6"), (None, "w1")]
    known = spark.createDataFrame(labels + [(5000, 1, 1)], "doc_id long, quality int, toxic int")
    frame = docs(texts)
    model = toxicity.fit(frame, known, F.lit(True))
    assert ("vermin", False) in model.terms and ("grubel", True) in model.terms
    got = {r["doc_id"]: r for r in toxicity.score(frame, model, keep=("doc_id", "text")).collect()}
    assert got[1000]["predicted"] == got[1001]["predicted"] == 1
    assert not any(got[d]["predicted"] for d in (1002, 1003, 1004, None))
    assert all(got[d]["predicted"] == t for d, _, t in labels)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = docs([(1, "a b"), (2, None)])
    for fit, score in ((quality.fit, quality.score), (toxicity.fit, toxicity.score)):
        model = fit(some, none, F.lit(True))
        assert all(0 <= r["score"] <= 1 for r in score(some, model).collect())
        assert score(docs([]), model).collect() == []


def test_long_lexicon_keeps_its_errors():
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    terms = sorted({("".join(rng.choice(letters) for _ in range(rng.randrange(9, 12))), rng.random() < 0.2) for _ in range(200)})
    made = toxicity.Automata(terms)
    assert all(len(part.next) <= toxicity.MOST_STATES + 100 for _, part in made.parts)
    missed = []
    for k, (term, _) in enumerate(terms):
        wrong = term[:2] + "é" + term[3:-2] + term[-1]  # one character replaced, one left out
        found = toxicity.find(made, [f"{term} {wrong}"])[0][1]
        missed += [term] * ([(h[2], h[3]) for h in found] != [(k, 0), (k, 2)])
    assert not missed
    many = {f"word{i}$": 20 for i in range(300)}
    assert len(toxicity.choose_terms(many)) == 300
