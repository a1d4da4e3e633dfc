import random
import re
import zlib
from collections import Counter

import pytest

from gridtally.llm import queries, variants
from gridtally.llm.sharding import number_rows


def vocabulary_of(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def expected(vocabulary):
    near = {w: [v for v in vocabulary if one_apart(w, v)] for w in vocabulary}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best is not None and vocabulary[best] >= 5 * vocabulary[w] else None
    made = []
    for w, n in vocabulary.items():
        root = w
        while form[root]:
            root = form[root]
        made.append((w, form[w], root, n, len(near[w]), vocabulary[form[w]] if form[w] else None))
    return made


def close_words(rng, size, letters="abcé"):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.choice((6, 7, 8)))) for _ in range(size)})


@pytest.mark.parametrize("letters", ["ab", "abcdefghÿ"])
def test_machine_finds_all_pairs_once(letters):
    rng = random.Random(len(letters))
    some = sorted({"".join(rng.choice(letters) for _ in range(rng.choice((4, 5)))) for _ in range(300)})
    rows = sorted((("state", k), w + (variants.LONG if len(w) == 5 else variants.SHORT)) for k in range(2) for w in some[k::2])
    found = list(variants.near_pairs(rows))
    assert len({frozenset(p) for p in found}) == len(found)
    text = [r[1][:-1] for r in rows]
    want = {
        frozenset((i, j))
        for i in range(len(rows))
        for j in range(i)
        if rows[i][0] == rows[j][0] and max(len(text[i]), len(text[j])) == 5 and one_apart(text[i], text[j])
    }
    assert {frozenset(p) for p in found} == want
    assert want


@pytest.mark.parametrize(("group", "span"), [(200_000, 64), (60, 64), (60, 2)])
def test_nearest(spark, monkeypatch, group, span):
    """Also where initial states are crowded and ranges are halved down to one letter, and with very long words."""
    monkeypatch.setattr(variants, "GROUP_LETTERS", group)
    monkeypatch.setattr(variants, "RANGE", span)
    rng = random.Random(7)
    some = close_words(rng, 400, "abc") + ["x" * 700, "x" * 699, "x" * 300 + "y" + "x" * 399, "prefixprefix", "prefixprefiy"]
    counts = {w: rng.choice((5, 6, 30, 200)) for w in some}
    frame = number_rows(spark.createDataFrame(list(counts.items()), "word string, n long"), ["word"])
    words = {r["row"]: r["word"] for r in frame.collect()}
    got = {words[r["row"]]: (r["n_near"], r["form_n"], words[r["form_row"]]) for r in variants.nearest(frame).collect()}
    want = {}
    for w in counts:
        others = [v for v in counts if one_apart(w, v)]
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            want[w] = (len(others), counts[best], best)
    assert got == want
    assert len(want) > 150


def test_query(spark, docs, rows, tmp_path):
    rng = random.Random(8)
    some = close_words(rng, 150, "abÀÿ×") + ["language", "languages", "langage", "lamguage", "short", "Ünique", "ünique"]
    texts = []
    for w in some:
        for _ in range(rng.choice((1, 5, 8, 40, 250))):
            texts.append(w if rng.random() < 0.7 else w.upper() if w.isascii() else w)
    rng.shuffle(texts)
    texts += ["chained"] * 6 + ["chainedx"] * 40 + ["chainedxy"] * 250
    cut = [" ".join(texts[i : i + 90]) for i in range(0, len(texts), 90)]
    made = [*enumerate(cut), (None, "langage language " * 3), (None, None), (3, ""), (3, "language-languages_language9language"), (4, "language " * 20_000)]
    docs(made).write.parquet(str(tmp_path / "documents.parquet"))
    got = rows(queries.QUERIES["op12_spelling_variants"](spark, str(tmp_path)))
    key = lambda t: tuple((v is not None, str(v)) for v in t)
    assert got == sorted(expected(vocabulary_of(made)), key=key)
    assert any(r[1] and r[1] != r[2] for r in got)  # a chain of two forms at least


@pytest.mark.parametrize("texts", [[], [(1, None), (2, "")], [(1, "too rare words here")]])
def test_no_words(docs, texts):
    assert variants.groups(docs(texts)).collect() == []
