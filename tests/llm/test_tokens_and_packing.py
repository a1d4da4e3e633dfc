import random
import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtally.llm import binary_ids, packing, queries, tokens

SAMPLE = "/root/testdata/sf0.001"
ODD = [
    "", "a", "  two  blanks ", "Émile's l'été ÀÉ", "ΣΑΣ Σ", "İstanbul", "é café", "<|endoftext|> x <|ENDOFTEXT|>",
    "tab\there\nnew\r\nline nbsp em\u0085nel", "漢字 かな", "x" * 5000, "it's they're we'll 123 $$$ ###", "\x1c\x1d a",
]


def whole_ids(texts, end=1):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


def test_pieces_give_the_ids_of_the_whole_text():
    e = tokens.Encoder(tokens.default_path(), 1)
    assert [tokens.as_ids(x).tolist() for x in e.encode(ODD)] == whole_ids(ODD)
    assert [tokens.as_ids(x).tolist() for x in e.encode(ODD)] == whole_ids(ODD)


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 4)
    e = tokens.Encoder(tokens.default_path(), 1)
    for _ in range(3):
        assert [tokens.as_ids(x).tolist() for x in e.encode(ODD)] == whole_ids(ODD)


def best_fit_decreasing(sizes, capacity):
    room = []
    for n in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(capacity - n)
    return len(room)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_is_best_fit_decreasing(sizes):
    histogram = {n: sizes.count(n) for n in set(sizes)}
    planned = packing.plan(histogram, 40)
    planned = planned[np.lexsort((planned[:, 1], planned[:, 0]))]
    keys = (planned[:, 0] << packing._RANK_BITS) + planned[:, 1]
    lengths = np.array(sorted(sizes), np.int64)
    ranks = np.array([i - np.searchsorted(lengths, n) for i, n in enumerate(lengths)], np.int64)
    if not len(sizes):
        return
    sequence, offset = packing.place(planned, keys, lengths, ranks)
    check_gapless(zip(sequence.tolist(), offset.tolist(), lengths.tolist()), 40)
    assert len(set(sequence.tolist())) == best_fit_decreasing(sizes, 40)


def check_gapless(pieces, capacity):
    filled = {}
    for s, o, n in sorted(pieces):
        assert o == filled.get(s, 0)
        filled[s] = o + n
    assert all(n <= capacity for n in filled.values())
    return filled


def check_packing(rows, texts, capacity):
    want = []
    for i, t in texts:
        ids = whole_ids([t])[0]
        want += [(i, k, a, len(ids[a : a + capacity]), crc(ids[a : a + capacity])) for k, a in enumerate(range(0, len(ids), capacity))]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    filled = check_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows], capacity)
    assert len(filled) == best_fit_decreasing([w[3] for w in want], capacity)


def test_packing_small(docs):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (3, "a"), (3, "a"), (3, "a")] + [(100 + i, "same text here") for i in range(90)]
    check_packing(packing.pack(docs(texts), capacity=64).collect(), texts, 64)
    assert packing.pack(docs([]), capacity=64).collect() == []
    assert packing.pack(docs([]), capacity=64).columns[-2:] == ["sequence_id", "offset"]


def test_sequences_hold_the_ids(docs):
    texts = [(i, t) for i, t in enumerate(ODD)]
    made = packing.sequences(docs(texts), packing.pack(docs(texts), capacity=64), capacity=64).collect()
    assert sorted(x for r in made for x in r["ids"]) == sorted(x for ids in whole_ids(ODD) for x in ids)
    assert all(len(r["ids"]) <= 64 for r in made)


@pytest.mark.parametrize("name", ["op1_best_fit_packing", "op2_simple8b_ids"])
def test_queries_on_the_sample(spark, name):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()]
    rows = queries.QUERIES[name](spark, SAMPLE).collect()
    if name.startswith("op1"):
        check_packing(rows, texts, 4096)
    else:
        check_starts(rows, texts)


def check_starts(rows, texts):
    start, want = 0, []
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = whole_ids([t])[0]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2**64 - 1), st.just(2**60), st.just(2**60 - 1)), max_size=300), max_size=5))
def test_words_round_trip(runs):
    flat = np.array([x for r in runs for x in r], np.uint64)
    words, offsets, escapes = binary_ids.pack_words(flat, np.array([len(r) for r in runs], np.int64))
    assert binary_ids.unpack_words(words, escapes).tolist() == flat.tolist()
    at = 0
    for r in runs:  # each segment can be read on its own
        for k in range(0, len(r), binary_ids.SEGMENT):
            part = words[int(offsets[at]) : int(offsets[at + 1])]
            assert binary_ids.unpack_words(part, escapes).tolist() == r[k : k + binary_ids.SEGMENT]
            at += 1


def test_files_round_trip(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(binary_ids, "BLOCK_BYTES", 200)
    monkeypatch.setattr(binary_ids, "FILE_BLOCKS", 2)
    rng = random.Random(1)
    texts = [(5 * i - 20, t) for i, t in enumerate(ODD)] + [(None, None)] + [(1000 + i, " ".join(rng.choices(["one", "Two,", "thréé"], k=i))) for i in range(60)]
    folder = str(tmp_path / "ids")
    binary_ids.write(docs(texts), folder)
    check_starts([tuple(r) for r in binary_ids.index(spark, folder).collect()], texts)
    ids = {r["doc_id"]: r["ids"] for r in binary_ids.read(spark, folder, keep_ids=True).collect()}
    assert ids == {i: whole_ids([t])[0] for i, t in texts}


def test_no_documents(spark, docs, tmp_path):
    folder = str(tmp_path / "ids")
    binary_ids.write(docs([]), folder)
    assert binary_ids.index(spark, folder).collect() == []


def test_repeated_rows(spark, docs, tmp_path):
    folder = str(tmp_path / "ids")
    binary_ids.write(docs([(1, "a b")] * 5), folder)
    assert sorted(r["start"] for r in binary_ids.index(spark, folder).collect()) == [0, 3, 6, 9, 12]
