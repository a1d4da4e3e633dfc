import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from gridtally.llm import queries, simhash


def print_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def component_of(prints, radius=2):
    """The least member of the component of each fingerprint."""
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in combinations(sorted(root), 2):
        if (x ^ y).bit_count() <= radius:
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def expected(rows):
    prints = [print_of(t) for _, t in rows]
    root = component_of(prints)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    return [(doc_id, f"{p:016x}", least.get(root[p])) for (doc_id, _), p in zip(rows, prints)]


def sentence(rng, size):
    return " ".join(rng.choice("Ab cd EF gh ij kl mn op qr st uv wx yz".split()) + str(rng.randrange(40)) for _ in range(size))


def texts(rng):
    made = ["", None, " \t\n", "one", "One two", "one two three", "ONE two x Été été\x0bend", "word " * 30_000]
    for _ in range(25):
        base = sentence(rng, rng.randrange(3, 300)).split()
        made += [" ".join(base), " ".join(base).upper()]
        for _ in range(3):
            base[rng.randrange(len(base))] = "changed"
            made.append("\n".join(base))
    return made


@pytest.mark.parametrize("piece", [simhash.PIECE, 50])
def test_fingerprints(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    some = texts(random.Random(1))
    got = simhash.fingerprint_of([(t or "").encode() for t in some])
    assert [int(x) for x in got] == [print_of(t) for t in some]


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("used", [0, simhash.covering_masks()[3], (1 << 64) - 1 - 0b10110001])
def test_masks_cover(used, radius):
    masks = simhash.covering_masks(used, radius)
    free = [bit for bit in range(64) if not used >> bit & 1][:24]
    assert all(m & used == used for m in masks)
    for bits in combinations(free, min(radius, len(free))):
        assert any(not any(m >> bit & 1 for bit in bits) for m in masks)


def clusters(rng, size):
    """Fingerprints in a few balls, so that buckets are large, and far ones."""
    made = set()
    for _ in range(4):
        center = rng.getrandbits(64)
        for _ in range(size):
            x = center
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            made.add(x)
    return sorted(made | {rng.getrandbits(64) for _ in range(size)} | {0, 1, 3, (1 << 64) - 1})


@pytest.mark.parametrize("bucket", [1024, 8])
def test_all_links_are_found(spark, monkeypatch, bucket):
    """Also where every bucket of a cluster is too large and must be split."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "GROUP_ROWS", 300)
    some = clusters(random.Random(2), 150)
    frame = spark.createDataFrame([(simhash._signed(x),) for x in some] * 2, "fingerprint long").repartition(3)
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame).collect()]
    root = np.arange(len(some))
    place = {x: i for i, x in enumerate(some)}
    x, y = (np.array([place[link[i]] for link in links]) for i in (0, 1))
    root = simhash._united(root, x, y)
    want = component_of(some)
    assert {x: some[root[place[x]]] for x in some} == want
    assert len(set(want.values())) > 10


def test_query(spark, docs, rows, tmp_path):
    made = list(enumerate(texts(random.Random(3)), 5)) + [(None, "alone with no id"), (None, ""), (6, "one"), (5, "")]
    docs(made).write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda t: tuple((v is not None, str(v)) for v in t)
    got = rows(queries.QUERIES["op13_covering_simhash"](spark, str(tmp_path)))
    assert got == sorted(expected(made), key=key)
    assert len({c for _, _, c in got}) < len(got) - 20


def test_empty(docs):
    assert simhash.groups(docs([(1, "x")]).where("false")).collect() == []
