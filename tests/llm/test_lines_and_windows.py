import hashlib
import random
import re

from compare import difference, sql_connection
import pytest

from gridtally.llm import decontaminate, line_dedup, queries

SAMPLE = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_hits(docs, items, width):
    wins = {}
    for i, t in items:
        w = WORD.findall(fold(t))
        for k in range(max(1, len(w) - width + 1) if w else 0):
            wins.setdefault(tuple(w[k : k + width]), set()).add(None if i is None else str(i))
    made = []
    for d, t in docs:
        found = [m.span() for m in WORD.finditer(fold(t))]
        w = [fold(t)[a:b] for a, b in found]
        hit, ids, spans = set(), set(), set()
        for n in {len(win) for win in wins}:
            for k in range(len(w) - n + 1):
                owners = wins.get(tuple(w[k : k + n]))
                if owners:
                    hit.update(range(k, k + n))
                    ids |= owners
                    spans |= {(o, found[k][0], found[k + n - 1][1]) for o in owners}
        made.append((d, len(w), len(hit), sorted(ids, key=null_first), sorted(spans, key=str), bool(hit) and 20 * len(hit) >= len(w)))
    return made


def null_first(item):
    return item is not None, item or ""


DOCS = [
    (1, "Alpha BETA, gamma! delta"), (2, "x alphabeta gamma delta"), (3, None), (4, ""), (5, " ...!? "), (6, "ÉCOLE école 漢字 beta gamma"),
    (7, "beta gamma " * 30), (7, "beta gamma " * 30), (None, "gamma delta"), (8, "one\x00two beta-gamma"), (9, "w " * 100 + "beta gamma"), (10, "gamma beta"),
]
ITEMS = [(1, "alpha beta gamma"), (2, "Beta Gamma"), (2, "gamma DELTA"), (3, ""), (4, None), (None, "gamma beta"), (11, "école 漢字"), (5, "delta!")]


@pytest.mark.parametrize("group_bytes", [1 << 20, 12])
def test_hits_against_brute_force(spark, docs, group_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [
        (r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], sorted(((s["item_id"], s["start"], s["end"]) for s in r["spans"]), key=str), r["contaminated"])
        for r in decontaminate.scan(docs(DOCS), items, width=2, group_bytes=group_bytes).collect()
    ]
    assert sorted(got, key=str) == sorted(brute_hits(DOCS, ITEMS, 2), key=str)


def test_no_items_and_no_documents(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_hit"], r["contaminated"]) for r in decontaminate.scan(docs([(1, "a b")]), none).collect()] == [(0, False)]
    assert decontaminate.scan(docs([]), none).collect() == []
    assert decontaminate.scan(docs([(1, "a")]), none, keep=("doc_id", "text", "shard")).columns[:3] == ["doc_id", "text", "shard"]


def brute_lines(rows, least):
    """Kept texts when every repeated run of at least ``least`` characters loses its later copies."""
    first, split = {}, [(t.split("\n") if t is not None else []) for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    made = {}
    for i in order:
        lines, gone = split[i], set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(lines[a : b + 1])
                if sum(map(len, run)) < least:
                    continue
                if run in first and first[run] != (i, a):
                    gone.update(range(a, b + 1))
                first.setdefault(run, (i, a))
        text = None if rows[i][1] is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        made[i] = (rows[i][0], len(lines), len(gone), text)
    return list(made.values())


def test_line_runs_against_brute_force(docs):
    rng = random.Random(6)
    for least in (1, 5, 9):
        rows = [(d, "\n".join(rng.choice(["aaa", "bb", "cccc", "", f"u{rng.randrange(50)}"]) for _ in range(rng.randrange(1, 9)))) for d in range(60)]
        rows += [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "same line here"), (104, "same line here"), (105, "é" * 9), (106, "é" * 9), (107, "aaa\n" * 40)]
        got = [(r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup.dedup(docs(rows, partitions=1), least).collect()]
        assert sorted(got, key=str) == sorted(brute_lines(rows, least), key=str), least


def test_line_runs_keep_columns_and_spans(docs):
    rows = [(1, "first line of some length\nx"), (2, "y\nfirst line of some length\nx\nz"), (2, "q"), (None, "first line of some length")]
    made = line_dedup.dedup(docs(rows), 20)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "words", "n_lines", "n_removed", "runs"]
    got = {(r["doc_id"], r["n_lines"]): (r["text"], [(s["start"], s["n"]) for s in r["runs"]]) for r in made.collect()}
    assert got[(None, 1)][0] == "first line of some length"  # a null id comes first
    assert got[(1, 2)] == ("x", [(0, 1)]) and got[(2, 4)] == ("y\nz", [(1, 2)]) and got[(2, 1)] == ("q", [])
    assert line_dedup.dedup(docs([])).collect() == []


def test_equal_rows_keep_one(docs):
    got = line_dedup.dedup(docs([(1, "a line that is long enough to count")] * 5)).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 1, 1, 1, 1]


@pytest.mark.parametrize("name", ["op5_line_runs", "op7_impact_top_k", "op9_benchmark_decontamination"])
def test_queries_against_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SAMPLE), sql_connection(SAMPLE), queries.ORACLES[name]) is None


def test_digest_of_no_items(spark):
    rows = queries.QUERIES["op9_benchmark_decontamination"](spark, SAMPLE).where("n_items = 0").collect()
    assert {r["items_sha256"] for r in rows} <= {hashlib.sha256(b"").hexdigest()}


def test_benchmark_groups_are_bounded_and_built_once_a_batch(monkeypatch):
    class Shared:
        def __init__(self, value):
            self.value = value

    text = " ".join(f"word{i}" for i in range(3000)).encode()
    items = [("long", text), ("other", b"a b c d")]
    monkeypatch.setattr(decontaminate, "MOST_NODES", 2000)
    groups = [(f"bounded-{k}", Shared(rows)) for k, rows in enumerate(decontaminate._groups(items, 13, 32 << 20))]
    built = []
    make = decontaminate._automaton
    monkeypatch.setattr(decontaminate, "_automaton", lambda rows, width: built.append(make(rows, width)) or built[-1])
    hits = decontaminate._hits([text, b"x a b c d", b"none"], groups, 13)
    assert len(built) == len(groups) > 10  # not once for each text
    assert all(made.get_stats()["nodes_count"] <= 2001 for _, made in built)
    assert {end for end, _, _ in hits[0]} == set(range(12, 3000)) and hits[1] == [(4, 4, ["other"])] and hits[2] == []
