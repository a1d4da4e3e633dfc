import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gridtally.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, h string, p long, up string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof", "folded")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes, fanout):
    made = [nodes]
    while len(nodes) > 1:
        nodes = [sha(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        made.append(nodes)
    return made


def siblings(tree, place, fanout):
    for nodes in tree[:-1]:
        first = place - place % fanout
        yield nodes[first:place], nodes[place + 1 : first + fanout]
        place //= fanout


def expected(rows, tampered, fanout):
    """A row for each of ``rows`` (doc_id, text, lang, source, n_chars)."""
    digest = lambda r, n: sha(*map(written, (r[0], r[3], r[2], n, r[1])))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(((r[0] is not None, r[0] or 0), digest(r, r[4]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for group in groups.values():
        group.sort(key=lambda x: x[:2])
    trees = {g: levels([x[1] for x in groups[g]], fanout) for g in names}
    top = levels([trees[g][-1][0] for g in names], fanout)
    made = []
    for at, g in enumerate(names):
        for place, (_, leaf, r) in enumerate(groups[g]):
            beside = [*siblings(trees[g], place, fanout), *siblings(top, at, fanout)]
            folded = digest(r, r[4] + 1) if tampered(r) else leaf
            for left, right in beside:
                folded = sha(*left, folded, *right)
            made.append((r[0], leaf, trees[g][-1][0], top[-1][0], "".join(x for pair in beside for side in pair for x in side), folded))
    return made


def is_tampered(r):
    return r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0


def documents(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", -1, "clash") for r in rows], SCHEMA).repartition(3)


def found(docs, fanout):
    changed = [F.col("n_chars") + 1 if f == "n_chars" else F.col(f) for f in merkle.FIELDS]
    claim = F.when((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull(), merkle.leaf(changed))
    made = merkle.manifest(docs, claims={"claim": claim}, fanout=fanout)
    return made.withColumn("folded", merkle.fold(F.coalesce("claim", "leaf"), "proof", merkle.PLACES, fanout))


def rows_of(lang, size, first=0):
    return [(first + i, f"text {i}" if i % 11 else "", lang, None if i % 5 == 0 else f"s{i % 3}", None if i % 9 == 0 else i) for i in range(size)]


CASES = {
    "one row": rows_of("en", 1),
    "odd groups": rows_of("en", 7) + rows_of("de", 1, 10) + rows_of(None, 3, 20) + rows_of("", 2, 30) + rows_of("é", 6, 40) + rows_of("z", 4, 50),
    "over one chunk": rows_of("en", 515) + rows_of("fr", 257, 1000) + rows_of(None, 256, 2000),
    "nulls and repeats": [(None, None, None, None, None)] * 3 + [(1, "a", "en", "s", 1)] * 4 + [(1, "b", "en", "s", 1), (None, "x", "en", "s", 1), (2, "ä\n" * 5000, "en", "", 0)],
}


@pytest.mark.parametrize(("case", "fanout"), [("one row", 2), ("over one chunk", 2), ("nulls and repeats", 2), ("odd groups", 3)])
def test_as_by_hand(spark, rows, case, fanout):
    key = lambda t: tuple((v is not None, str(v)) for v in t)
    assert rows(found(documents(spark, CASES[case]), fanout), *COLUMNS) == sorted(expected(CASES[case], is_tampered, fanout), key=key)


def test_empty(spark, rows):
    assert rows(merkle.manifest(documents(spark, []))) == []


def test_digests_of_values_do_not_run_into_each_other(spark):
    frame = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", None), (None, "")], "x string, y string")
    assert frame.select(merkle.leaf([F.col("x"), F.col("y")]).alias("h")).distinct().count() == 4


def test_query(spark, tmp_path):
    data = CASES["odd groups"]
    documents(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()
    want = {r[0]: r for r in expected(data, is_tampered, 2)}
    assert len(got) == len(data)
    for r in got:
        doc_id, leaf, subroot, root, proof, folded = want[r["doc_id"]]
        assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) == (leaf, subroot, root, sha(proof), folded)
        assert r["verified"] == (folded == root) == (not is_tampered(next(x for x in data if x[0] == doc_id)))
