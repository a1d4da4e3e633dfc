import pytest
from pyspark.sql import functions as F
from test_lines_and_windows import brute_hits, brute_lines
from test_near_dedup import brute_classes
from test_tokens_and_packing import check_packing

import corpus_pipeline
from gridtally import session
from gridtally.llm.common import remainder

SAMPLE = "/root/testdata/sf0.001"


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_each_stage_on_its_own_input(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "best-fit packing",
    ]
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    inputs = []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = session.materialize(stage(spark, docs, SAMPLE), "stage")
        if name != "best-fit packing":
            assert docs.columns == corpus_pipeline.COLUMNS and docs.dtypes == inputs[0].dtypes, name
    raw, good, lines, apart, clean = inputs
    # the classifier: its own labels are kept and dropped as marked
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SAMPLE}/labels.parquet").where(remainder("doc_id", 5) != 0).collect()}
    left = {d for d, _ in pairs(good)}
    assert sum((d in left) == bool(q) for d, q in labels.items()) >= 0.97 * len(labels)
    assert good.exceptAll(raw).isEmpty()
    # line runs
    want = [(d, t) for d, n, gone, t in brute_lines(sorted(pairs(good)), 30) if not gone or t.strip(" ")]
    assert sorted(pairs(lines)) == sorted(want)
    assert lines.where(F.col("n_chars") != F.char_length("text")).isEmpty()
    # near-duplicates: nearly all classes lose all but one, and none loses all
    group = brute_classes(pairs(lines))
    stay = {d for d, _ in pairs(apart)}
    assert {group[d] for d in stay} == set(group.values()) and len(stay) <= len(set(group.values())) + 0.01 * len(group)
    assert apart.exceptAll(lines).isEmpty()
    # benchmark
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SAMPLE}/benchmark.parquet").collect()]
    bad = {r[0] for r in brute_hits(pairs(apart), bench, 13) if r[5]}
    assert {d for d, _ in pairs(clean)} == stay - bad
    check_packing(docs.collect(), pairs(clean), 4096)


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SAMPLE).collect()
    filled = {}
    for r in rows:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert rows and max(filled.values()) <= 4096


@pytest.mark.parametrize("texts", [[], [(1, None)], [(None, "a b"), (1, ""), (1, ""), (2, "x " * 9000)]])
def test_odd_tables(spark, docs, tmp_path, texts):
    folder = str(tmp_path)
    docs(texts).drop("shard", "words").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    # rows without words are one class; without labels every score is one half, which is enough
    assert len({r["doc_id"] for r in rows}) == {0: 0, 1: 1, 4: 3}[len(texts)]
