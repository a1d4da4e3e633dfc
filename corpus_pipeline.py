"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before it kept, stored as Parquet, and
returns documents again; the last one returns the place of every piece of them in
sequences. Stages read the columns of ``documents`` and ignore any others; null texts
count as empty, and empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import session
from gridtally.llm import decontaminate, line_dedup, near_dedup, packing, quality
from gridtally.llm.common import prepare, remainder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier, fitted on the labelled ones, rejects."""
    docs = docs.select(*COLUMNS)
    model = quality.fit(docs, table(prepare(spark), sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return quality.score(docs, model, keep=tuple(COLUMNS)).where("predicted = 1").select(*COLUMNS)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; documents of which nothing is left go."""
    prepare(spark)
    made = line_dedup.dedup(docs.select(*COLUMNS))
    left = made.where("n_removed = 0 or trim(text) != ''")
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    prepare(spark)
    return near_dedup.one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more stands in benchmark items."""
    benchmark = table(prepare(spark), sf_dir, "benchmark")
    return decontaminate.scan(docs.select(*COLUMNS), benchmark, keep=tuple(COLUMNS)).where("not contaminated").select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in sequences of 4096 ids."""
    prepare(spark)
    return packing.pack(docs.select(*COLUMNS))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", distinct_lines),
    ("MinHash near-dedup", distinct_documents),
    ("benchmark decontamination", not_in_benchmark),
    ("best-fit packing", sequences),
]

#: A trained classifier cannot be stated in SQL; the tests check each stage on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = session.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
