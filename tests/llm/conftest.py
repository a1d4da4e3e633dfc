import pytest


@pytest.fixture
def docs(spark):
    """A small documents frame; extra columns carry names the operators use themselves."""
    from gridtally.llm.common import prepare

    prepare(spark)

    def make(rows, partitions=3):
        full = [(i, t, "en", "src0", None if t is None else len(t), 7, "x") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, shard int, words string"
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make
