import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark():
    from compare import local_session

    from gridtally import session

    spark = local_session(cores=8, partitions=4)
    yield session.configure(spark)
    session.clean(spark)
    spark.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))

    return collect
