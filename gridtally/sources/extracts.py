"""Table extracts and landed API pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def jdbc_options(url: str, table: str, key: str, low: int, high: int, parts: int, fetch: int = 10000) -> dict[str, str]:
    """Options for a parallel table read: one range of ``key`` per task."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
        "fetchsize": str(fetch),
    }


def jdbc_table(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def incremental(df: DataFrame, field: str, watermark=None, inclusive: bool = False) -> DataFrame:
    """Rows beyond the watermark; all rows when there is none.

    The strict form can miss a late row carrying exactly the watermark's value;
    ``inclusive`` re-reads that value and leaves repeats to the keyed upsert.
    """
    if watermark is None:
        return df
    mark = watermark if not isinstance(watermark, str) else F.lit(watermark).cast(df.schema[field].dataType)
    return df.filter(F.col(field) >= mark if inclusive else F.col(field) > mark)


def unnest_pages(pages: DataFrame, body: str, item: StructType) -> DataFrame:
    """Items of landed responses, which are a bare list or sit under ``data``.

    An empty page or one without a list contributes no rows.
    """
    items = F.coalesce(
        F.when(F.ltrim(body).startswith("["), F.from_json(body, f"array<{item.simpleString()}>")),
        F.from_json(F.get_json_object(body, "$.data"), f"array<{item.simpleString()}>"),
    )
    kept = [c for c in pages.columns if c != body]
    return pages.select(*kept, F.inline(items))
