"""Distinct counts over any range of days without the base rows.

Each run stores, beside its exact sets of (day, entity), one sketch a day. Sets and
sketches of any days and runs unite; a run that is repeated replaces its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, DataType, DateType, LongType, StructType

from gridtally import session
from gridtally.sinks.tables import Table

#: Registers of a sketch, as a power of two. Its relative standard error is some 1.04 / 2 ** (LG_K / 2).
LG_K = 14
ERROR = 1.04 / 2 ** (LG_K / 2)


@dataclass(frozen=True)
class DistinctCounts:
    """How many different entities there were.

    sets      day, entity: every entity of a day and run once
    sketches  day, rows, sketch: a few KB a day and run, however many entities it has
    """

    sets: Table
    sketches: Table

    @staticmethod
    def at(spark: SparkSession, root: str, entity: DataType) -> DistinctCounts:
        of_set = StructType().add("day", DateType()).add("entity", entity)
        of_sketch = StructType().add("day", DateType()).add("rows", LongType()).add("sketch", BinaryType())
        return DistinctCounts(Table(spark, f"{root}/sets", of_set, ["day", "entity"]), Table(spark, f"{root}/sketches", of_sketch, ["day"]))

    def add(self, rows: DataFrame, moment: str, entity: str, run_id: str) -> None:
        """Take in a run's rows. Those without a day or an entity count for nothing.

        The set comes from one shuffle, the sketches from the set: repeats are gone before they are hashed.
        """
        known = rows.select(F.col(moment).cast("date").alias("day"), F.col(entity).alias("entity")).dropna()
        once = session.materialize(known.groupBy("day", "entity").agg(F.count(F.lit(1)).alias("rows")), "set")
        self.sets.append(once.select("day", "entity"), run_id)
        a_day = once.groupBy("day").agg(F.sum("rows").alias("rows"), F.hll_sketch_agg("entity", LG_K).alias("sketch"))
        self.sketches.append(a_day, run_id)

    def exact(self, period: Column | None = None, low: str | None = None, high: str | None = None) -> DataFrame:
        """period, entities: exact counts of the days from ``low`` to ``high``, by ``period`` (an expression over ``day``)."""
        return _days(self.sets, low, high).groupBy(_period(period)).agg(F.countDistinct("entity").alias("entities"))

    def estimated(self, period: Column | None = None, low: str | None = None, high: str | None = None) -> DataFrame:
        """period, entities, rows: the same from the sketches alone, with a relative standard error of ``ERROR``."""
        united = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("entities")
        return _days(self.sketches, low, high).groupBy(_period(period)).agg(united, F.sum("rows").alias("rows"))


def _period(period: Column | None) -> Column:
    return (F.lit("all") if period is None else period).alias("period")


def _days(table: Table, low: str | None, high: str | None) -> DataFrame:
    """Rows of the days in a range, from the files that may hold them."""
    files, rows = table.files(), None
    for bound, there, of_file in ((low, F.col("day") >= F.lit(low).cast("date"), F.col("high") >= F.lit(low).cast("date")),
                                  (high, F.col("day") <= F.lit(high).cast("date"), F.col("low") <= F.lit(high).cast("date"))):
        if bound is not None:
            files = files.filter(of_file)
            rows = there if rows is None else rows & there
    found = table.read(files=files)
    return found if rows is None else found.filter(rows)
