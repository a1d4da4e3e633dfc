"""A version history that is kept in tables and grows by batches, in any order of time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DataType, StructType

from gridtally import session
from gridtally.operators import history, upsert
from gridtally.operators.ordered import ROWS_PER_BUCKET
from gridtally.sinks.tables import Table


@dataclass(frozen=True)
class History:
    """Versions of an entity, and the points (key and instant) they follow from.

    A change that alters nothing starts no version today, but does once a late change
    comes before it. So all points are stored, and the versions of a batch's keys are
    made again from theirs; other keys' rows are neither read nor, but for those in the
    same files, written.
    """

    points: Table
    versions: Table
    key: str
    moment: str
    tracked: list[str]
    tie: str

    @staticmethod
    def at(spark: SparkSession, root: str, changes: StructType, key: str, moment: str, tracked: list[str], tie: str) -> History:
        """The history below ``root`` of changes with the given schema."""
        kind = lambda c: changes[c].dataType
        state = StructType()
        for c in tracked:
            state = state.add(c, kind(c))
        owned: list[tuple[str, DataType]] = [(key, kind(key)), ("valid_from", kind(moment))]
        held = _schema([*owned, ("state", state), ("closed", BooleanType()), ("tie", kind(tie))])
        shown = _schema([(key, kind(key)), *[(c, kind(c)) for c in tracked], *owned[1:], ("valid_to", kind(moment)), ("is_current", BooleanType())])
        names = [key, "valid_from"]
        return History(
            Table(spark, f"{root}/points", held, names, [key], names), Table(spark, f"{root}/versions", shown, names, [key], names), key, moment, tracked, tie
        )

    def apply(self, batch: DataFrame, deleted: Column | None = None, run_id: str = "", limit: int = ROWS_PER_BUCKET) -> None:
        """Take in a batch of changes: early, late or repeated ones split, shorten, add or remove versions of their keys.

        Changes without key or moment have no place in a history; ``upsert.unkeyed`` hands
        them to the dead letters. A batch that was cut off between the two tables is
        applied again: its points are there already, its versions are made from them.
        """
        seen = history.points(batch.filter(upsert.keyed([self.key, self.moment])), self.key, self.moment, self.tracked, self.tie, deleted)
        seen = session.materialize(seen, "points")
        self.points.merge(seen, upsert.Merge([self.key, "valid_from"], ["state", "closed", "tie"], upsert.newer("tie", "tie")), run_id)
        keys = session.materialize(seen.select(self.key).distinct(), "keys")
        theirs = self.points.read(files=self.points.holding(keys)).join(keys, self.key, "left_semi")
        made = history.spans(session.materialize(theirs.drop("tie"), "points"), self.key, self.tracked, limit)
        made = session.materialize(made, "versions")
        changed, rows = self._changed(keys, made)
        if not changed.isEmpty():
            self.versions.replace(changed, rows, run_id)

    def _changed(self, keys: DataFrame, made: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The keys whose versions are not stored like this yet, and their versions."""
        stored = self.versions.read(files=self.versions.holding(keys)).join(keys, self.key, "left_semi")
        both = stored.select(*made.columns).unionByName(made).groupBy(*made.columns).agg(F.count(F.lit(1)).alias("_n"))
        changed = session.materialize(both.filter("_n != 2").select(self.key).distinct(), "changed")
        return changed, made.join(changed, self.key, "left_semi")

    def rows(self) -> DataFrame:
        """All versions: the key, tracked columns, valid_from, valid_to and is_current."""
        return self.versions.read()


def _schema(fields: list[tuple[str, DataType]]) -> StructType:
    made = StructType()
    for name, kind in fields:
        made = made.add(name, kind)
    return made


