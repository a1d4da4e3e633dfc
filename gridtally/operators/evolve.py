"""Schema registry: which changes to a table's fields are safe.

A registry is a DataFrame (table_name, version, field, dtype) whose version is
an integer minor number; version n is shown as ``1.n``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtally import session
from gridtally.functions import payload
from gridtally.operators.once import computed_once


class IncompatibleSchemaError(ValueError):
    """A field was removed or changed its type."""


def latest(registry: DataFrame) -> DataFrame:
    """Fields of the newest version of each table."""
    top = registry.groupBy("table_name").agg(F.max("version").alias("version"))
    return registry.join(top, ["table_name", "version"])


def one_type(observed: DataFrame) -> DataFrame:
    """One row per table and field: whole and fractional numbers together are ``float``,
    other mixtures are named with all their types."""
    kinds = F.array_sort(F.collect_set("dtype"))  # a handful of type names
    return observed.groupBy("table_name", "field").agg(kinds.alias("_k")).select(
        "table_name", "field", F.when(F.array_join("_k", ",") == "float,int", "float").otherwise(F.array_join("_k", "|")).alias("dtype")
    )


def diff(registered: DataFrame, proposed: DataFrame) -> DataFrame:
    """Field by field: ADDED, REMOVED, RETYPED or SAME, and whether it is safe."""
    old = one_type(registered).withColumnRenamed("dtype", "old_type")
    new = one_type(proposed).withColumnRenamed("dtype", "new_type")
    known = registered.select("table_name").distinct().withColumn("_known", F.lit(True))
    joined = old.join(new, ["table_name", "field"], "full_outer").join(known, "table_name", "left")
    change = (
        F.when(F.col("old_type").isNull(), "ADDED")
        .when(F.col("new_type").isNull(), "REMOVED")
        .when(F.col("old_type") != F.col("new_type"), "RETYPED")
        .otherwise("SAME")
    )
    return joined.withColumn("change", change).select(
        "table_name",
        "field",
        "old_type",
        "new_type",
        "change",
        F.when(F.col("_known").isNull(), F.lit(True)).otherwise(~change.isin("REMOVED", "RETYPED")).alias("compatible"),
    )


def evolve(registry: DataFrame, proposed: DataFrame) -> tuple[DataFrame, list[str]]:
    """Registry with a new version of every table that gained fields.

    Raises on a removed or retyped field. The registry holds one row per field,
    so looking at the differences on the driver is bounded by the schemas.
    """
    # each is used several times, and may stand for all events
    registry, proposed = session.materialize(registry, "registry"), session.materialize(proposed, "proposed")
    current = latest(registry)
    changes = diff(current, proposed)
    tables = [r[0] for r in proposed.select("table_name").distinct().collect()]
    changes = changes.filter(F.col("table_name").isin(tables))
    broken = changes.filter(~F.col("compatible")).orderBy("table_name", "field").limit(1).collect()
    if broken:
        row = broken[0]
        if row["change"] == "REMOVED":
            raise IncompatibleSchemaError(f"Field '{row['field']}' was removed. This is a breaking change.")
        raise IncompatibleSchemaError(
            f"Field '{row['field']}' changed type from {row['old_type']} to {row['new_type']}."
        )
    grown = [r[0] for r in changes.filter(F.col("change") == "ADDED").select("table_name").distinct().collect()]
    versions = current.groupBy("table_name").agg(F.max("version").alias("_v"))
    added = (
        one_type(proposed).filter(F.col("table_name").isin(grown))
        .join(versions, "table_name", "left")
        .select("table_name", F.coalesce(F.col("_v") + 1, F.lit(0)).cast("int").alias("version"), "field", "dtype")
    )
    return registry.unionByName(added), sorted(grown)


def observed(events: DataFrame, table: str = "source_table", body: str = "payload") -> DataFrame:
    """Fields and types that actually occur in JSON payloads.

    The distinct set combines before the shuffle: its size is that of the
    schemas, not of the data.
    """
    pairs = events.select(F.col(table).alias("table_name"), F.explode(payload.fields(F.col(body))).alias("field", "_v"))
    typed = computed_once(pairs, ["table_name", "field"], {"dtype": payload.value_type(F.col("_v"))})
    return typed.filter(F.col("dtype").isNotNull()).distinct()


def type_errors(events: DataFrame, registered: DataFrame, row_id: str, table: str = "source_table", body: str = "payload") -> DataFrame:
    """Payload values whose type is not the registered one.

    Unregistered fields, missing fields and NULLs pass; an int is a valid float.
    """
    values = events.select(
        row_id, F.col(table).alias("table_name"), F.explode(payload.fields(F.col(body))).alias("field", "_v")
    )
    values = computed_once(values, [row_id, "table_name", "field"], {"actual": payload.value_type(F.col("_v"))})
    checked = registered.filter(F.col("dtype").isin("int", "float", "str")).select(
        "table_name", "field", F.col("dtype").alias("expected")
    )
    joined = values.filter(F.col("actual").isNotNull()).join(checked, ["table_name", "field"])
    accepted = (
        (F.col("actual") == F.col("expected"))
        | ((F.col("expected") == "float") & F.col("actual").isin("int", "bool"))
        | ((F.col("expected") == "int") & (F.col("actual") == "bool"))
    )
    return joined.filter(~accepted).select(
        row_id,
        "table_name",
        "field",
        F.concat(
            F.lit("Field '"), "field", F.lit("' expected "), "expected", F.lit(", got "), "actual"
        ).alias("error"),
    )


def read_together(*versions: DataFrame) -> DataFrame:
    """Old and new records in one frame; a field an old record lacks is NULL."""
    merged = versions[0]
    for df in versions[1:]:
        merged = merged.unionByName(df, allowMissingColumns=True)
    return merged
