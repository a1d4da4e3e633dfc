"""Relations between tables: orphans, mismatches, row-count rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _missing_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Referenced keys the parent lacks, with how many child rows use each.

    The child is reduced to one row per key before it is shuffled, so a key held
    by a third of the rows costs no more than any other.
    """
    used = child.groupBy(F.col(child_key).alias("_key")).agg(F.count("*").alias("_rows"))
    known = parent.select(F.col(parent_key).alias("_known"))
    return used.join(known, F.col("_key") == F.col("_known"), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent does not exist; a NULL reference counts as missing.

    The usual answer is few or no missing keys. They then reach the child scan as
    a small (size-checked by the optimizer) broadcast and the child itself is
    never shuffled; a large set falls back to a shuffled semi join.
    """
    missing = _missing_keys(child, parent, child_key, parent_key).select("_key")
    return child.join(missing, F.col(child_key).eqNullSafe(F.col("_key")), "left_semi")


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, label: str) -> DataFrame:
    missing = _missing_keys(child, parent, child_key, parent_key)
    return missing.agg(
        F.lit(label).alias("table_name"), F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("orphan_records")
    )


@dataclass(frozen=True)
class Reference:
    """A child's column that must name a row of a parent."""

    child: DataFrame
    child_key: str
    parent: DataFrame
    parent_key: str
    label: str


def orphan_counts(references: list[Reference]) -> DataFrame:
    """Child rows without parent, per reference: table_name, orphan_records.

    The references of one table are read in one pass, as rows (reference, key), and all
    of them meet the parents' keys in one join, after the children were reduced to one
    row per key. References whose parent is the same column share its pass, too.
    """
    spark = references[0].child.sparkSession

    def stacked(side: str) -> DataFrame:
        # a table by the frame that was given for it
        tables: dict[int, list[Reference]] = {}
        for r in references:
            tables.setdefault(id(getattr(r, side)), []).append(r)
        parts = []
        for own in tables.values():
            pairs = [F.struct(F.lit(r.label).alias("label"), F.col(getattr(r, f"{side}_key")).cast("string").alias("key")) for r in own]
            parts.append(getattr(own[0], side).select(F.inline(F.array(*pairs))))
        return reduce(DataFrame.union, parts)

    used = stacked("child").groupBy("label", "key").agg(F.count(F.lit(1)).alias("rows"))
    missing = used.join(stacked("parent"), ["label", "key"], "left_anti").groupBy("label").agg(F.sum("rows").alias("orphan_records"))
    labels = spark.createDataFrame([(r.label,) for r in references], "label string")
    return labels.join(missing, "label", "left").select(F.col("label").alias("table_name"), F.coalesce("orphan_records", F.lit(0)).alias("orphan_records"))


def without_match(source: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is not in ``existing`` yet."""
    return source.join(existing.select(*keys), keys, "left_anti")


def mismatches(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str) -> DataFrame:
    """Joined rows whose two values differ (NULL is no difference)."""
    other = right.select(F.col(key).alias("_key"), F.col(right_value).alias("related_value"))
    return left.join(other, F.col(key) == F.col("_key")).filter(F.col(left_value) != F.col("related_value")).drop("_key")


def before_start(
    events: DataFrame, owners: DataFrame, key: str, moment: str, start: str
) -> DataFrame:
    """Events dated before their owner began."""
    begins = owners.select(F.col(key).alias("_key"), F.col(start).cast("timestamp_ntz").alias("owner_start"))
    return events.join(begins, F.col(key) == F.col("_key")).filter(F.col(moment) < F.col("owner_start")).drop("_key")


def matching_rows(events: DataFrame, owners: DataFrame, key: str, condition: Column) -> DataFrame:
    """How many events belong to an owner and satisfy a condition, and whether any do."""
    chosen = owners.select(F.col(key).alias("_key"))
    kept = events.filter(condition).groupBy(key).agg(F.count("*").alias("_rows"))
    found = kept.join(chosen, F.col(key) == F.col("_key"), "left_semi")
    total = F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
    return found.agg(total.alias("matching_rows"), (total > 0).alias("has_rows"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per table."""
    counted = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def count_rules(counts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Evaluate named comparisons between table counts, e.g. ``accounts >= customers``.

    The counts become one row, so every rule is a plain expression on it.
    """
    names = [n for n in sorted({w for _, text in rules for w in text.replace("(", " ").replace(")", " ").split()}) if n.isidentifier() and n.lower() not in ("div", "and", "or")]
    wide = counts.agg(*[F.max(F.when(F.col("table_name") == n, F.col("row_count"))).alias(n) for n in names])
    pairs = ", ".join(f"'{name}', coalesce({text}, false)" for name, text in rules)
    return wide.select(F.expr(f"stack({len(rules)}, {pairs}) as (rule_name, passed)"))
