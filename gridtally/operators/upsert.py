"""Keyed merges that produce the next snapshot of a table.

Plain Parquet has no MERGE. The next snapshot is a full outer join of target and
source on the key; for partitioned facts only the partitions the source touches
are read and replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridtally.operators import dedup, integrity

Guard = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Merge:
    """What a merge does.

    keys      columns that identify a row in both tables
    update    columns a matched row takes from the source
    guard     test on (target, source) that a matched row must pass to change
    on_update literals stamped on a changed row, e.g. the load time
    on_insert literals stamped on a new row
    """

    keys: list[str]
    update: list[str]
    guard: Guard | None = None
    on_update: dict[str, Column] = field(default_factory=dict)
    on_insert: dict[str, Column] = field(default_factory=dict)


def newer(target_time: str, source_time: str, or_equal: bool = False) -> Guard:
    """Change only when the source is later than what the target last saw."""
    if or_equal:
        return lambda t, s: s(source_time) >= t(target_time)
    return lambda t, s: s(source_time) > t(target_time)


def differs(column: str) -> Guard:
    """Change only when a value differs; NULL compared with a value differs."""
    return lambda t, s: ~t(column).eqNullSafe(s(column))


def keyed(keys: list[str]) -> Column:
    """Whether a row has all of its keys."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def unkeyed(source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that no merge can place, as a key is missing; they belong to the dead letters."""
    return source.filter(~keyed(keys))


def merge(target: DataFrame, source: DataFrame, how: Merge) -> DataFrame:
    """Next snapshot of ``target``. ``source`` must hold one row per key.

    A source row without its key could never be matched again and would be inserted
    by every run, so it is left to ``unkeyed``.
    """
    source = source.filter(keyed(how.keys))
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_in_target"))
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_in_source"))
    on = reduce(lambda a, b: a & b, [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in how.keys])
    both = t.join(s, on, "full_outer")

    old: Callable[[str], Column] = lambda c: F.col(f"_t_{c}")
    new: Callable[[str], Column] = lambda c: F.col(f"_s_{c}")
    is_new = F.col("_in_target").isNull()
    matched = F.col("_in_target").isNotNull() & F.col("_in_source").isNotNull()
    change = matched if how.guard is None else matched & F.coalesce(how.guard(old, new), F.lit(False))

    def next_value(c: str) -> Column:
        inserted = how.on_insert.get(c)
        if inserted is None:
            inserted = new(c) if c in source.columns else F.lit(None)
        value = F.when(is_new, inserted)
        if c in how.on_update:
            value = value.when(change, how.on_update[c])
        elif c in how.update:
            value = value.when(change, new(c))
        return value.otherwise(old(c)).cast(target.schema[c].dataType).alias(c)

    return both.select(*[next_value(c) for c in target.columns])


def merge_latest(
    target: DataFrame, changes: DataFrame, how: Merge, time: str, *ties: str, operations: list[str] | None = None
) -> DataFrame:
    """Merge a change feed: keep the wanted operations, reduce to the latest row
    per key, then merge."""
    if operations is not None:
        changes = changes.filter(F.col("operation").isin(operations))
    changes = changes.filter(keyed(how.keys))
    return merge(target, dedup.latest_per_key(changes, how.keys, time, *ties), how)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Target plus the source rows with unseen keys, one row per key."""
    fresh = integrity.without_match(dedup.first_per_key(source, keys, *order), target, keys)
    return target.unionByName(fresh.select(*target.columns))


def touched(target: DataFrame, source: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """Partitions that a merge has to read and replace: those the batch names, and those
    in which its keys are now. Looking the keys up reads two columns of the target."""
    now = target.select(*keys, partition).join(source.select(*keys), keys, "left_semi").select(partition)
    return source.filter(keyed(keys)).select(partition).union(now).distinct()


def merge_partitions(target: DataFrame, source: DataFrame, how: Merge, partition: str) -> DataFrame:
    """Replacement rows for the touched partitions only; ``sinks.files.replace_partitions``
    puts them in place. A row whose partition value changed moves."""
    parts = touched(target, source, how.keys, partition)
    moving = replace(how, update=list(dict.fromkeys([*how.update, partition])))
    return merge(target.join(parts, partition, "left_semi"), source, moving)


# Key and overwritable columns of each dimension and mutable fact.
ENTITIES = {
    "customer": (["customer_id"], ["customer_number", "first_name", "last_name", "email", "customer_type", "status"]),
    "account": (["account_id"], ["account_number", "account_status", "billing_cycle"]),
    "location": (["premise_id"], ["premise_number", "address_line_1", "city", "state", "postal_code", "grid_zone"]),
    "contract": (["contract_id"], ["contract_number", "commodity_type", "tariff_code", "status"]),
    "meter": (["meter_id"], ["meter_type", "commodity_type", "status", "installation_date", "decommission_date"]),
    "billing": (["bill_id"], ["bill_date", "due_date", "total_amount", "tax_amount", "bill_status"]),
    "payment": (["payment_id"], ["payment_date", "amount", "payment_method", "payment_status"]),
}


def entity_merge(entity: str, columns: list[str], loaded_at: Column, stamp: str = "bq_update_timestamp", time: str = "event_timestamp") -> Merge:
    """The merge every dimension and mutable fact shares: a change wins when it is
    not older than the row's stamp, and stamps the row with the load time."""
    keys, update = ENTITIES[entity]
    return Merge(
        keys=keys,
        update=[c for c in update if c in columns],
        guard=newer(stamp, time, or_equal=True),
        on_update={stamp: loaded_at},
        on_insert={c: loaded_at for c in ("bq_insert_timestamp", stamp) if c in columns},
    )
