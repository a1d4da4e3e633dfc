"""Full version history of an entity (SCD type 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridtally import session
from gridtally.operators.ordered import ROWS_PER_BUCKET, time_groups, with_neighbours

# Attributes whose change starts a new version.
TRACKED = {
    "customer": ["email", "phone", "customer_type"],
    "account": ["account_status"],
    "contract": ["tariff_code", "contract_status"],
    "meter": ["status"],
}


def points(changes: DataFrame, key: str, moment: str, tracked: list[str], tie: str, deleted: Column | None = None) -> DataFrame:
    """One row per key and instant: the state after it, whether it closes the history, and the ``tie`` that won.

    Changes at one instant reduce to the one with the highest ``tie``.
    """
    closing = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    state = F.struct(*[F.col(c) for c in tracked])
    latest = F.max_by(F.struct(state.alias("state"), closing.alias("closed"), F.col(tie).alias("tie")), F.col(tie))
    return (
        changes.groupBy(key, moment)
        .agg(latest.alias("_v"))
        .select(key, F.col(moment).alias("valid_from"), "_v.state", "_v.closed", "_v.tie")
    )


def spans(points: DataFrame, key: str, tracked: list[str], limit: int = ROWS_PER_BUCKET) -> DataFrame:
    """The versions that stored ``points`` make: valid_from, valid_to (exclusive) and is_current."""
    timed = time_groups(points, [key], "valid_from", limit=limit)
    seen = with_neighbours(timed, [key], ["valid_from"], ["state", "closed"], "_group", previous="_was")
    starts = seen.filter(
        F.col("_was").isNull()
        | ~F.col("_was.state").eqNullSafe(F.col("state"))
        | (F.col("_was.closed") != F.col("closed"))
    ).drop("_was")
    ends = with_neighbours(starts, [key], ["valid_from"], ["valid_from"], "_group", following="_then")
    return ends.filter(~F.col("closed")).select(
        key,
        *[F.col(f"state.{c}").alias(c) for c in tracked],
        "valid_from",
        F.col("_then.valid_from").alias("valid_to"),
        F.col("_then").isNull().alias("is_current"),
    )


def versions(
    changes: DataFrame, key: str, moment: str, tracked: list[str], tie: str, deleted: Column | None = None,
    limit: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per version with valid_from, valid_to (exclusive) and is_current.

    Changes at one instant reduce to the one with the highest ``tie``; a change
    that alters no tracked attribute starts no version; a deletion closes the
    open version and starts none.
    """
    stored = session.materialize(points(changes, key, moment, tracked, tie, deleted).drop("tie"), "points")
    return spans(stored, key, tracked, limit)


def soft_delete(current: DataFrame, deletions: DataFrame, key: str, status: str, at: str) -> DataFrame:
    """Mark deleted entities INACTIVE instead of removing them."""
    gone = deletions.groupBy(key).agg(F.max(at).alias("_deleted_at"))
    joined = current.join(gone, key, "left")
    return joined.withColumn(
        status, F.when(F.col("_deleted_at").isNotNull(), F.lit("INACTIVE")).otherwise(F.col(status))
    ).withColumnRenamed("_deleted_at", "deleted_at")
