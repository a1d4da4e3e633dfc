"""Numeric coercion and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact(value: Column, scale: int = 4) -> Column:
    """Value as a decimal, so that a distributed sum does not depend on order."""
    return value.cast(f"decimal(18,{scale})")


def exact_sum(value: Column, digits: int | None = None, scale: int = 4) -> Column:
    total = F.sum(exact(value, scale))
    return (total if digits is None else F.round(total, digits)).cast("double")


def number_or_null(text: Column) -> Column:
    """Text to double; text that is no number becomes NULL."""
    return F.trim(text).try_cast("double")


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """100 * part / whole, NULL when there is nothing to divide by."""
    share = part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0))
    return share if digits is None else F.round(share, digits)


def within(value: Column, low: float, high: float) -> Column:
    """Closed range test that is false for NULL and NaN."""
    return F.coalesce(~F.isnan(value) & value.between(low, high), F.lit(False))


def row_count(condition: Column) -> Column:
    """Number of rows for which a condition holds."""
    return F.count_if(F.coalesce(condition, F.lit(False)))
