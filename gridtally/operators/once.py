"""Evaluating an expensive expression exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` plus computed columns that later filters cannot re-evaluate.

    The optimizer moves a filter below the projection that computes its columns
    and copies their expressions into it; for a JSON parse that means parsing a
    line once per mention. A filter does not move below a generator, so the
    columns come out of a one-element ``inline``.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*keep, F.inline(F.array(values)))
