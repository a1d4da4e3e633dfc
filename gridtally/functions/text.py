"""Text clean-up and message building."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def code(value: Column) -> Column:
    """Canonical spelling of an enumeration value."""
    return F.upper(F.trim(value))


def blank(value: Column) -> Column:
    """True for NULL and for text without visible characters."""
    return value.isNull() | (F.trim(value.cast("string")) == "")


def messages(separator: str, findings: list[tuple[Column, str]]) -> Column:
    """Join the messages of all conditions that hold; empty text when none does."""
    return F.concat_ws(separator, *[F.when(cond, F.lit(text)) for cond, text in findings])


def row_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def snippet(text: Column, length: int = 500) -> Column:
    return F.substring(text, 1, length)
