"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(natural: Column) -> Column:
    """60-bit integer fingerprint of a natural key; NULL stays NULL.

    It is a label for reports and warehouse tables. Joins inside this library use
    natural keys, so a fingerprint collision can never merge two entities.
    """
    text = natural.cast("string")
    # md5 of NULL is NULL, and conv keeps it.
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def text_key(natural: Column) -> Column:
    """128-bit fingerprint as text, for tables whose key column is a string."""
    return F.md5(natural.cast("string"))


def date_key(moment: Column) -> Column:
    """Calendar day as the integer yyyyMMdd."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("bigint")


def record_id(*parts: Column) -> Column:
    """Repeatable identifier of a record, in place of a random uuid."""
    marked = [F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]
    return F.md5(F.concat_ws("\u0001", *marked))


def pseudonym(value: Column) -> Column:
    """SHA-256 hex digest of personal data; NULL stays NULL."""
    return F.sha2(value.cast("string"), 256)
