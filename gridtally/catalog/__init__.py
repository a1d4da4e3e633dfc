"""Registered queries, each beside the SQL that states the same result."""

from __future__ import annotations

from importlib import import_module

from gridtally.catalog.registry import ORACLES, QUERIES

for _part in ("readings", "quality", "integrity", "warehouse", "merges", "billing", "changes", "operations", "storage", "streams", "tables"):
    import_module(f"gridtally.catalog.{_part}")

__all__ = ["ORACLES", "QUERIES"]
