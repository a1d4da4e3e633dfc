"""JSON records: a record is parsed once into a map of variants."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

METADATA = "_metadata"


def fields(text: Column) -> Column:
    """Map of field name to variant; NULL when the text is not a JSON object."""
    return F.from_json(text, "map<string,variant>")


def field_text(record: Column, name: str) -> Column:
    return F.try_variant_get(record[name], "$", "string")


def metadata_text(record: Column, name: str) -> Column:
    return F.try_variant_get(record[METADATA], f"$.{name}", "string")


def data_fields(record: Column) -> Column:
    """The record without its metadata envelope."""
    return F.map_filter(record, lambda name, _: name != METADATA)


def value_type(value: Column) -> Column:
    """Registry type name of a variant: str, int, float, bool, dict, list or NULL."""
    shape = F.schema_of_variant(value)
    return (
        F.when(shape == "STRING", "str")
        .when(shape == "BIGINT", "int")
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "float")
        .when(shape == "BOOLEAN", "bool")
        .when(shape.startswith("OBJECT"), "dict")
        .when(shape.startswith("ARRAY"), "list")
    )
