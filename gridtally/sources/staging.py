"""Staging projections: which source columns survive, and under which name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Source column -> staging column, per table.
STAGING = {
    "customers": {
        "id": "customer_id",
        "first_name": "first_name",
        "last_name": "last_name",
        "email": "email",
        "phone": "phone",
        "created_at": "source_created_at",
        "updated_at": "source_updated_at",
    },
    "accounts": {
        "id": "account_id",
        "customer_id": "customer_id",
        "status": "status",
        "billing_address": "billing_address",
        "created_at": "source_created_at",
        "updated_at": "source_updated_at",
    },
    "meters": {
        "id": "meter_id",
        "serial_number": "serial_number",
        "model": "model",
        "installation_date": "installation_date",
        "status": "status",
        "service_point_id": "service_point_id",
    },
    "readings": {
        "id": "reading_id",
        "meter_id": "meter_id",
        "reading_value": "reading_value",
        "unit": "unit",
        "reading_timestamp": "reading_timestamp",
    },
}


def stage(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in STAGING[table].items()])
