"""Pseudonymizing customers before analysts see them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtally.functions import keys, text

# Personal columns and what replaces them.
HASHED = ["first_name", "last_name", "email", "phone"]


def pseudonymize(customers: DataFrame, birth: str = "date_of_birth") -> DataFrame:
    """Hash names and contacts, keep only the year of birth, clean the type code."""
    out = customers.withColumns({f"{c}_hash": keys.pseudonym(F.col(c)) for c in HASHED if c in customers.columns})
    if birth in customers.columns:
        out = out.withColumn(f"{birth}_year", F.year(birth).cast("bigint"))
    if "customer_type" in customers.columns:
        out = out.withColumn("customer_type", text.code(F.col("customer_type")))
    return out.drop(*HASHED, birth)
