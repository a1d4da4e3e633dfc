"""Readers: each returns a DataFrame with a declared schema."""
