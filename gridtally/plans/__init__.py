"""Whole queries and pipelines built from the operators."""
