"""Structured Streaming pipelines over the same operators as the batch plans."""
