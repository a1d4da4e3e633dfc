"""Metering and billing analytics as plain DataFrame-to-DataFrame functions."""
