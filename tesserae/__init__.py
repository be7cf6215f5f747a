"""Metadata-model analytics on Spark."""
