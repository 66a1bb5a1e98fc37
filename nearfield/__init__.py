"""Matching records by closeness, in batch and on streams, as PySpark DataFrame code."""
