"""Operators of a training-data pipeline: token counts, filters, dedup, packing, formatting."""
