"""Scans of dimensions, feature history, label logs and event streams."""
