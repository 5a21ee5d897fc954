"""Operators of a training-data pipeline: formatting, filtering, search, dedup and packing."""
