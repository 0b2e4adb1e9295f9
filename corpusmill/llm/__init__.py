"""Operators of a training-data pipeline: scoring, filtering, counting, deduplicating, mixing and searching."""
