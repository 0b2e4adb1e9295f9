"""Labelled-text corpus preparation as Spark DataFrame jobs."""
