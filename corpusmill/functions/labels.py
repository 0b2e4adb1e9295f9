"""Mapping of flags and categories to one binary label."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

TOXICITY_FLAGS = ["toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate"]


def any_flag_strict(*flags: str) -> Column:
    """1 if the flags add up to more than 0; a null flag makes the label 0."""
    total = reduce(add, [F.col(f) for f in flags])
    return F.coalesce((total > 0).cast("int"), F.lit(0))


def any_flag(*flags: str) -> Column:
    """1 if the non-null flags add up to more than 0."""
    total = reduce(add, [F.coalesce(F.col(f), F.lit(0)) for f in flags])
    return (total > 0).cast("int")


def not_category(category: Column, negative: str) -> Column:
    """0 for the negative category, 1 for any other, null included."""
    return (~category.eqNullSafe(F.lit(negative))).cast("int")
