"""Word counts: the first step of every vocabulary and dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPECIAL_TOKENS = ["[UNK]", "[CLS]", "[SEP]", "[PAD]", "[MASK]"]


def token_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """(word, cnt) over an array column; counts are combined within each task before the shuffle."""
    return df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("*").alias("cnt"))
