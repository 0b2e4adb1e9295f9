"""Projections, filters, joins, aggregates and set operations on labelled texts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.charclasses import WS
from corpusmill.functions.cleaners import DEFAULT_CHAIN, Spec, clean_column
from corpusmill.session import materialize

REQUIRED_COLUMNS = ["text", "label", "split", "dataset_name"]
SPLIT_NAMES = ["train", "dev", "test"]


# Projections

def rename_text(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def const_columns(df: DataFrame, **values: str) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; present: {df.columns}")
    return df


def canonical_select(df: DataFrame) -> DataFrame:
    return require_columns(df).select(*REQUIRED_COLUMNS)


def add_cleaned_text(df: DataFrame, spec: Spec = tuple(DEFAULT_CHAIN), column: str = "text") -> DataFrame:
    return df.withColumn("cleaned_text", clean_column(df, column, spec))


# Filters

def drop_sentinel(df: DataFrame, column: str, sentinel: int = -1) -> DataFrame:
    """Rows whose flag is not the sentinel; null flags are kept."""
    return df.where(~F.col(column).eqNullSafe(F.lit(sentinel)))


def drop_sentinel_all(df: DataFrame, columns: Sequence[str], sentinel: int = -1) -> DataFrame:
    """Rows in which none of the flags is the sentinel."""
    return reduce(lambda acc, c: drop_sentinel(acc, c, sentinel), columns, df)


def filter_split(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


# Up to this minimum a text is read only as far as its words are needed; a pattern of more would nest too deep.
EARLY_STOP = 64


def has_words(text: Column, minimum: int) -> Column:
    """True if the text has at least `minimum` words, null for a null text."""
    if 1 <= minimum <= EARLY_STOP:
        return text.rlike(f"\\A[{WS}]*+(?:[^{WS}]++[{WS}]++){{{minimum - 1}}}[^{WS}]")
    return F.regexp_count(text, F.lit(f"[^{WS}]+")) >= minimum


def filter_min_words(df: DataFrame, column: str = "cleaned_text", minimum: int = 2) -> DataFrame:
    return df.where(has_words(F.col(column), minimum))


def clean_and_filter(df: DataFrame, spec: Spec, minimum: int = 2, column: str = "text") -> DataFrame:
    """Cleaned texts with at least `minimum` words.

    A filter on a computed column is pushed below its projection, which would clean every text twice; as
    a generator of zero or one rows the two are worked out together.
    """
    cleaned = F.array(clean_column(df, column, spec))
    kept = F.filter(cleaned, lambda text: has_words(text, minimum))
    return df.withColumn("cleaned_text", F.explode(kept))


def short_texts(df: DataFrame, column: str = "cleaned_text", minimum: int = 2) -> DataFrame:
    return df.where(~has_words(F.col(column), minimum))


# Joins

def join_labels(texts: DataFrame, labels: DataFrame, on: str = "id", suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Inner join; a column that both sides carry besides the key gets a suffix on each side."""
    both = (set(texts.columns) & set(labels.columns)) - {on}
    left = texts.withColumnsRenamed({c: c + suffixes[0] for c in both})
    right = labels.withColumnsRenamed({c: c + suffixes[1] for c in both})
    return left.join(right, on, "inner")


# Aggregates

def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), column)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def value_bytes(column: Column, kind: T.DataType) -> Column:
    """Logical size of a value: bytes of strings, widths of numbers, and what lists, maps and structs hold; null takes none."""
    none = F.lit(0).cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column).cast("bigint"), none)
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [value_bytes(column[f.name], f.dataType) for f in kind.fields], none)
    if isinstance(kind, T.ArrayType):
        held = F.aggregate(column, none, lambda total, x: total + value_bytes(x, kind.elementType))
        return F.coalesce(held, none)
    if isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        return value_bytes(F.map_keys(column), keys) + value_bytes(F.map_values(column), values)
    if isinstance(kind, T.DecimalType):
        size = 8 if kind.precision <= 18 else 16
    elif type(kind) in _FIXED_WIDTH:
        size = _FIXED_WIDTH[type(kind)]
    else:
        raise TypeError(f"no size rule for {kind.simpleString()}")
    return F.when(column.isNotNull(), F.lit(size)).otherwise(0).cast("bigint")


def row_bytes(schema: T.StructType) -> Column:
    """Logical size of a row."""
    return reduce(lambda a, b: a + b, [value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields])


def table_bytes(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).cast("bigint").alias("n_bytes"))


# Limits

def head(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_rows(df: DataFrame, n: int, *order: str | Column, keep: str | None = None) -> DataFrame:
    """The first n rows of a complete order, for an n of any size: sorted in ranges, with the cut inside one of them.

    Rows where the column `keep` holds come first in that order and stay, also if they are more than n.
    """
    number = f"row_{uuid.uuid4().hex}"
    ordered = materialize(df.orderBy(*order).withColumn(number, F.monotonically_increasing_id()), "ordered")
    # The number of a row is that of its range, then 33 bits for its place there.
    kept = F.count_if(F.col(keep)) if keep else F.lit(0)
    ranges = ordered.groupBy(F.shiftright(number, 33).alias("range")).agg(F.count("*").alias("n"), kept.alias("kept")).collect()
    left, bound = max(n, sum(r["kept"] for r in ranges)), 0
    for r in sorted(ranges, key=lambda r: r["range"]):
        taken = min(left, r["n"])
        if taken:
            bound = (r["range"] << 33) + taken
        left -= taken
    return ordered.where(F.col(number) < bound).drop(number)


def top_k_vocab(counts: DataFrame, k: int, min_frequency: int = 0) -> DataFrame:
    """The k most frequent words that occur at least `min_frequency` times."""
    return counts.where(F.col("cnt") >= min_frequency).orderBy(F.desc("cnt"), "word").limit(k)


# Set operations and validation

def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column missing in a frame is null there."""
    if not frames:
        raise ValueError("no frames to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_splits(train: DataFrame, dev: DataFrame, test: DataFrame) -> DataFrame:
    return union_sources([df.withColumn("split", F.lit(name)) for name, df in zip(SPLIT_NAMES, (train, dev, test))])


def validate_split_domain(df: DataFrame) -> DataFrame:
    """The split names outside the allowed set, null among them; empty for valid data."""
    split = F.col("split")
    return df.select(split).distinct().where(~F.coalesce(split.isin(SPLIT_NAMES), F.lit(False)))


def checked_split(split: Column) -> Column:
    """The split name, or an error at run time: validation within the one job that writes the data."""
    problem = F.concat(F.lit("invalid split name: "), F.coalesce(split, F.lit("null")))
    return F.when(split.isin(SPLIT_NAMES), split).otherwise(F.raise_error(problem))


def require_split_domain(df: DataFrame) -> DataFrame:
    return df.withColumn("split", checked_split(F.col("split")))
