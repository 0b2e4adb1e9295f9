"""Special tokens around encoded sequences, padding, and offset trimming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.charclasses import UWS
from corpusmill.functions.pretokenizers import BYTE_LEVEL_PATTERN, matches, to_byte_chars
from corpusmill.operators.hotkeys import lookup_join
from corpusmill.operators.words import SPECIAL_TOKENS
from corpusmill.session import materialize


def special_tokens(spark, tokens: list[str] = SPECIAL_TOKENS) -> DataFrame:
    """(id, token): the special tokens, which take the first ids."""
    return spark.createDataFrame(list(enumerate(tokens)), "id int, token string")


def _zeros(sequence: Column, extra: int, value: int = 0) -> Column:
    return F.array_repeat(F.lit(value), F.size(sequence) + extra)


def post_bert(a: Column, sep: object, cls: object, b: Column | None = None) -> tuple[Column, Column]:
    """`cls A sep` or `cls A sep B sep`, with type ids 0 for the first part and 1 for the second.

    The sequences hold tokens or ids; `sep` and `cls` are given in the same form.
    """
    first = F.concat(F.array(F.lit(cls)), a, F.array(F.lit(sep)))
    if b is None:
        return first, _zeros(a, 2)
    return F.concat(first, b, F.array(F.lit(sep))), F.concat(_zeros(a, 2), _zeros(b, 1, 1))


def post_roberta(a: Column, sep: object, cls: object, b: Column | None = None) -> tuple[Column, Column]:
    """`cls A sep` or `cls A sep sep B sep`; all type ids are 0."""
    first = F.concat(F.array(F.lit(cls)), a, F.array(F.lit(sep)))
    if b is None:
        return first, _zeros(a, 2)
    pair = F.concat(first, F.array(F.lit(sep)), b, F.array(F.lit(sep)))
    return pair, F.concat(_zeros(a, 2), _zeros(b, 2))


def trim_offsets(token: Column, start: Column, end: Column, position: Column, add_prefix_space: bool = True) -> tuple[Column, Column]:
    """Move the offsets of a byte-level token past its leading and trailing blanks."""
    leading = F.length(F.regexp_extract(token, f"^[Ġ{UWS}]*", 0))
    trailing = F.length(F.regexp_extract(token, rf"(?:(?<![Ġ{UWS}])|^)[Ġ{UWS}]+\z", 0))
    if add_prefix_space:
        # A single blank before the first token may be the added one.
        first = (position == 0) | (start == 0)
        leading = F.when(first & (leading == 1), 0).otherwise(leading)
    new_start = F.least(start + leading, end)
    new_end = F.when((trailing > 0) & (end >= trailing), F.greatest(end - trailing, new_start)).otherwise(end)
    return new_start, new_end


def byte_level_tokens(df: DataFrame, text: str, key: list[str]) -> DataFrame:
    """One row per byte-level token with its place in the text."""
    pieces = df.select(*key, F.posexplode(matches(F.col(text), BYTE_LEVEL_PATTERN)).alias("position", "piece"))
    upto = Window.partitionBy(*key).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("end", F.sum(F.length("piece")).over(upto).cast("int"))
    return placed.select(*key, "position", to_byte_chars(F.col("piece")).alias("token"), (F.col("end") - F.length("piece")).alias("start"), "end")


def post_byte_level(tokens: DataFrame, trim_offset: bool = True, add_prefix_space: bool = True) -> DataFrame:
    """Rows (…, position, token, start, end), one per token."""
    if not trim_offset:
        return tokens
    start, end = trim_offsets(F.col("token"), F.col("start"), F.col("end"), F.col("position"), add_prefix_space)
    return tokens.withColumns({"start": start, "end": end})


def pad_batch(df: DataFrame, column: str, pad: object, length: int | None = None, batch: str | None = None) -> DataFrame:
    """Pad sequences to a fixed length, or to the longest of the frame or of each batch; adds the mask."""
    size = F.size(column)
    if length is not None:
        wide = df.withColumn("_width", F.greatest(F.lit(length), size))
    elif batch is None:
        longest = df.agg(F.coalesce(F.max(size), F.lit(0)).alias("_width"))
        wide = df.crossJoin(F.broadcast(longest))
    else:
        longest = df.groupBy(batch).agg(F.max(size).alias("_width"), F.count("*").alias("_n"))
        wide = lookup_join(df, materialize(longest, "widths"), batch, "_n")
    missing = F.col("_width") - size
    return wide.withColumns(
        {
            "attention_mask": F.concat(F.array_repeat(F.lit(1), size), F.array_repeat(F.lit(0), missing)),
            column: F.concat(F.col(column), F.array_repeat(F.lit(pad), missing)),
        }
    ).drop("_width")
