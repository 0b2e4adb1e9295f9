"""Reproducible splits: a row's side follows from a hash of its key, not from its partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusmill.operators.hotkeys import lookup_join
from corpusmill.session import materialize

def key_hash(salt: str, *key: str | Column) -> Column:
    """128 bits of hash as 32 hexadecimal digits."""
    parts = [k if isinstance(k, Column) else F.col(k) for k in key]
    return F.md5(F.concat_ws(":", F.lit(salt), *[p.cast("string") for p in parts]))


def draw(salt: str, *key: str | Column) -> Column:
    """A number in [0, 2^32), uniform over keys."""
    return F.conv(F.substring(key_hash(salt, *key), 1, 8), 16, 10).cast("bigint")


def in_second(ratio: float | Column, salt: str, *key: str | Column) -> Column:
    """True for the share `ratio` of keys that goes to the second frame of a split."""
    share = ratio if isinstance(ratio, Column) else F.lit(float(ratio))
    return draw(salt, *key) < share * F.lit(float(2**32))


def random_split(df: DataFrame, test_size: float, salt: str, *key: str | Column) -> tuple[DataFrame, DataFrame]:
    chosen = in_second(test_size, salt, *key)
    return df.where(~chosen), df.where(chosen)


def stratum_ratio(stratum: str, ratios: float | dict) -> Column:
    if not isinstance(ratios, dict):
        return F.lit(float(ratios))
    out = F.lit(0.0)
    for value, ratio in ratios.items():
        out = F.when(F.col(stratum) == F.lit(value), F.lit(float(ratio))).otherwise(out)
    return out


def stratified_draw(test_size: float | dict, stratum: str, salt: str, *key: str | Column) -> Column:
    """True for the rows of the second frame; the draw is salted by the stratum, so strata are independent.

    `test_size` is one ratio or a ratio per stratum; strata left out stay in the first frame.
    """
    of = F.coalesce(F.col(stratum).cast("string"), F.lit("null"))
    parts = [k if isinstance(k, Column) else F.col(k) for k in key]
    return in_second(stratum_ratio(stratum, test_size), salt, of, *parts)


def stratified_split(
    df: DataFrame, test_size: float | dict, stratum: str, salt: str, *key: str | Column
) -> tuple[DataFrame, DataFrame]:
    """One pass per frame over all strata, without a job to list them."""
    chosen = stratified_draw(test_size, stratum, salt, *key)
    return df.where(~chosen), df.where(chosen)


def quota_thresholds(df: DataFrame, test_size: float, stratum: str, salt: str, *key: str | Column) -> DataFrame:
    """Per stratum, the largest hash such that the rows up to it number at most floor(test_size * n).

    A histogram over 16 bits of the hash finds the bucket where the quota falls, a second one over the
    next 16 bits refines it, and only the hashes that share those 32 bits are ranked. Rows of equal keys
    are counted before the shuffle and stay together.
    """
    if not 0 <= test_size < 1:
        raise ValueError("test_size must be at least 0 and below 1")
    rows = df.select(F.col(stratum).alias("_stratum"), key_hash(salt, *key).alias("_hash"))
    whole = Window.partitionBy("_stratum")
    running = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quota = None
    for digits in (4, 8, 32):
        counts = rows.groupBy("_stratum", F.substring("_hash", 1, digits).alias("_bucket")).agg(F.count("*").alias("_c"))
        cumulated = counts.withColumn("_upto", F.sum("_c").over(running))
        if quota is None:
            n = F.sum("_c").over(whole)
            cumulated = cumulated.withColumn("n", n).withColumn("_left", F.floor(n * F.lit(test_size)).cast("bigint"))
        else:
            cumulated = cumulated.join(quota.withColumnRenamed("_stratum", "_s"), F.col("_stratum") == F.col("_s"))
        if digits == 32:
            break
        # The first bucket that passes the quota, and what is left of the quota where it starts.
        start = (F.col("_left") - F.col("_upto") + F.col("_c")).alias("_left")
        quota = materialize(
            cumulated.where("_upto > _left")
            .groupBy("_stratum", "n")
            .agg(F.min_by(F.struct("_bucket", start), "_bucket").alias("_e"))
            .select("_stratum", "n", F.col("_e._bucket").alias("_edge"), F.col("_e._left").alias("_left")),
            "quota",
        )
        rows = (
            lookup_join(rows, quota.select("_stratum", "n", "_edge"), "_stratum", "n")
            .where(F.substring("_hash", 1, digits) == F.col("_edge"))
            .select("_stratum", "_hash")
        )
    last = cumulated.where(F.col("_upto") <= F.col("_left")).groupBy("_stratum").agg(F.max("_bucket").alias("_last"))
    # Below the boundary bucket everything is in; inside it everything up to `_last`.
    return (
        quota.join(last.withColumnRenamed("_stratum", "_s"), F.col("_stratum") == F.col("_s"), "left")
        .select(F.col("_stratum").alias(stratum), "n", F.coalesce("_last", "_edge").alias("_threshold"))
    )


def quota_split(
    df: DataFrame, test_size: float, stratum: str, salt: str, *key: str | Column
) -> tuple[DataFrame, DataFrame]:
    """Exact-quota form: floor(test_size * n) rows of each stratum, less only if copies of a key straddle it."""
    thresholds = materialize(quota_thresholds(df, test_size, stratum, salt, *key), "thresholds")
    marked = lookup_join(df, thresholds, stratum, "n")
    chosen = F.coalesce(key_hash(salt, *key) <= F.col("_threshold"), F.lit(False))
    return marked.where(~chosen).drop("_threshold"), marked.where(chosen).drop("_threshold")
