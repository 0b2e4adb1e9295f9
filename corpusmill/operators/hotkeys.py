"""Left join of many rows against a table with one row per key, safe when few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than this share of all rows, so that at most 1 / HOT_SHARE keys are hot.
HOT_SHARE = 1 / 2000


def lookup_join(rows: DataFrame, table: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """`rows` left join `table` on `key`; the keys of the table are unique, not null, and cheap to read again.

    `weight` is a column of the table that tells how many rows carry the key. The keys above the hot
    share are bounded in number by arithmetic, so they are joined by broadcast; all others go through a
    shuffle in which a key holds at most that share. Without weights Catalyst chooses, and adaptive execution splits
    skewed partitions.
    """
    if weight is None:
        return rows.join(table, key, "left")

    values = [c for c in table.columns if c not in (key, weight)]
    total = table.agg(F.sum(weight).alias("_total"))
    marked = table.crossJoin(F.broadcast(total)).withColumn("_hot", F.col(weight) > F.col("_total") * F.lit(HOT_SHARE))
    hot = marked.where("_hot").select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot_value"))
    cold = marked.where("NOT _hot").select(
        F.col(key).alias("_cold_key"), F.lit(0).alias("_cold_spread"), F.struct(*values).alias("_cold_value")
    )
    # A row served by the broadcast gets a spread value other than 0: it finds no partner in the second
    # join and lands in any partition. The value is a hash of the row, so a task that runs again after a lost
    # executor sends its rows where they went before.
    found = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_spread", F.when(F.col("_hot_key").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*rows.columns), F.lit(4096))).cast("int")
    )
    joined = found.join(
        cold, (F.col(key) == F.col("_cold_key")) & (F.col("_spread") == F.col("_cold_spread")), "left"
    )
    value = F.coalesce("_hot_value", "_cold_value")
    return joined.select(*rows.columns, *[value[v].alias(v) for v in values])
