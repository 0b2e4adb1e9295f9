"""Partition sizing from logical bytes, workers and memory."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.relational import table_bytes

MIN_PARTITION_BYTES = 15 * 1024**2
AIMED_PER_WORKER = 10


def partition_count(
    n_bytes: int, workers: int, memory_per_worker: float,
    min_bytes: int = MIN_PARTITION_BYTES, aimed_per_worker: int = AIMED_PER_WORKER,
) -> int:
    """Number of partitions for a table of `n_bytes`."""
    if memory_per_worker <= 0:
        raise ValueError("memory_per_worker must be positive")
    if n_bytes <= min_bytes:
        return 1
    if n_bytes / workers <= min_bytes:
        return round(n_bytes / min_bytes)
    base = max(1, math.ceil(n_bytes / (memory_per_worker * workers))) * workers
    # Grow while the next partition would still exceed the minimum and a worker has fewer than aimed.
    by_size = math.ceil(n_bytes / min_bytes) - 1
    return max(base, min(by_size, aimed_per_worker * workers))


def target_partitions(
    df: DataFrame, workers: int, memory_per_worker: float,
    min_bytes: int = MIN_PARTITION_BYTES, aimed_per_worker: int = AIMED_PER_WORKER,
) -> DataFrame:
    """The same rule as one row computed by Spark: (n_bytes, n_partitions)."""
    n_bytes = F.col("n_bytes")
    base = F.greatest(F.lit(1), F.ceil(n_bytes / F.lit(float(memory_per_worker) * workers))) * F.lit(workers)
    by_size = F.ceil(n_bytes / F.lit(min_bytes)) - 1
    grown = F.greatest(base, F.least(by_size, F.lit(aimed_per_worker * workers)))
    n = (
        F.when(n_bytes <= min_bytes, F.lit(1))
        .when(n_bytes / F.lit(workers) <= min_bytes, F.bround(n_bytes / F.lit(min_bytes)))
        .otherwise(grown)
    )
    return table_bytes(df).withColumn("n_partitions", n.cast("bigint"))


def repartition_by_size(
    df: DataFrame, workers: int, memory_per_worker: float,
    min_bytes: int = MIN_PARTITION_BYTES, aimed_per_worker: int = AIMED_PER_WORKER,
) -> DataFrame:
    """Spread the rows evenly over the computed number of partitions; costs one aggregate over the table."""
    n_bytes = table_bytes(df).first()["n_bytes"]
    return df.repartition(partition_count(n_bytes, workers, memory_per_worker, min_bytes, aimed_per_worker))
