"""Named corpus sources.

A source is a function (spark, **params) that returns either one frame with `text`, `label` and `split`,
or the three frames train, dev and test.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.relational import canonical_select, require_split_domain, union_sources, union_splits
from corpusmill.operators.sizing import repartition_by_size

Frames = DataFrame | tuple[DataFrame, DataFrame, DataFrame]
SourceFn = Callable[..., Frames]

_registry: dict[str, SourceFn] = {}


def register_source(name: str, fn: SourceFn) -> None:
    _registry[name] = fn


def source(name: str) -> SourceFn:
    if name not in _registry:
        raise ValueError(f"unknown source {name!r}; known: {sorted(_registry)}")
    return _registry[name]


def read_source(spark: SparkSession, dataset_name: str, fn: SourceFn, **params: Any) -> DataFrame:
    """The canonical columns of one source; a split of another name fails when it is read."""
    frames = fn(spark, **params)
    df = union_splits(*frames) if isinstance(frames, tuple) else frames
    return canonical_select(require_split_domain(df).withColumn("dataset_name", F.lit(dataset_name)))


def read_sources(
    spark: SparkSession, sources: Mapping[str, SourceFn], repartition: Mapping[str, Any] | None = None
) -> DataFrame:
    """All sources under one another; `repartition` holds the arguments of the sizing rule, if wanted."""
    df = union_sources([read_source(spark, name, fn) for name, fn in sources.items()])
    return repartition_by_size(df, **repartition) if repartition else df
