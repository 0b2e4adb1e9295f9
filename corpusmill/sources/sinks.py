"""Written corpora, run manifests and vocabularies."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.relational import SPLIT_NAMES, require_split_domain
from corpusmill.operators.vocab import Vocabulary


def write_splits(df: DataFrame, path: str) -> None:
    """One pass over the data into one folder per split; an unknown split name fails the job."""
    require_split_domain(df).write.partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def manifest(df: DataFrame, **params: str) -> DataFrame:
    """One row: the parameters of a run and the number of rows in each split."""
    counts = [F.count_if(F.col("split") == s).alias(f"n_{s}") for s in SPLIT_NAMES]
    return df.agg(F.count("*").alias("n_rows"), *counts).select(*[F.lit(v).alias(k) for k, v in params.items()], "*")


def write_manifest(df: DataFrame, path: str, **params: str) -> None:
    manifest(df, **params).coalesce(1).write.json(path)


def save_vocab(v: Vocabulary, path: str) -> None:
    """Tables `vocab` and `merges` and one row of parameters below `path`."""
    spark = v.vocab.sparkSession
    v.vocab.write.parquet(f"{path}/vocab")
    v.merges.write.parquet(f"{path}/merges")
    spark.createDataFrame([(v.kind, json.dumps(v.params))], "kind string, params string").coalesce(1).write.json(f"{path}/params")


def load_vocab(spark: SparkSession, path: str) -> Vocabulary:
    row = spark.read.schema("kind string, params string").json(f"{path}/params").first()
    params: dict[str, Any] = json.loads(row["params"])
    return Vocabulary(row["kind"], spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges"), params)
