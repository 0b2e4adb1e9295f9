"""Delimited files, Parquet tables, versioned folders and frequency files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.functions.charclasses import literal

# Quoted fields may hold separators and doubled quotes.
_QUOTING = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}
_VERBATIM = {
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": '""', "quoteAll": "true",
}


def scan_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", multi_line: bool = True) -> DataFrame:
    """A delimited file with a header; the schema is given, so no pass is spent on inferring it.

    An empty field is null, quoted or not. With `multi_line` quoted fields may hold line breaks, and a file is
    read by one task; without it large files are split.
    """
    return spark.read.schema(schema).options(**_QUOTING, sep=sep, multiLine=str(multi_line).lower()).csv(path)


def scan_tsv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    return scan_csv(spark, path, schema, "\t", multi_line)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.options(header="true", sep=sep, quote='"', escape='"', **_VERBATIM).csv(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores if the files give fewer partitions than there are; as it is otherwise."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_version(df: DataFrame, base: str, version: str) -> None:
    """Add a version of a dataset below `base`."""
    df.write.parquet(f"{base.rstrip('/')}/version={version}")


def read_version(spark: SparkSession, base: str, version: str) -> DataFrame:
    """One version of a dataset, with its own schema; only its folder is read."""
    return spark.read.parquet(f"{base.rstrip('/')}/version={version}")


def load_dictionary(
    spark: SparkSession, path: str, term_index: int = 0, count_index: int = 1, separator: str = " ", count_threshold: int = 1
) -> DataFrame:
    """(term, cnt) from a text file with a term and its frequency per line; lines without a number there are left out."""
    fields = F.split("value", literal(separator))
    rows = spark.read.text(path).select(F.get(fields, term_index).alias("term"), F.get(fields, count_index).try_cast("bigint").alias("cnt"))
    totals = rows.where(F.col("cnt").isNotNull()).groupBy("term").agg(F.sum("cnt").alias("cnt"))
    return totals.where(F.col("cnt") >= count_threshold)


def load_bigrams(spark: SparkSession, path: str, term_index: int = 0, count_index: int = 2, separator: str = " ") -> DataFrame:
    """(left, right, cnt) from a text file with two neighbouring terms and their frequency per line."""
    fields = F.split("value", literal(separator))
    rows = spark.read.text(path).select(
        F.get(fields, term_index).alias("left"), F.get(fields, term_index + 1).alias("right"),
        F.get(fields, count_index).try_cast("bigint").alias("cnt"),
    )
    return rows.where(F.col("cnt").isNotNull()).groupBy("left", "right").agg(F.sum("cnt").alias("cnt"))
