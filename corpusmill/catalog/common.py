"""Registration of queries, test inputs derived from the tables, and fragments of SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.charclasses import WS
from corpusmill.sources.files import spread

LIST_SEPARATOR = "|"


class Group:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def add(fn):
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql
            return fn

        return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose texts are worked on at length: spread over the cores where one small file holds it."""
    return spread(table(spark, folder, name))


def listed(column: Column) -> Column:
    """A list as one string, so that every engine compares it in the same way."""
    return F.array_join(column, LIST_SEPARATOR)


def numbers(column: Column) -> Column:
    return F.array_join(column.cast("array<string>"), " ")


def tweet_like(df: DataFrame) -> DataFrame:
    """Documents dressed with a retweet mark, a mention and an address, which their texts lack."""
    mark, address = F.lit("RT @user"), F.lit(" http://x.y/")
    doc = F.col("doc_id").cast("string")
    return df.select("doc_id", F.concat(mark, doc, F.lit(" "), "text", address, doc).alias("text"))


TWEET_LIKE = "(SELECT doc_id, concat('RT @user', doc_id, ' ', text, ' http://x.y/', doc_id) AS text FROM documents)"


# SQL fragments

def q(text: str) -> str:
    return text.replace("'", "''")


def sub(x: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({x}, '{q(pattern)}', '{q(replacement)}', 'g')"


def blanks(x: str) -> str:
    return f"trim({sub(x, f'[{WS}]+', ' ')}, ' ')"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{WS}]+')"


def keep(xs: str, condition: str) -> str:
    return f"list_filter({xs}, lambda w: {condition})"


def each(xs: str, expression: str) -> str:
    return f"list_transform({xs}, lambda w: {expression})"


def join(xs: str, separator: str = LIST_SEPARATOR) -> str:
    return f"array_to_string({xs}, '{separator}')"


def draw(salt: str, *key: str) -> str:
    parts = ", ".join([f"'{salt}'", *key])
    return f"('0x' || substr(md5(concat_ws(':', {parts})), 1, 8))::BIGINT"


def below(ratio: float, salt: str, *key: str) -> str:
    return f"({draw(salt, *key)} < {ratio}::DOUBLE * 4294967296.0)"
