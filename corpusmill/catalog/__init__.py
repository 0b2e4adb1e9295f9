"""The registered queries, each a function (spark, folder of tables) -> DataFrame, with SQL to check against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


def catalog() -> tuple[dict[str, QueryFn], dict[str, str]]:
    from corpusmill.catalog import cleaning, corpora, spelling, tables, tokenization, vocabularies

    queries: dict[str, QueryFn] = {}
    oracles: dict[str, str] = {}
    for module in (tables, cleaning, corpora, spelling, tokenization, vocabularies):
        queries.update(module.GROUP.queries)
        oracles.update(module.GROUP.oracles)
    return queries, oracles
