"""Building of a corpus: read, clean, filter, split, write."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpusmill.plans.recipes  # noqa: F401  registers the built-in sources
from corpusmill.functions.cleaners import DEFAULT_CHAIN, Spec, clean_column, resolve, words_of
from corpusmill.operators.hotkeys import lookup_join
from corpusmill.operators.relational import clean_and_filter, filter_min_words
from corpusmill.operators.spelling import spell_compound
from corpusmill.session import discard, materialize
from corpusmill.sources.files import load_bigrams, load_dictionary
from corpusmill.sources.registry import SourceFn, read_sources, source
from corpusmill.sources.sinks import manifest, write_manifest, write_splits

CORPUS_COLUMNS = ["text", "label", "split", "dataset_name", "cleaned_text"]


def map_text(df: DataFrame, fn: Callable[[Column], Column] | Callable[[str], str], output: str = "cleaned_text",
             column: str = "text", python: bool = False) -> DataFrame:
    """Add `fn` of a text column: an expression, or with `python` a function of one string, run on Arrow batches."""
    if not python:
        return df.withColumn(output, fn(F.col(column)))

    @F.arrow_udf("string")
    def mapped(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else fn(t) for t in texts.to_pylist()], pa.string())

    return df.withColumn(output, mapped(column))


def spell_correct(df: DataFrame, column: str, dictionary: DataFrame, bigrams: DataFrame, **params: Any) -> DataFrame:
    """Replace a text column by its corrected form; equal texts are corrected once.

    A list of words is joined, corrected and cut into words again.
    """
    if df.schema[column].dataType.typeName() == "array":
        joined = df.withColumn(column, F.array_join(column, " "))
        return spell_correct(joined, column, dictionary, bigrams, **params).withColumn(column, words_of(F.col(column)))
    # Written once, as the texts may come out of a chain of cleaners and are read three times.
    keyed = materialize(df.withColumn("_text_key", F.sha2(column, 256)), "keyed")
    texts = keyed.where(F.col(column).isNotNull()).groupBy("_text_key").agg(
        F.first(column).alias("_text"), F.count("*").alias("_n")
    )
    # Each of its words travels with the key of a text, so that is a number, given once.
    texts = materialize(texts.withColumn("_text_id", F.monotonically_increasing_id()), "texts")
    corrected = spell_compound(texts, "_text", ["_text_id"], dictionary, bigrams, output="_corrected", **params)
    table = materialize(corrected.select("_text_key", "_n", "_corrected"), "corrected")
    discard(texts)
    joined = lookup_join(keyed, table, "_text_key", "_n")
    return joined.withColumn(column, F.col("_corrected")).select(*df.columns)


SPELLING = "spell_correct"


def spelling_params(spark: SparkSession, params: Mapping[str, Any]) -> dict[str, Any]:
    """The arguments of `spell_correct` from those of a named step; dictionaries may be given as paths of frequency files."""
    given = dict(params)
    for name, load in (("dictionary", load_dictionary), ("bigrams", load_bigrams)):
        if isinstance(given.get(name), str):
            given[name] = load(spark, given[name])
    return given


def clean_texts(df: DataFrame, cleaners: Spec, column: str = "text", output: str = "cleaned_text") -> DataFrame:
    """Adds the cleaned text for a chain that may hold spelling steps, each a corpus job between expressions."""
    df, part = df.withColumn(output, F.col(column)), []
    for step in [*cleaners, None]:
        name, params = (step, {}) if isinstance(step, str) or step is None else step
        if step is not None and name != SPELLING:
            part.append(step)
            continue
        if part:
            df = df.withColumn(output, clean_column(df, output, part))
            part = []
        if name == SPELLING:
            df = spell_correct(df, output, **spelling_params(df.sparkSession, params))
    return df


def build_corpus(
    spark: SparkSession,
    sources: Mapping[str, SourceFn],
    cleaners: Spec = tuple(DEFAULT_CHAIN),
    min_words: int = 2,
    spelling: Mapping[str, Any] | None = None,
    repartition: Mapping[str, Any] | None = None,
) -> DataFrame:
    """One lazy plan from the sources to the cleaned rows; a step ("spell_correct", {dictionary, bigrams}) is a corpus job of its own.

    `spelling` puts that step at the end of the chain.
    """
    df = read_sources(spark, sources, repartition)
    if spelling:
        cleaners = [*cleaners, (SPELLING, dict(spelling))]
    if any(step[0] == SPELLING for step in cleaners if not isinstance(step, str)):
        return filter_min_words(clean_texts(df, cleaners), "cleaned_text", min_words).select(*CORPUS_COLUMNS)
    return clean_and_filter(df, cleaners, min_words).select(*CORPUS_COLUMNS)


def write_corpus(df: DataFrame, path: str, **params: str) -> DataFrame:
    """Write the splits and the manifest; the counts are taken from the written data. Returns the manifest."""
    write_splits(df, f"{path}/splits")
    written = df.sparkSession.read.parquet(f"{path}/splits")
    write_manifest(written, f"{path}/manifest", **params)
    return manifest(written, **params)


def parse_spec(spec: Mapping[str, Any]) -> dict[str, Any]:
    """The arguments of `build_corpus` from a plain description, checked by name.

    {"sources": {dataset_name: {"source": registered name, **params}}, "cleaners": [name or [name, params]],
     "min_words": n, "repartition": {...}}
    """
    unknown = set(spec) - {"sources", "cleaners", "min_words", "repartition", "spelling"}
    if unknown:
        raise ValueError(f"unknown keys {sorted(unknown)}")
    if not spec.get("sources"):
        raise ValueError("a corpus needs at least one source")
    sources = {}
    for name, given in spec["sources"].items():
        params = dict(given)
        fn = source(params.pop("source"))
        wrong = set(params) - set(inspect.signature(fn).parameters)
        if wrong:
            raise ValueError(f"source {name!r} takes no {sorted(wrong)}")
        sources[name] = partial(fn, **params)
    cleaners = [c if isinstance(c, str) else (c[0], dict(c[1])) for c in spec.get("cleaners", DEFAULT_CHAIN)]
    resolve([c for c in cleaners if isinstance(c, str) or c[0] != SPELLING])
    for _, params in (c for c in cleaners if not isinstance(c, str) and c[0] == SPELLING):
        if not {"dictionary", "bigrams"} <= set(params):
            raise ValueError("spell_correct needs a dictionary and bigrams")
    return {
        "sources": sources, "cleaners": cleaners, "min_words": spec.get("min_words", 2),
        "repartition": spec.get("repartition"), "spelling": spec.get("spelling"),
    }


def run_spec(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    return build_corpus(spark, **parse_spec(spec))
