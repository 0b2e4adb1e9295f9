"""The cleaning chain on a stream of texts: the same steps as in batch.

A chain of expressions is a stateless stream. A spelling step is a corpus job, so a chain with one runs it on each batch of
arrived files; the correction of a text depends on the text, the dictionary and the bigrams alone, so the result is
that of the batch job over all files at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from corpusmill.functions.cleaners import DEFAULT_CHAIN, Spec
from corpusmill.operators.relational import add_cleaned_text
from corpusmill.operators.spelling import MAX_DISTANCE, PREFIX_LENGTH
from corpusmill.plans.corpus import SPELLING, clean_texts, spelling_params
from corpusmill.streaming.answers import Answers

FILES_PER_TRIGGER = 1000


def _arrivals(spark: SparkSession, path: str, schema: StructType | str, max_files_per_trigger: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def clean_stream(spark: SparkSession, path: str, schema: StructType | str, spec: Spec = tuple(DEFAULT_CHAIN),
                 max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """A streaming frame of the files that arrive at `path`, with their cleaned text; without spelling steps."""
    return add_cleaned_text(_arrivals(spark, path, schema, max_files_per_trigger), spec)


def _with_spelling(arrivals: DataFrame, output: str, answers: str, spec: Spec) -> DataStreamWriter:
    """Each batch in a folder of its own, which is written anew if the batch runs again."""
    spark = arrivals.sparkSession
    steps, kept = [], {}
    for i, step in enumerate(spec):
        name, params = (step, {}) if isinstance(step, str) else step
        if name == SPELLING:
            params = spelling_params(spark, params)
            limits = {"max_distance": params.get("max_distance", MAX_DISTANCE), "prefix_length": params.get("prefix_length", PREFIX_LENGTH)}
            kept[i] = Answers(f"{answers}/step={i}", params["dictionary"], **limits)
        steps.append((name, params))

    def write(batch: DataFrame, number: int) -> None:
        own = [(name, {**params, "find": kept[i].of_batch(number)} if i in kept else params) for i, (name, params) in enumerate(steps)]
        clean_texts(batch, own).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return arrivals.writeStream.foreachBatch(write)


def run_clean_stream(
    spark: SparkSession, path: str, schema: StructType | str, output: str, checkpoint: str, spec: Spec = tuple(DEFAULT_CHAIN),
    answers: str | None = None, max_files_per_trigger: int = FILES_PER_TRIGGER,
) -> None:
    """Process what has arrived and stop; a later run goes on from the checkpoint, each file exactly once.

    With spelling steps, the output has a folder and a column for each batch, and `answers` names the folder of the answers
    that batches share (beside the checkpoint, if not given). Null texts stay null, empty texts empty.
    """
    if any(not isinstance(step, str) and step[0] == SPELLING for step in spec):
        writer = _with_spelling(_arrivals(spark, path, schema, max_files_per_trigger), output, answers or f"{checkpoint.rstrip('/')}-answers", spec)
    else:
        stream = clean_stream(spark, path, schema, spec, max_files_per_trigger)
        writer = stream.writeStream.format("parquet").outputMode("append").option("path", output)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
