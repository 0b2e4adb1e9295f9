"""Spelling answers that the batches of a stream keep for later ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.spelling import MAX_DISTANCE, PREFIX_LENGTH, spell_best

ANSWER = "token string, term string, cnt bigint, distance int"


class Answers:
    """The nearest terms of all words that earlier batches asked for, as a table with a folder per batch.

    A batch sees the answers of the batches before it, works out the words that none of them asked for, and writes these
    to its own folder. If it runs again, it sees the same answers and writes its folder anew, so the table is that of a
    run without failures. Words without a term near them are kept too, with a null term. The answers depend on the
    dictionary and the distance, so each has a table of its own.
    """

    def __init__(self, folder: str, dictionary: DataFrame, max_distance: int = MAX_DISTANCE, prefix_length: int = PREFIX_LENGTH) -> None:
        row = dictionary.agg(F.count("*").alias("n"), F.coalesce(F.expr("bit_xor(xxhash64(term, cnt))"), F.lit(0)).alias("mark")).first()
        self.folder = f"{folder}/terms={row['n']}-{row['mark'] & (2**64 - 1):016x}-{max_distance}"
        self.dictionary, self.max_distance, self.prefix_length = dictionary, max_distance, prefix_length
        none = dictionary.sparkSession.createDataFrame([], ANSWER)
        none.write.mode("ignore").parquet(f"{self.folder}/batch=-1/ask=0")

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{ANSWER}, batch bigint, ask int").parquet(self.folder)

    def of_batch(self, batch: int) -> Callable[[DataFrame], DataFrame]:
        """`spell_best` for one batch."""
        asked = 0

        def find(tokens: DataFrame) -> DataFrame:
            nonlocal asked
            spark, own = tokens.sparkSession, f"{self.folder}/batch={batch}/ask={asked}"
            asked += 1
            earlier = self.table(spark).where(F.col("batch") < batch).drop("batch", "ask")
            unknown = tokens.select("token").distinct().join(earlier, "token", "left_anti")
            found = spell_best(unknown, self.dictionary, self.max_distance, self.prefix_length)
            unknown.join(found, "token", "left").select("token", "term", "cnt", "distance").write.mode("overwrite").parquet(own)
            # Two calls of a batch may have asked for the same word; the answers are the same.
            known = tokens.select("token").join(earlier, "token").distinct()
            return known.unionByName(spark.read.schema(ANSWER).parquet(own)).where(F.col("term").isNotNull())

        return find
