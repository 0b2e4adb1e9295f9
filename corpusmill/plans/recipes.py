"""How three kinds of sources become labelled, split texts. Each reads its input once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.labels import TOXICITY_FLAGS, any_flag, any_flag_strict, not_category
from corpusmill.operators.relational import drop_sentinel, join_labels, rename_text, union_sources
from corpusmill.operators.splits import stratified_draw
from corpusmill.sources.files import scan_csv, scan_tsv
from corpusmill.sources.registry import register_source

POST_FLAGS = ["hd", "cv", "vo"]
POSTS_SCHEMA = "text string, hd int, cv int, vo int"
COMMENTS_SCHEMA = "id string, comment_text string"
FLAGS_SCHEMA = ", ".join(f"{f} int" for f in TOXICITY_FLAGS)
TWEETS_SCHEMA = "tweet_text string, cyberbullying_type string"


def _dev_or_train(ratio: float, salt: str, *key: str | Column) -> Column:
    return F.when(stratified_draw(ratio, "label", salt, *key), "dev").otherwise("train")


def flagged_posts(train: DataFrame, test: DataFrame, dev_ratio: float = 0.3, key: tuple[str, ...] = ("text",)) -> DataFrame:
    """Annotator flags; the train file gives train and dev, the test file is kept."""
    return union_sources([posts_of(train, F.lit(False), dev_ratio, key), posts_of(test, F.lit(True), dev_ratio, key)])


def posts_of(rows: DataFrame, is_test: Column, dev_ratio: float = 0.3, key: tuple[str, ...] = ("text",)) -> DataFrame:
    """The same for rows of one table, which is read once."""
    labelled = rows.withColumn("label", any_flag_strict(*POST_FLAGS))
    return labelled.withColumn("split", F.when(is_test, "test").otherwise(_dev_or_train(dev_ratio, "posts-dev", *key)))


def flagged_comments(
    train: DataFrame, test: DataFrame, test_labels: DataFrame, dev_ratio: float = 0.03, kept_test: float = 0.1,
    key: tuple[str, ...] = ("id",),
) -> DataFrame:
    """Toxicity flags; the labelled test rows keep a share as test and give the rest to train and dev."""
    tested = drop_sentinel(join_labels(test, test_labels, "id"), "toxic")
    return union_sources([
        comments_of(train, F.lit(False), dev_ratio, kept_test, key), comments_of(tested, F.lit(True), dev_ratio, kept_test, key),
    ])


def comments_of(
    rows: DataFrame, tested: Column, dev_ratio: float = 0.03, kept_test: float = 0.1, key: tuple[str, ...] = ("id",)
) -> DataFrame:
    """The same for rows of one table, which is read once; `tested` marks the labelled test rows."""
    labelled = rename_text(rows, {"comment_text": "text"}).withColumn("label", any_flag(*TOXICITY_FLAGS))
    kept = tested & stratified_draw(kept_test, "label", "comments-test", *key)
    return labelled.withColumn("split", F.when(kept, "test").otherwise(_dev_or_train(dev_ratio, "comments-dev", *key)))


def categorised_tweets(
    tweets: DataFrame, test_ratio: float = 0.1, dev_ratio: float = 0.125, negative: str = "not_cyberbullying",
    key: tuple[str, ...] = ("text",),
) -> DataFrame:
    """One category per text; test first, then dev from what is left, each with its own draw."""
    named = rename_text(tweets, {"tweet_text": "text", "cyberbullying_type": "label"})
    labelled = named.withColumn("label", not_category(F.col("label"), negative))
    test = stratified_draw(test_ratio, "label", "tweets-test", *key)
    return labelled.withColumn("split", F.when(test, "test").otherwise(_dev_or_train(dev_ratio, "tweets-dev", *key)))


def posts_from_files(spark: SparkSession, train_path: str, test_path: str, dev_ratio: float = 0.3) -> DataFrame:
    return flagged_posts(scan_tsv(spark, train_path, POSTS_SCHEMA), scan_tsv(spark, test_path, POSTS_SCHEMA), dev_ratio)


def comments_from_files(
    spark: SparkSession, train_path: str, test_path: str, test_labels_path: str, dev_ratio: float = 0.03
) -> DataFrame:
    return flagged_comments(
        scan_csv(spark, train_path, f"{COMMENTS_SCHEMA}, {FLAGS_SCHEMA}"),
        scan_csv(spark, test_path, COMMENTS_SCHEMA),
        scan_csv(spark, test_labels_path, f"id string, {FLAGS_SCHEMA}"),
        dev_ratio,
    )


def tweets_from_files(spark: SparkSession, path: str, test_ratio: float = 0.1, dev_ratio: float = 0.125) -> DataFrame:
    return categorised_tweets(scan_csv(spark, path, TWEETS_SCHEMA), test_ratio, dev_ratio)


register_source("posts", posts_from_files)
register_source("comments", comments_from_files)
register_source("tweets", tweets_from_files)
