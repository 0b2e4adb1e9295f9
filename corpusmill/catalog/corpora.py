"""Splits, source recipes and whole corpus builds."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.cleaning import FULL, chain_sql
from corpusmill.catalog.common import Group, below, table, texts, words
from corpusmill.catalog.tables import COMMENT_FLAGS, POST_FLAGS, post_flags
from corpusmill.functions.cleaners import words_of
from corpusmill.functions.labels import TOXICITY_FLAGS
from corpusmill.operators.relational import union_sources
from corpusmill.operators.words import token_counts
from corpusmill.operators.splits import quota_split, random_split, stratified_split
from corpusmill.plans import recipes
from corpusmill.plans.corpus import build_corpus, run_spec, write_corpus
from corpusmill.session import shared_folder
from corpusmill.sources.registry import read_source, read_sources, register_source
from corpusmill.sources.sinks import read_splits, write_splits

GROUP = Group()
query = GROUP.query


def sides(first, second):
    return union_sources([first.withColumn("side", F.lit("first")), second.withColumn("side", F.lit("second"))])


# Splits

@query("random_split", f"SELECT doc_id, CASE WHEN {below(0.3, 's1', 'doc_id')} THEN 'second' ELSE 'first' END AS side FROM documents")
def _(spark, sf):
    return sides(*random_split(table(spark, sf, "documents").select("doc_id"), 0.3, "s1", "doc_id"))


@query("stratified_split", f"""
    SELECT doc_id, lang, CASE WHEN {below(0.25, 's2', 'lang', 'doc_id')} THEN 'second' ELSE 'first' END AS side FROM documents
""")
def _(spark, sf):
    return sides(*stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), 0.25, "lang", "s2", "doc_id"))


@query("stratified_split_by_ratio", f"""
    SELECT doc_id, lang, CASE WHEN lang = 'en' AND {below(0.1, 's3', 'lang', 'doc_id')} OR lang = 'fr' AND {below(0.5, 's3', 'lang', 'doc_id')}
    THEN 'second' ELSE 'first' END AS side FROM documents
""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return sides(*stratified_split(docs, {"en": 0.1, "fr": 0.5}, "lang", "s3", "doc_id"))


@query("quota_split", """
    SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5(concat_ws(':', 's4', doc_id)))
    <= floor(0.2::DOUBLE * count(*) OVER (PARTITION BY lang)) THEN 'second' ELSE 'first' END AS side FROM documents
""")
def _(spark, sf):
    return sides(*quota_split(table(spark, sf, "documents").select("doc_id", "lang"), 0.2, "lang", "s4", "doc_id"))


# Recipes. Posts in English make the train file and the others the test file; comments without a label
# make the train file and the labelled ones the test file.

def posts(spark, dev_ratio=0.3, folder=""):
    return recipes.posts_of(post_flags(spark, folder), F.coalesce(F.col("lang") != "en", F.lit(True)), dev_ratio, ("doc_id",))


def comments(spark, dev_ratio=0.03, folder=""):
    joined = texts(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    flags = [F.coalesce("toxic", F.lit(0)), F.col("quality"), *[F.lit(0)] * 4]
    rows = joined.select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("comment_text"), F.col("toxic").isNotNull().alias("tested"),
        *[c.cast("int").alias(f) for c, f in zip(flags, TOXICITY_FLAGS)],
    )
    return recipes.comments_of(rows, F.col("tested"), dev_ratio)


def tweets(spark, folder=""):
    rows = texts(spark, folder, "conversations").select(
        "conv_id", "turn", F.col("text").alias("tweet_text"), F.col("role").alias("cyberbullying_type")
    )
    return recipes.categorised_tweets(rows, negative="user", key=("conv_id", "turn"))


register_source("document_posts", posts)
register_source("document_comments", comments)
register_source("conversation_tweets", tweets)

POSTS = f"""(SELECT doc_id, text, label, CASE WHEN lang <> 'en' THEN 'test' WHEN {below(0.3, 'posts-dev', 'label', 'doc_id')} THEN 'dev'
    ELSE 'train' END AS split FROM (SELECT *, coalesce((hd + cv + vo > 0)::INT, 0) AS label FROM {POST_FLAGS}))"""
COMMENTS = f"""(SELECT id, text, label, CASE WHEN labelled AND {below(0.1, 'comments-test', 'label', 'id')} THEN 'test'
    WHEN {below(0.03, 'comments-dev', 'label', 'id')} THEN 'dev' ELSE 'train' END AS split
    FROM (SELECT f.id, d.text, f.toxic <> -1 AS labelled,
        (CASE WHEN f.toxic = -1 THEN 0 ELSE f.toxic END + coalesce(f.severe_toxic, 0) > 0)::INT AS label
        FROM documents d JOIN {COMMENT_FLAGS} f ON d.doc_id::VARCHAR = f.id))"""
TWEETS = f"""(SELECT conv_id, turn, text, label, CASE WHEN {below(0.1, 'tweets-test', 'label', 'conv_id', 'turn')} THEN 'test'
    WHEN {below(0.125, 'tweets-dev', 'label', 'conv_id', 'turn')} THEN 'dev' ELSE 'train' END AS split
    FROM (SELECT *, (role IS DISTINCT FROM 'user')::INT AS label FROM conversations))"""


@query("split_ghc_recipe", f"SELECT doc_id, text, label, split FROM {POSTS}")
def _(spark, sf):
    return posts(spark, folder=sf).select("doc_id", "text", "label", "split")


@query("split_jigsaw_recipe", f"SELECT id, text, label, split FROM {COMMENTS}")
def _(spark, sf):
    return comments(spark, folder=sf).select("id", "text", "label", "split")


@query("split_twitter_recipe", f"SELECT conv_id, turn, text, label, split FROM {TWEETS}")
def _(spark, sf):
    return tweets(spark, folder=sf).select("conv_id", "turn", "text", "label", "split")


# Whole corpora

def three_sources(sf):
    return {
        "posts": lambda s: posts(s, folder=sf),
        "comments": lambda s: comments(s, folder=sf),
        "tweets": lambda s: tweets(s, folder=sf),
    }


CORPUS = "(" + " UNION ALL ".join(
    f"SELECT text, label, split, '{name}' AS dataset_name FROM {sql}" for name, sql in (("posts", POSTS), ("comments", COMMENTS), ("tweets", TWEETS))
) + ")"
CLEANED = f"""(SELECT text, label, split, dataset_name, cleaned_text FROM (
    SELECT original AS text, label, split, dataset_name, text AS cleaned_text FROM {chain_sql(
        f"(SELECT text AS original, label, split, dataset_name, text FROM {CORPUS})", FULL, "original, label, split, dataset_name")})
    WHERE len({words('cleaned_text')}) >= 2)"""


@query("read_sources", f"SELECT text, label, split, dataset_name FROM {CORPUS}")
def _(spark, sf):
    return read_sources(spark, three_sources(sf))


@query("custom_source", """
    SELECT text, 1 AS label, 'train' AS split, 'mine' AS dataset_name FROM documents
    UNION ALL SELECT text, 0, 'dev', 'mine' FROM benchmark UNION ALL SELECT text, 0, 'test', 'mine' FROM conversations
""")
def _(spark, sf):
    def mine(session):
        labels = {"documents": 1, "benchmark": 0, "conversations": 0}
        return tuple(table(session, sf, t).select("text", F.lit(v).alias("label")) for t, v in labels.items())

    return read_source(spark, "mine", mine)


@query("write_splits", f"SELECT conv_id, turn, text, label, split FROM {TWEETS}")
def _(spark, sf):
    path = shared_folder(spark, "splits")
    columns = ["conv_id", "turn", "text", "label", "split"]
    write_splits(tweets(spark, folder=sf).select(*columns), path)
    return read_splits(spark, path, columns)


@query("write_manifest", f"""
    SELECT 'corpus' AS image, 'v5' AS version, count(*)::BIGINT AS n_rows, count_if(split = 'train')::BIGINT AS n_train,
    count_if(split = 'dev')::BIGINT AS n_dev, count_if(split = 'test')::BIGINT AS n_test FROM {TWEETS}
""")
def _(spark, sf):
    path = shared_folder(spark, "corpus")
    written = write_corpus(tweets(spark, folder=sf).select("text", "label", "split"), path, image="corpus", version="v5")
    return spark.read.schema(written.schema).json(f"{path}/manifest")


@query("build_corpus", f"SELECT * FROM {CLEANED}")
def _(spark, sf):
    return build_corpus(spark, three_sources(sf), FULL)


@query("declared_corpus", f"SELECT * FROM {CLEANED}")
def _(spark, sf):
    return run_spec(spark, {
        "sources": {
            "posts": {"source": "document_posts", "dev_ratio": 0.3, "folder": sf},
            "comments": {"source": "document_comments", "dev_ratio": 0.03, "folder": sf},
            "tweets": {"source": "conversation_tweets", "folder": sf},
        },
        "cleaners": FULL,
        "min_words": 2,
    })


@query("corrected_corpus")
def _(spark, sf):
    """The whole configured chain with spelling at its end, declared by name, over all sources with the frequencies of one."""
    folder = shared_folder(spark, "frequencies")
    turns = texts(spark, sf, "conversations").select(words_of(F.lower("text")).alias("ws"))
    counts = token_counts(turns, F.col("ws"))
    counts.select(F.concat_ws(" ", "word", F.col("cnt").cast("string"))).write.text(f"{folder}/words")
    beside = F.zip_with(F.slice("ws", 1, F.greatest(F.size("ws") - 1, F.lit(0))), F.slice("ws", 2, F.greatest(F.size("ws"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    pairs = turns.select(F.explode(beside).alias("pair")).groupBy("pair").agg(F.count("*").alias("cnt"))
    pairs.select(F.concat_ws(" ", "pair", F.col("cnt").cast("string"))).write.text(f"{folder}/pairs")
    return run_spec(spark, {
        "sources": {
            "posts": {"source": "document_posts", "dev_ratio": 0.3, "folder": sf},
            "comments": {"source": "document_comments", "dev_ratio": 0.03, "folder": sf},
            "tweets": {"source": "conversation_tweets", "folder": sf},
        },
        "cleaners": [*FULL, ["spell_correct", {"dictionary": f"{folder}/words", "bigrams": f"{folder}/pairs"}]],
    })


@query("usable_texts", f"SELECT dataset_name, split, label, count(*)::BIGINT AS n FROM {CLEANED} GROUP BY ALL")
def usable_texts(spark, sf):
    """How many usable texts each source, split and label keeps after cleaning."""
    corpus = build_corpus(spark, three_sources(sf), FULL)
    return corpus.groupBy("dataset_name", "split", "label").agg(F.count("*").alias("n"))
