"""Cleaners in text and word-list form, chains, extension points and the stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from corpusmill.catalog.common import TWEET_LIKE, Group, blanks, each, join, keep, listed, q, sub, table, texts, tweet_like, words
from corpusmill.functions import cleaners as C
from corpusmill.functions import treebank
from corpusmill.functions.charclasses import ASCII_PUNCTUATION, WORD, WS
from corpusmill.plans.corpus import map_text
from corpusmill.session import shared_folder
from corpusmill.streaming.clean import run_clean_stream

GROUP = Group()
query = GROUP.query

STOP_LIST = ", ".join(f"'{q(w)}'" for w in C.ENGLISH_STOPWORDS)
DELETED = f"'{q(ASCII_PUNCTUATION)}'"


def no_retweet(x: str) -> str:
    """Mark the runs of word characters, delete the runs that read RT, take the marks away."""
    marked = sub(x, f"([{WORD}]+)", "\x01\\1\x02")
    return f"translate({sub(marked, chr(1) + '[rR][tT]' + chr(2), '')}, '\x01\x02', '')"


# The published tokeniser rules one by one, for an engine without look-around.
RULES = [
    ("([«“‘„]|[`]+)", " \\1 "), ('^"', "``"), ("(``)", " \\1 "), ("([ (\\[{<])(\"|'{2})", "\\1 `` "),
    ("(?i)(')([a-ce-lo-ru-z0-9_])\\b", "\\1 \\2"),
    (f"([^.])(\\.)([\\])}}>\"'»”’ ]*)[{WS}]*$", "\\1 \\2 \\3 "), ("([:,])([^\\p{Nd}])", " \\1 \\2"), ("([:,])$", " \\1 "),
    ("(\\.{2,})", " \\1 "), ("([;@#$%&])", " \\1 "), (f"([^.])(\\.)([\\])}}>\"']*)[{WS}]*$", "\\1 \\2\\3 "),
    ("([?!])", " \\1 "), ("([^'])' ", "\\1 ' "), ("([*])", " \\1 "), ("([\\]\\[(){}<>])", " \\1 "), ("--", " -- "),
]
RULES_BETWEEN_BLANKS = [
    ("([»”’])", " \\1 "), ("''", " '' "), ('"', " '' "), (f"[{WS}]+", " "), ("([^' ])('[sS]|'[mM]|'[dD]|') ", "\\1 \\2 "),
    ("([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "\\1 \\2 "),
    *[(f"(?i)\\b({a})({b})\\b", " \\1 \\2 ") for a, b in (
        ("can", "not"), ("d", "'ye"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("more", "'n"))],
    (f"(?i)\\b(wan)(na)([{WS}])", " \\1 \\2 \\3"), ("(?i) ('t)(is)\\b", " \\1 \\2 "), ("(?i) ('t)(was)\\b", " \\1 \\2 "),
]


def treebank_words(x: str) -> str:
    marked = sub(x, f"([.?!])[{WS}]+(\\p{{Lu}})", "\\1\x03\\2")
    out = reduce(lambda w, rule: sub(w, *rule), RULES, "w")
    out = reduce(lambda w, rule: sub(w, *rule), RULES_BETWEEN_BLANKS, f"concat(' ', {out}, ' ')")
    return words(join(each(f"string_split({marked}, '\x03')", out), " "))


TEXT_SQL = {
    "stopwords": lambda x: join(keep(treebank_words(x), f"lower(w) NOT IN ({STOP_LIST})"), " "),
    "lowercase": lambda x: f"lower({x})",
    "strip_urls": lambda x: sub(x, f"(?:http|www)[^{WS}]+"),
    "strip_punctuation": lambda x: f"translate({blanks(x)}, {DELETED}, '')",
    "keep_alpha_words": lambda x: join(keep(words(x), r"regexp_full_match(w, '\p{L}+')"), " "),
    "newline_to_space": lambda x: f"replace({x}, chr(10), ' ')",
    "keep_ascii_words": lambda x: join(keep(words(x), r"regexp_full_match(w, '[\x00-\x7F]*')"), " "),
    "strip_mentions": lambda x: sub(x, r"@[\p{L}\p{N}_]+"),
    "strip_retweet": no_retweet,
    "limit_chars": lambda x: f"substring({x}, 1, 300)",
}


def through_text(name: str):
    return lambda xs: words(TEXT_SQL[name](join(xs, " ")))


WORDS_SQL = {
    "stopwords": lambda xs: keep(xs, f"lower(w) NOT IN ({STOP_LIST})"),
    "lowercase": lambda xs: each(xs, "lower(w)"),
    "strip_urls": lambda xs: each(xs, sub("w", f"(?:http|www)[^{WS}]+")),
    "strip_punctuation": lambda xs: each(xs, f"translate(w, {DELETED}, '')"),
    "keep_alpha_words": lambda xs: keep(xs, r"regexp_full_match(w, '\p{L}+')"),
    "newline_to_space": lambda xs: each(xs, "replace(w, chr(10), ' ')"),
    "keep_ascii_words": lambda xs: keep(xs, r"regexp_full_match(w, '[\x00-\x7F]*')"),
    "strip_mentions": through_text("strip_mentions"),
    "strip_retweet": through_text("strip_retweet"),
    "limit_chars": through_text("limit_chars"),
}


def _text_query(name):
    def run(spark, sf):
        docs = tweet_like(texts(spark, sf, "documents"))
        return docs.select("doc_id", C.cleaner(name).text(F.col("text")).alias("cleaned_text"))

    return run


def _words_query(name):
    def run(spark, sf):
        docs = tweet_like(texts(spark, sf, "documents")).select("doc_id", F.split("text", " ").alias("words"))
        return docs.select("doc_id", listed(C.cleaner(name).words(F.col("words"))).alias("cleaned_words"))

    return run


for _name in TEXT_SQL:
    query(_name, f"SELECT doc_id, {TEXT_SQL[_name]('text')} AS cleaned_text FROM {TWEET_LIKE}")(_text_query(_name))
    query(
        f"{_name}_words",
        f"SELECT doc_id, {join(WORDS_SQL[_name]('ws'))} AS cleaned_words FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM {TWEET_LIKE})",
    )(_words_query(_name))


@query("treebank_tokens", f"SELECT doc_id, {join(treebank_words('text'))} AS tokens FROM {TWEET_LIKE}")
def _(spark, sf):
    docs = tweet_like(texts(spark, sf, "documents"))
    return docs.select("doc_id", listed(treebank.treebank_tokens(F.col("text"))).alias("tokens"))


def chain_sql(source: str, names: list[str], key: str = "doc_id") -> str:
    """One subquery per cleaner."""
    for name in names:
        source = f"(SELECT {key}, {TEXT_SQL[name]('text')} AS text FROM {source})"
    return source


FULL = [name for name, _ in C.DEFAULT_CHAIN]


@query("clean_chain", f"SELECT conv_id, turn, text AS cleaned_text FROM {chain_sql('conversations', FULL, 'conv_id, turn')}")
def _(spark, sf):
    turns = texts(spark, sf, "conversations")
    return turns.select("conv_id", "turn", C.clean_text(F.col("text"), FULL).alias("cleaned_text"))


@query("default_chain", f"SELECT doc_id, text AS cleaned_text FROM {chain_sql(TWEET_LIKE, FULL)}")
def _(spark, sf):
    docs = tweet_like(texts(spark, sf, "documents"))
    return docs.select("doc_id", C.clean_text(F.col("text")).alias("cleaned_text"))


@query("clean_dispatch", f"""
    SELECT doc_id, lower(text) AS as_text, {join(each("string_split(text, ' ')", "lower(w)"))} AS as_words FROM {TWEET_LIKE}
""")
def _(spark, sf):
    docs = tweet_like(texts(spark, sf, "documents")).withColumn("words", F.split("text", " "))
    by_type = {c: C.clean_column(docs, c, ["lowercase"]) for c in ("text", "words")}
    return docs.select("doc_id", by_type["text"].alias("as_text"), listed(by_type["words"]).alias("as_words"))


@query("map_text", f"SELECT doc_id, replace({blanks('text')}, ' ', '-') AS cleaned_text FROM documents")
def _(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return map_text(docs, lambda c: F.replace(C.normalize_blanks(c), F.lit(" "), F.lit("-"))).drop("text")


@query("map_text_python", "SELECT doc_id, reverse(lower(text)) AS cleaned_text FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return map_text(docs, lambda t: t.lower()[::-1], python=True).drop("text")


@query("custom_cleaner", r"SELECT doc_id, lower(regexp_replace(text, '\p{N}+', '#', 'g')) AS cleaned_text FROM " + TWEET_LIKE)
def _(spark, sf):
    C.register_cleaner("mask_numbers", lambda c: F.regexp_replace(c, r"\p{N}+", "#"))
    docs = tweet_like(texts(spark, sf, "documents"))
    return docs.select("doc_id", C.clean_text(F.col("text"), ["mask_numbers", "lowercase"]).alias("cleaned_text"))


@query("clean_stream", f"SELECT conv_id, turn, text AS cleaned_text FROM {chain_sql('conversations', FULL, 'conv_id, turn')}")
def _(spark, sf):
    arrived = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    folder = shared_folder(spark, "stream")
    arrived.repartition(4).write.parquet(f"{folder}/in")
    run_clean_stream(spark, f"{folder}/in", arrived.schema, f"{folder}/out", f"{folder}/state", FULL)
    return spark.read.parquet(f"{folder}/out").select("conv_id", "turn", "cleaned_text")
