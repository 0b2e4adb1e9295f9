"""Vocabulary learning, encoding and sequence post-processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.common import Group, listed, numbers, texts
from corpusmill.catalog.tables import WHITESPACE, WORD_COUNTS, document_words
from corpusmill.functions.pretokenizers import pretok_whitespace
from corpusmill.operators.encode import encode, encode_by_join, encode_with_dropout
from corpusmill.operators.postprocess import pad_batch, post_bert, post_roberta, special_tokens
from corpusmill.operators.unigram import train_unigram
from corpusmill.operators.vocab import Vocabulary, pair_counts, train_bpe, train_word_level, train_wordpiece
from corpusmill.operators.words import SPECIAL_TOKENS
from corpusmill.plans.tokenizer import TokenizerSpec, encode_texts, register_trainer, token_offsets, train_tokenizer_from_parquet
from corpusmill.session import materialize, shared_folder
from corpusmill.sources.sinks import load_vocab, save_vocab

GROUP = Group()
query = GROUP.query

SPECIAL_ROWS = "(VALUES " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(SPECIAL_TOKENS)) + ") AS s(id, token)"
WORD_LEVEL = f"""(SELECT id::INT AS id, token, NULL::BIGINT AS cnt FROM {SPECIAL_ROWS} UNION ALL
    SELECT (row_number() OVER (ORDER BY cnt DESC, word) + 4)::INT, word, cnt FROM
    (SELECT * FROM ({WORD_COUNTS}) WHERE cnt >= 2 ORDER BY cnt DESC, word LIMIT 995))"""
# Texts as ids: each word looked up, 0 for the unknown, in order.
IDS = f"""(SELECT c.conv_id, c.turn, coalesce(e.ids, []) AS ids FROM conversations c LEFT JOIN (
    SELECT conv_id, turn, list(coalesce(v.id, 0) ORDER BY pos) AS ids FROM (
        SELECT conv_id, turn, unnest(ts) AS word, unnest(range(len(ts))) AS pos
        FROM (SELECT conv_id, turn, regexp_extract_all(text, '{WHITESPACE}') AS ts FROM conversations)) t
    LEFT JOIN {WORD_LEVEL} v ON v.token = t.word GROUP BY ALL) e USING (conv_id, turn))"""


def word_level(spark, sf) -> Vocabulary:
    return train_word_level(document_words(spark, sf), vocab_size=1000, min_frequency=2)


def turns(spark, sf):
    rows = texts(spark, sf, "conversations")
    return rows.select("conv_id", "turn", "role", pretok_whitespace(F.col("text")).alias("tokens"))


def encoded_turns(spark, sf):
    coded = encode(turns(spark, sf), "tokens", word_level(spark, sf)).select("conv_id", "turn", "ids")
    return materialize(coded, "encoded-turns")


# Learning

@query("train_word_level", f"SELECT * FROM {WORD_LEVEL}")
def _(spark, sf):
    return word_level(spark, sf).vocab.select("id", "token", "cnt")


@query("save_vocab", f"SELECT * FROM {WORD_LEVEL}")
def _(spark, sf):
    path = shared_folder(spark, "vocabulary")
    save_vocab(word_level(spark, sf), path)
    return load_vocab(spark, path).vocab.select("id", "token", "cnt")


@query("special_tokens", f"SELECT id::INT AS id, token FROM {SPECIAL_ROWS} UNION ALL SELECT (row_number() OVER (ORDER BY cnt DESC, word) + 4)::INT, word"
       f" FROM (SELECT * FROM ({WORD_COUNTS}) ORDER BY cnt DESC, word LIMIT 20)")
def _(spark, sf):
    v = train_word_level(document_words(spark, sf), vocab_size=len(SPECIAL_TOKENS) + 20)
    return special_tokens(spark).unionByName(v.vocab.where(F.col("cnt").isNotNull()).select("id", "token"))


@query("bpe_pair_counts", f"""
    SELECT pair, sum(cnt)::BIGINT AS cnt FROM (
        SELECT cnt, substr(word, i, 2) AS pair FROM (SELECT word, cnt, unnest(range(1, length(word))) AS i FROM ({WORD_COUNTS})))
    GROUP BY pair
""")
def _(spark, sf):
    return pair_counts(document_words(spark, sf))


@query("train_bpe")
def _(spark, sf):
    v = train_bpe(document_words(spark, sf))
    return v.merges


@query("train_wordpiece")
def _(spark, sf):
    return train_wordpiece(document_words(spark, sf)).vocab.select("id", "token", "cnt")


@query("train_unigram")
def _(spark, sf):
    v = train_unigram(document_words(spark, sf))
    return v.vocab.select("id", "token", F.round("score", 6).alias("score"))


# Encoding

@query("encode_word_level", f"SELECT conv_id, turn, array_to_string(ids, ' ') AS ids FROM {IDS}")
def _(spark, sf):
    return encoded_turns(spark, sf).withColumn("ids", numbers(F.col("ids")))


@query("encode_word_level_documents", f"""
    SELECT doc_id, coalesce(ids, '') AS ids FROM documents LEFT JOIN (
        SELECT doc_id, string_agg(coalesce(v.id, 0)::VARCHAR, ' ' ORDER BY pos) AS ids FROM (
            SELECT doc_id, unnest(ts) AS word, unnest(range(len(ts))) AS pos
            FROM (SELECT doc_id, regexp_extract_all(text, '{WHITESPACE}') AS ts FROM documents)) t
        LEFT JOIN {WORD_LEVEL} v ON v.token = t.word GROUP BY ALL) USING (doc_id)
""")
def _(spark, sf):
    return encode(document_tokens(spark, sf), "tokens", word_level(spark, sf)).select("doc_id", numbers(F.col("ids")).alias("ids"))


@query("encode_word_level_by_join", f"SELECT conv_id, turn, array_to_string(ids, ' ') AS ids FROM {IDS}")
def _(spark, sf):
    joined = encode_by_join(turns(spark, sf), "tokens", word_level(spark, sf), ["conv_id", "turn"])
    return joined.select("conv_id", "turn", numbers(F.col("ids")).alias("ids"))


def document_tokens(spark, sf):
    return texts(spark, sf, "documents").select("doc_id", pretok_whitespace(F.col("text")).alias("tokens"))


def _encoding(name, train):
    @query(name)
    def run(spark, sf):
        out = encode(document_tokens(spark, sf), "tokens", train(document_words(spark, sf)))
        return out.select("doc_id", numbers(F.col("ids")).alias("ids"))


_encoding("encode_bpe", train_bpe)
_encoding("encode_wordpiece", train_wordpiece)
_encoding("encode_unigram", train_unigram)


@query("encode_bpe_dropout")
def _(spark, sf):
    v = train_bpe(document_words(spark, sf), vocab_size=600)
    return encode_with_dropout(document_tokens(spark, sf), "tokens", v, ["doc_id"], 0.1).select("doc_id", numbers(F.col("ids")).alias("ids"))


@query("train_tokenizer")
def _(spark, sf):
    spec = TokenizerSpec("bpe", {"vocab_size": 500}, post_processor="bert")
    folder = shared_folder(spark, "tokenizer")
    train_tokenizer_from_parquet(spark, f"{sf}/documents.parquet", "text", spec, folder)
    coded = encode_texts(texts(spark, sf, "conversations"), "text", spec, load_vocab(spark, folder))
    return coded.select("conv_id", "turn", numbers(F.col("ids")).alias("ids"), numbers(F.col("type_ids")).alias("type_ids"))


@query("train_tokenizer_word_level", f"""
    SELECT conv_id, turn, array_to_string(list_concat(whole, list_transform(range(w - len(whole)), lambda i: {SPECIAL_TOKENS.index('[PAD]')})), ' ') AS ids,
    array_to_string(list_concat(list_transform(range(len(whole)), lambda i: 1), list_transform(range(w - len(whole)), lambda i: 0)), ' ') AS attention_mask
    FROM (SELECT *, max(len(whole)) OVER (PARTITION BY conv_id) AS w FROM (
        SELECT conv_id, turn, list_concat([{SPECIAL_TOKENS.index('[CLS]')}], ids, [{SPECIAL_TOKENS.index('[SEP]')}]) AS whole FROM {IDS}))
""")
def _(spark, sf):
    spec = TokenizerSpec("word_level", {"vocab_size": 1000, "min_frequency": 2}, post_processor="bert", padding={"batch": "conv_id"})
    folder = shared_folder(spark, "tokenizer")
    train_tokenizer_from_parquet(spark, f"{sf}/documents.parquet", "text", spec, folder)
    coded = encode_texts(texts(spark, sf, "conversations"), "text", spec, load_vocab(spark, folder))
    return coded.select("conv_id", "turn", numbers(F.col("ids")).alias("ids"), numbers(F.col("attention_mask")).alias("attention_mask"))


def _letters(counts, special=SPECIAL_TOKENS):
    """A vocabulary of single characters by frequency."""
    chars = counts.select(F.explode(F.split("word", "")).alias("word"), "cnt").groupBy("word").agg(F.sum("cnt").alias("cnt"))
    return train_word_level(chars, special_tokens=special)


@query("custom_trainer", f"""
    SELECT id::INT AS id, token FROM {SPECIAL_ROWS} UNION ALL
    SELECT (row_number() OVER (ORDER BY sum(cnt) DESC, ch) + 4)::INT, ch
    FROM (SELECT unnest(string_split(word, '')) AS ch, cnt FROM ({WORD_COUNTS})) GROUP BY ch
""")
def _(spark, sf):
    register_trainer("letters", _letters)
    v = train_tokenizer_from_parquet(spark, f"{sf}/documents.parquet", "text", TokenizerSpec("letters"))
    return v.vocab.select("id", "token")


# Sequences

@query("pad_batch", f"""
    SELECT conv_id, turn, array_to_string(list_concat(ids, list_transform(range(w - len(ids)), lambda i: 3)), ' ') AS ids,
    array_to_string(list_concat(list_transform(range(len(ids)), lambda i: 1), list_transform(range(w - len(ids)), lambda i: 0)), ' ') AS attention_mask
    FROM (SELECT *, max(len(ids)) OVER () AS w FROM {IDS})
""")
def _(spark, sf):
    padded = pad_batch(encoded_turns(spark, sf), "ids", pad=3)
    return padded.select("conv_id", "turn", numbers(F.col("ids")).alias("ids"), numbers(F.col("attention_mask")).alias("attention_mask"))


@query("pad_batch_per_conversation", f"""
    SELECT conv_id, turn, array_to_string(list_concat(ids, list_transform(range(w - len(ids)), lambda i: 3)), ' ') AS ids
    FROM (SELECT *, max(len(ids)) OVER (PARTITION BY conv_id) AS w FROM {IDS})
""")
def _(spark, sf):
    padded = pad_batch(encoded_turns(spark, sf), "ids", pad=3, batch="conv_id")
    return padded.select("conv_id", "turn", numbers(F.col("ids")).alias("ids"))


def _pairs_sql(between: str, cls: str, sep: str, second_type: int) -> str:
    return f"""SELECT conv_id, turn, array_to_string(list_concat(['{cls}'], a, {between}, [role, '{sep}']), '|') AS tokens,
        array_to_string(list_concat(list_transform(range(len(a) + 2), lambda i: 0), list_transform(range(2 + {int(second_type == 0)}),
        lambda i: {second_type})), ' ') AS type_ids
        FROM (SELECT *, regexp_extract_all(text, '{WHITESPACE}') AS a FROM conversations)"""


def _pair_query(post, sep, cls):
    def run(spark, sf):
        tokens, types = post(F.col("tokens"), sep=sep, cls=cls, b=F.array("role"))
        return turns(spark, sf).select("conv_id", "turn", listed(tokens).alias("tokens"), numbers(types).alias("type_ids"))

    return run


query("post_bert", _pairs_sql("['[SEP]']", "[CLS]", "[SEP]", 1))(_pair_query(post_bert, "[SEP]", "[CLS]"))
query("post_roberta", _pairs_sql("['</s>', '</s>']", "<s>", "</s>", 0))(_pair_query(post_roberta, "</s>", "<s>"))


@query("post_byte_level")
def _(spark, sf):
    return token_offsets(texts(spark, sf, "conversations"), "text", TokenizerSpec(post_processor="byte_level"), ["conv_id", "turn"])

