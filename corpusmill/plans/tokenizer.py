"""Learning and use of a tokenizer described by plain parameters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.decoders import DECODERS
from corpusmill.functions.normalizers import normalize
from corpusmill.functions.pretokenizers import pretokenize
from corpusmill.operators.encode import encode
from corpusmill.operators.postprocess import byte_level_tokens, pad_batch, post_bert, post_byte_level, post_roberta
from corpusmill.operators.unigram import train_unigram
from corpusmill.operators.vocab import Vocabulary, train_bpe, train_word_level, train_wordpiece
from corpusmill.operators.words import token_counts
from corpusmill.session import materialize
from corpusmill.sources.sinks import save_vocab

Trainer = Callable[..., Vocabulary]

_trainers: dict[str, Trainer] = {
    "word_level": train_word_level,
    "bpe": train_bpe,
    "wordpiece": train_wordpiece,
    "unigram": train_unigram,
}


def register_trainer(name: str, fn: Trainer) -> None:
    """`fn(counts, **params)` makes a vocabulary from a table (word, cnt)."""
    _trainers[name] = fn


@dataclass(frozen=True)
class TokenizerSpec:
    trainer: str = "bpe"
    trainer_params: dict[str, Any] = field(default_factory=dict)
    pre_tokenizer: tuple = (("whitespace", {}),)
    normalizer: tuple = ()
    decoder: tuple | None = None
    post_processor: str | None = None
    # Options of the byte-level and the second pair form: trim_offset, add_prefix_space.
    post_params: dict[str, bool] = field(default_factory=dict)
    # None, or one of {"length": n}, {"batch": column}, {"longest": True}.
    padding: dict[str, Any] | None = None
    cls_token: str = "[CLS]"
    sep_token: str = "[SEP]"
    pad_token: str = "[PAD]"

    def __post_init__(self) -> None:
        if self.trainer not in _trainers:
            raise ValueError(f"unknown trainer {self.trainer!r}; known: {sorted(_trainers)}")
        if self.decoder and self.decoder[0] not in DECODERS:
            raise ValueError(f"unknown decoder {self.decoder[0]!r}")
        if self.post_processor not in (None, "bert", "roberta", "byte_level"):
            raise ValueError(f"unknown post-processor {self.post_processor!r}")
        if set(self.post_params) - {"trim_offset", "add_prefix_space"}:
            raise ValueError(f"unknown post-processor options {sorted(self.post_params)}")
        if self.padding is not None and (len(self.padding) != 1 or set(self.padding) - {"length", "batch", "longest"}):
            raise ValueError("padding is one of length, batch, longest")

    def tokens(self, text: Column) -> Column:
        return pretokenize(normalize(text, self.normalizer), self.pre_tokenizer)


def train_tokenizer(df: DataFrame, text_column: str, spec: TokenizerSpec, save_to: str | None = None) -> Vocabulary:
    counts = token_counts(df, spec.tokens(F.col(text_column)))
    v = _trainers[spec.trainer](counts, **spec.trainer_params)
    if save_to:
        save_vocab(v, save_to)
    return v


def train_tokenizer_from_parquet(
    spark: SparkSession, path: str, text_column: str, spec: TokenizerSpec, save_to: str | None = None
) -> Vocabulary:
    """Read one column of a written corpus and learn from it."""
    return train_tokenizer(spark.read.parquet(path).select(text_column), text_column, spec, save_to)


def encode_texts(df: DataFrame, text_column: str, spec: TokenizerSpec, v: Vocabulary, **options: Any) -> DataFrame:
    """Adds `ids`, with a pair form `type_ids`, and with padding `attention_mask`. Special tokens go by the names in `spec`."""
    tokens = df.withColumn("_tokens", spec.tokens(F.col(text_column)))
    out = encode(tokens, "_tokens", v, **options).drop("_tokens")
    names = {spec.cls_token, spec.sep_token, spec.pad_token}
    ids = {r["token"]: r["id"] for r in v.vocab.where(F.col("token").isin(*names)).collect()}
    if spec.post_processor in ("bert", "roberta"):
        post = {"bert": post_bert, "roberta": post_roberta}[spec.post_processor]
        whole, types = post(F.col("ids"), sep=ids[spec.sep_token], cls=ids[spec.cls_token])
        out = out.withColumns({"ids": whole, "type_ids": types})
    if spec.padding is not None:
        # The widths are found in the encoded rows, so these are written once rather than encoded twice.
        where = {k: value for k, value in spec.padding.items() if k != "longest"}
        out = out if "length" in where else materialize(out, "encoded")
        out = pad_batch(out, "ids", pad=ids[spec.pad_token], **where)
    return out


def token_offsets(df: DataFrame, text_column: str, spec: TokenizerSpec, key: list[str]) -> DataFrame:
    """(key, position, token, start, end): the byte-level tokens of each text with their places, as the post-processor wants them."""
    return post_byte_level(byte_level_tokens(df, text_column, key), **spec.post_params)


def decode_tokens(tokens: Column, spec: TokenizerSpec) -> Column:
    if spec.decoder is None:
        return F.array_join(tokens, " ")
    name, params = spec.decoder
    return DECODERS[name](tokens, **params)
