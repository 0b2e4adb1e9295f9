"""Detokenisers: array<string> -> string."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.pretokenizers import LATIN1, byte_alphabet

# Spacing clean-up after joining word pieces, in order.
CLEANUP = [
    (" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"), (" n't", "n't"), (" 'm", "'m"),
    (" do not", " don't"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re"),
]


def _cleanup(token: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), CLEANUP, token)


def decode_bpe(tokens: Column, suffix: str = "</w>") -> Column:
    def spaced(some: Column, end: str) -> Column:
        return F.transform(some, lambda t: F.replace(t, F.lit(suffix), F.lit(end)))

    n = F.size(tokens)
    inner, last = F.slice(tokens, 1, F.greatest(n - 1, F.lit(0))), F.slice(tokens, F.greatest(n, F.lit(1)), 1)
    return F.array_join(F.concat(spaced(inner, " "), spaced(last, "")), "")


def decode_byte_level(tokens: Column) -> Column:
    """Back from byte characters to text; a token with other characters stands for its own bytes."""
    alphabet = byte_alphabet()

    def latin(token: Column) -> Column:
        known = F.translate(token, alphabet, LATIN1)
        own = F.decode(F.encode(token, "UTF-8"), "ISO-8859-1")
        return F.when(F.translate(token, alphabet, "") == "", known).otherwise(own)

    joined = F.array_join(F.transform(tokens, latin), "")
    return F.make_valid_utf8(F.encode(joined, "ISO-8859-1").cast("string"))


def decode_ctc(tokens: Column, pad_token: str = "<pad>", word_delimiter_token: str = "|", cleanup: bool = True) -> Column:
    before = F.concat(F.array(F.lit(None).cast("string")), tokens)
    changed = F.zip_with(tokens, before, lambda t, b: F.when(b.isNull() | (t != b), t))
    first_of_run = F.filter(changed, lambda t: t.isNotNull())

    def text(token: Column) -> Column:
        token = F.replace(token, F.lit(pad_token), F.lit(""))
        if cleanup:
            token = F.replace(_cleanup(token), F.lit(word_delimiter_token), F.lit(" "))
        return token

    return F.array_join(F.transform(first_of_run, text), "")


def decode_metaspace(tokens: Column, replacement: str = "_", add_prefix_space: bool = True) -> Column:
    if len(replacement) != 1:
        raise ValueError(f"replacement must be one character, got {len(replacement)}")
    first = F.lit("" if add_prefix_space else " ")
    spaced = F.transform(
        tokens, lambda t, i: F.replace(t, F.lit(replacement), F.when(i == 0, first).otherwise(F.lit(" ")))
    )
    return F.array_join(spaced, "")


def decode_wordpiece(tokens: Column, prefix: str = "##", cleanup: bool = True) -> Column:
    def text(token: Column, i: Column) -> Column:
        continued = F.when(token.startswith(prefix), F.substring(token, len(prefix) + 1, 2**31 - 1))
        token = F.when(i == 0, token).otherwise(F.coalesce(continued, F.concat(F.lit(" "), token)))
        return _cleanup(token) if cleanup else token

    return F.array_join(F.transform(tokens, text), "")


DECODERS = {
    "bpe": decode_bpe,
    "byte_level": decode_byte_level,
    "ctc": decode_ctc,
    "metaspace": decode_metaspace,
    "wordpiece": decode_wordpiece,
}
