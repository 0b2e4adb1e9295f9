"""Normalisers, pre-tokenisers and detokenisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.common import Group, each, join, keep, listed, sub, texts
from corpusmill.catalog.tables import WHITESPACE
from corpusmill.functions import decoders as D
from corpusmill.functions import normalizers as N
from corpusmill.functions import pretokenizers as P

GROUP = Group()
query = GROUP.query

# Accents apart from their letters, and blanks at both ends.
DECOMPOSED = "replace(replace(text, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776))"
PADDED = "concat(chr(8195), ' ', text, chr(9), ' ')"


def decomposed(c):
    return F.replace(F.replace(c, F.lit("é"), F.lit("é")), F.lit("ü"), F.lit("ü"))


def padded(c):
    return F.concat(F.lit("  "), c, F.lit("\t "))


# Fixed values, written out so that the checks do not share the patterns under test: Unicode white space, and
# punctuation in the wide sense.
BLANK = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SIGN = r"\p{P}$+<=>\^`|~"
NMT = sub(
    sub(PADDED, r"[\x01-\x08\x0B\x0E-\x1F\x7F\x{8F}\x{9F}]"),
    r"[\t\n\f\r\x{1680}\x{200B}-\x{200F}\x{2028}\x{2029}\x{2581}\x{FEFF}\x{FFFD}]", " ",
)
BERT = f"lower(strip_accents({sub(sub(DECOMPOSED, r'[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\x{FFFD}]'), f'[{BLANK}]', ' ')}))"
# A run of blanks gives its last one to the word behind it: a mark before it keeps the two apart.
_BROKEN = sub("CASE WHEN text = '' OR starts_with(text, ' ') THEN text ELSE ' ' || text END", f"([{BLANK}]+)([{BLANK}][^{BLANK}])", "\\1\x01\\2")
_BYTE_PIECES = (f"regexp_extract_all({_BROKEN}, '''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{BLANK}\\p{{L}}\\p{{N}}\x01]+|[{BLANK}]+')")
# Printable Latin-1 bytes stand for themselves, the others take the characters from U+0100 on, in order.
_BYTE = "('0x' || h)::INT"
_BYTE_CHAR = f"""CASE WHEN {_BYTE} BETWEEN 33 AND 126 OR {_BYTE} BETWEEN 161 AND 172 OR {_BYTE} >= 174 THEN chr({_BYTE})
    WHEN {_BYTE} <= 32 THEN chr(256 + {_BYTE}) WHEN {_BYTE} <= 160 THEN chr(256 + {_BYTE} - 94) ELSE chr(256 + 67) END"""
BYTE_LEVEL = each(_BYTE_PIECES, f"array_to_string(list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda h: {_BYTE_CHAR}), '')")


def _normalizer(name, apply, sql=None):
    def run(spark, sf):
        return texts(spark, sf, "documents").select("doc_id", apply(F.col("text")).alias("normalized"))

    query(name, sql and f"SELECT doc_id, {sql} AS normalized FROM documents")(run)


_normalizer("norm_bert", lambda c: N.norm_bert(decomposed(c)), BERT)
_normalizer("norm_lowercase", N.norm_lowercase, "lower(text)")
_normalizer("norm_nfc", lambda c: N.norm_nfc(decomposed(c)), f"nfc_normalize({DECOMPOSED})")
_normalizer("norm_nfd", N.norm_nfd)
_normalizer("norm_nfkc", N.norm_nfkc)
_normalizer("norm_nfkd", N.norm_nfkd)
_normalizer("norm_nmt", lambda c: N.norm_nmt(padded(c)), NMT)
_normalizer("norm_replace", lambda c: N.norm_replace(c, "en.", "<$1>"), "replace(text, 'en.', '<$1>')")
_normalizer("norm_strip_accents", lambda c: N.norm_strip_accents(decomposed(c)), sub(DECOMPOSED, r"\p{M}"))
_normalizer("norm_strip", lambda c: N.norm_strip(padded(c)), sub(PADDED, rf"^[{BLANK}]+|[{BLANK}]+\z"))
_normalizer(
    "norm_sequence",
    lambda c: N.normalize(decomposed(c), [("strip_accents", {}), ("lowercase", {}), ("strip", {})]),
    sub(f"lower({sub(DECOMPOSED, chr(92) + 'p{M}')})", rf"^[{BLANK}]+|[{BLANK}]+\z"),
)


def _pretokenizer(name, apply, sql=None):
    def run(spark, sf):
        listed_tokens = texts(spark, sf, "documents").select("doc_id", apply(F.col("text")).alias("ts"))
        return listed_tokens.select("doc_id", listed(F.col("ts")).alias("tokens"), F.size("ts").cast("bigint").alias("n_tokens"))

    query(name, sql and f"SELECT doc_id, {join('ts')} AS tokens, len(ts)::BIGINT AS n_tokens FROM (SELECT doc_id, {sql} AS ts FROM documents)")(run)


def found(pattern: str, x: str = "text") -> str:
    return f"regexp_extract_all({x}, '{pattern}')"


def filled(xs: str) -> str:
    return keep(xs, "w <> ''")


_pretokenizer("pretok_whitespace", P.pretok_whitespace, found(WHITESPACE))
_pretokenizer("pretok_whitespace_split", P.pretok_whitespace_split, found(f"[^{BLANK}]+"))
_pretokenizer("pretok_bert", P.pretok_bert, found(f"[{SIGN}]|[^{SIGN}{BLANK}]+"))
_pretokenizer("pretok_byte_level", P.pretok_byte_level, BYTE_LEVEL)
_pretokenizer("pretok_char_delimiter", lambda c: P.pretok_char_delimiter(c, "e"), filled("string_split(text, 'e')"))
_pretokenizer("pretok_digits", P.pretok_digits, found(r"\p{N}+|\P{N}+"))
_pretokenizer("pretok_digits_individual", lambda c: P.pretok_digits(c, True), found(r"\p{N}|\P{N}+"))
_MARKED = "replace(text, ' ', '_')"
_pretokenizer(
    "pretok_metaspace", P.pretok_metaspace,
    found("_[^_]*|[^_]+", f"CASE WHEN text = '' OR starts_with({_MARKED}, '_') THEN {_MARKED} ELSE '_' || {_MARKED} END"),
)
PUNCTUATION = {
    "removed": f"[^{SIGN}]+", "isolated": f"[{SIGN}]|[^{SIGN}]+", "merged_with_previous": f"[^{SIGN}]*[{SIGN}]|[^{SIGN}]+",
    "merged_with_next": f"[{SIGN}][^{SIGN}]*|[^{SIGN}]+", "contiguous": f"[{SIGN}]+|[^{SIGN}]+",
}
for _behavior, _pattern in PUNCTUATION.items():
    _pretokenizer(
        "pretok_punctuation" + ("" if _behavior == "isolated" else f"_{_behavior}"),
        lambda c, b=_behavior: P.pretok_punctuation(c, b), found(_pattern),
    )
_pretokenizer(
    "pretok_sequence", lambda c: P.pretokenize(c, [("whitespace_split", {}), ("punctuation", {})]),
    f"flatten({each(found(f'[^{BLANK}]+'), found(PUNCTUATION['isolated'], 'w'))})",
)
_SPLITS = {
    "removed": filled("string_split(text, 'en')"),
    "isolated": filled(r"string_split(replace(text, 'en', '\x01en\x01'), '\x01')".replace(r"\x01", "\x01")),
    "merged_with_previous": filled("string_split(replace(text, 'en', 'en\x01'), '\x01')"),
    "merged_with_next": filled("string_split(replace(text, 'en', '\x01en'), '\x01')"),
    "contiguous": filled("string_split(regexp_replace(text, '((?:en)+)', '\x01\\1\x01', 'g'), '\x01')"),
}
for _behavior, _sql in _SPLITS.items():
    _pretokenizer(
        "pretok_split" + ("" if _behavior == "removed" else f"_{_behavior}"), lambda c, b=_behavior: P.pretok_split(c, "en", b), _sql
    )
_pretokenizer("pretok_split_inverted", lambda c: P.pretok_split(c, "en", "removed", True), found("en"))
# The texts hold Latin letters and signs that all scripts share.
_pretokenizer("pretok_unicode_scripts", P.pretok_unicode_scripts, found(r"\p{Latin}[\p{Latin} ]*|[^\p{Latin} ][^\p{Latin}]*"))


# Detokenisers, over tokens cut from the texts.

def _decoder(name, tokens, apply, sql=None):
    def run(spark, sf):
        cut = texts(spark, sf, "documents").select("doc_id", tokens(F.col("text")).alias("ts"))
        return cut.select("doc_id", apply(F.col("ts")).alias("decoded"))

    query(name, sql and f"SELECT doc_id, {sql[1]} AS decoded FROM (SELECT doc_id, {sql[0]} AS ts FROM documents)")(run)


def by_blank(c):
    return F.split(c, " ")


BY_BLANK = "string_split(text, ' ')"
_last = "ts[len(ts)]"
_decoder(
    "decode_bpe", by_blank, lambda ts: D.decode_bpe(ts, "e"),
    (BY_BLANK, f"{join(each('ts[1:len(ts) - 1]', chr(32).join(['replace(w,', chr(39) + 'e' + chr(39) + ',', chr(39) + ' ' + chr(39) + ')'])), '')} || replace({_last}, 'e', '')"),
)
_decoder("decode_byte_level", lambda c: P.pretok_byte_level(c, add_prefix_space=False), D.decode_byte_level, ("text", "ts"))
_decoder(
    "decode_ctc", lambda c: F.split(F.replace(c, F.lit(" "), F.lit("|")), ""),
    lambda ts: D.decode_ctc(ts, "x"),
    (
        "string_split(replace(text, ' ', '|'), '')",
        join(each("list_filter(ts, lambda w, i: i = 1 OR w <> ts[i - 1])", "replace(replace(w, 'x', ''), '|', ' ')"), ""),
    ),
)
_decoder(
    "decode_metaspace", lambda c: P.pretok_metaspace(c), D.decode_metaspace,
    (found("_[^_]*|[^_]+", f"CASE WHEN text = '' OR starts_with({_MARKED}, '_') THEN {_MARKED} ELSE '_' || {_MARKED} END"),
     f"concat(replace(ts[1], '_', ''), {join(each('ts[2:]', 'replace(w, ' + chr(39) + '_' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')'), '')})"),
)
# Blanks that go before signs and short forms.
CLEANED = [(" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"), (" n't", "n't"), (" 'm", "'m"), (" do not", " don't"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re")]
_CLEAN = "w"
for _from, _to in CLEANED:
    _CLEAN = "replace({}, '{}', '{}')".format(_CLEAN, _from.replace("'", "''"), _to.replace("'", "''"))
_decoder(
    "decode_wordpiece", lambda c: P.pretok_bert(c), lambda ts: D.decode_wordpiece(ts, "th"),
    (
        found(f"[{SIGN}]|[^{SIGN}{BLANK}]+"),
        join(
            each("list_transform(ts, lambda w, i: CASE WHEN i = 1 THEN w WHEN starts_with(w, 'th') THEN substr(w, 3) ELSE ' ' || w END)", _CLEAN),
            "",
        ),
    ),
)
