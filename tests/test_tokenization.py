import re

import pytest
from conftest import column_values, same
from pyspark.sql import functions as F

from corpusmill.functions import decoders as D
from corpusmill.functions import normalizers as N
from corpusmill.functions import pretokenizers as P

lib = pytest.importorskip("tokenizers")
from tokenizers import decoders, normalizers, pre_tokenizers  # noqa: E402

T = F.col("t")


def pieces(pre):
    return lambda t: [p for p, _ in pre.pre_tokenize_str(t)]


NORMALIZERS = {
    "nfc": (N.norm_nfc(T), normalizers.NFC()),
    "nfd": (N.norm_nfd(T), normalizers.NFD()),
    "nfkc": (N.norm_nfkc(T), normalizers.NFKC()),
    "nfkd": (N.norm_nfkd(T), normalizers.NFKD()),
    "lowercase": (N.norm_lowercase(T), normalizers.Lowercase()),
    "nmt": (N.norm_nmt(T), normalizers.Nmt()),
    "replace": (N.norm_replace(T, "a.b", "$1"), normalizers.Replace("a.b", "$1")),
    "strip": (N.norm_strip(T), normalizers.Strip()),
    "strip_left": (N.norm_strip(T, right=False), normalizers.Strip(right=False)),
    "strip_right": (N.norm_strip(T, left=False), normalizers.Strip(left=False)),
    "strip_accents": (N.norm_strip_accents(T), normalizers.StripAccents()),
    "bert": (N.norm_bert(T), normalizers.BertNormalizer()),
    "bert_plain": (
        N.norm_bert(T, clean_text=False, handle_chinese_chars=False, strip_accents=False, lowercase=False),
        normalizers.BertNormalizer(False, False, False, False),
    ),
    "bert_cased": (
        N.norm_bert(T, strip_accents=False, lowercase=False),
        normalizers.BertNormalizer(strip_accents=False, lowercase=False),
    ),
    "sequence": (
        N.normalize(T, [("nfd", {}), ("strip_accents", {}), ("lowercase", {})]),
        normalizers.Sequence([normalizers.NFD(), normalizers.StripAccents(), normalizers.Lowercase()]),
    ),
}


@pytest.mark.parametrize("name", NORMALIZERS)
def test_normalizer(string_frame, strings, name):
    column, norm = NORMALIZERS[name]
    same(column_values(string_frame, column), map(norm.normalize_str, strings), strings)


PRETOKENIZERS = {
    "whitespace": (P.pretok_whitespace(T), pre_tokenizers.Whitespace()),
    "whitespace_split": (P.pretok_whitespace_split(T), pre_tokenizers.WhitespaceSplit()),
    "bert": (P.pretok_bert(T), pre_tokenizers.BertPreTokenizer()),
    "byte_level": (P.pretok_byte_level(T), pre_tokenizers.ByteLevel()),
    "byte_level_bare": (P.pretok_byte_level(T, False), pre_tokenizers.ByteLevel(add_prefix_space=False)),
    "char_delimiter": (P.pretok_char_delimiter(T, "a"), pre_tokenizers.CharDelimiterSplit("a")),
    "char_delimiter_dot": (P.pretok_char_delimiter(T, "."), pre_tokenizers.CharDelimiterSplit(".")),
    "digits": (P.pretok_digits(T), pre_tokenizers.Digits()),
    "digits_individual": (P.pretok_digits(T, True), pre_tokenizers.Digits(individual_digits=True)),
    "metaspace": (P.pretok_metaspace(T), pre_tokenizers.Metaspace("_")),
    "metaspace_bare": (
        P.pretok_metaspace(T, add_prefix_space=False), pre_tokenizers.Metaspace("_", prepend_scheme="never")),
    "unicode_scripts": (P.pretok_unicode_scripts(T), pre_tokenizers.UnicodeScripts()),
    "sequence": (
        P.pretokenize(T, [("whitespace", {}), ("digits", {"individual_digits": True})]),
        pre_tokenizers.Sequence([pre_tokenizers.Whitespace(), pre_tokenizers.Digits(individual_digits=True)]),
    ),
    **{
        f"punctuation_{b}": (P.pretok_punctuation(T, b), pre_tokenizers.Punctuation(b)) for b in P.BEHAVIORS
    },
    **{
        f"split_{pattern}_{b}_{inv}": (P.pretok_split(T, pattern, b, inv), pre_tokenizers.Split(pattern, b, inv))
        for pattern in ("a", "--", " ")
        for b in P.BEHAVIORS
        for inv in (False, True)
    },
}


@pytest.mark.parametrize("name", PRETOKENIZERS)
def test_pretokenizer(string_frame, strings, name):
    column, pre = PRETOKENIZERS[name]
    same(column_values(string_frame, column), map(pieces(pre), strings), strings)


def test_options_are_checked():
    with pytest.raises(ValueError):
        P.pretok_punctuation(T, "glued")
    with pytest.raises(ValueError):
        P.pretok_split(T, "a", "glued")
    with pytest.raises(ValueError):
        P.pretok_metaspace(T, "__")
    with pytest.raises(ValueError):
        D.decode_metaspace(T, "__")


TOKENS = F.split("t", " ")
DECODERS = {
    "bpe": (D.decode_bpe(TOKENS, "e"), decoders.BPEDecoder(suffix="e")),
    "byte_level": (D.decode_byte_level(TOKENS), decoders.ByteLevel()),
    "ctc": (D.decode_ctc(TOKENS, "@bob", "--"), decoders.CTC("@bob", "--", True)),
    "ctc_plain": (D.decode_ctc(TOKENS, "@bob", "--", False), decoders.CTC("@bob", "--", False)),
    "metaspace": (D.decode_metaspace(TOKENS), decoders.Metaspace("_")),
    "metaspace_bare": (D.decode_metaspace(TOKENS, "_", False), decoders.Metaspace("_", prepend_scheme="never")),
    "wordpiece": (D.decode_wordpiece(TOKENS, "t"), decoders.WordPiece("t", True)),
    "wordpiece_plain": (D.decode_wordpiece(TOKENS, "t", False), decoders.WordPiece("t", False)),
}


@pytest.mark.parametrize("name", DECODERS)
def test_decoder(string_frame, strings, name):
    column, decoder = DECODERS[name]
    wanted = [decoder.decode(t.split(" ")) for t in strings]
    same(column_values(string_frame, column), wanted, strings)


def test_byte_level_round_trip(string_frame, strings):
    column = D.decode_byte_level(P.pretok_byte_level(T, add_prefix_space=False))
    same(column_values(string_frame, column), strings, strings)


def test_wordpiece_cleanup(spark):
    df = spark.createDataFrame([(["Hi", "there", "!", "do", "n't", "go", ",", "##ne"],)], "t array<string>")
    assert df.select(D.decode_wordpiece(T)).first()[0] == decoders.WordPiece().decode(
        ["Hi", "there", "!", "do", "n't", "go", ",", "##ne"]
    )
    assert re.search("n't", df.select(D.decode_wordpiece(T)).first()[0])
