"""Unicode and white-space normalisers: string -> string."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusmill.functions.charclasses import UWS

# Code points that the NMT clean-up deletes, and those it turns into a blank.
NMT_DELETED = r"[\x01-\x08\x0B\x0E-\x1F\x7F\x{8F}\x{9F}]"
NMT_BLANK = r"[\x09\x0A\x0C\x0D\x{1680}\x{200B}-\x{200F}\x{2028}\x{2029}\x{2581}\x{FEFF}\x{FFFD}]"
# Blocks of Chinese characters.
CHINESE = (
    r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}"
    r"\x{2B920}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}]"
)

TEXTS_AT_ONCE = 128


def _unicode_form(form: str) -> Callable[[Column], Column]:
    # A type by its name would be read by a session, and this module is imported before there is one.
    @F.arrow_udf(StringType())
    def convert(texts: pa.Array) -> pa.Array:
        # A batch is bounded by its rows, not by its characters, so only some of its texts are Python strings at once.
        parts = [pa.array([], pa.string())]
        for low in range(0, len(texts), TEXTS_AT_ONCE):
            part = texts.slice(low, TEXTS_AT_ONCE).to_pylist()
            parts.append(pa.array([None if t is None else unicodedata.normalize(form, t) for t in part], pa.string()))
        return pa.concat_arrays(parts)

    def apply(text: Column) -> Column:
        # ASCII is its own normal form: such texts reach Python as nulls only.
        return F.coalesce(convert(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)

    return apply


norm_nfc = _unicode_form("NFC")
norm_nfd = _unicode_form("NFD")
norm_nfkc = _unicode_form("NFKC")
norm_nfkd = _unicode_form("NFKD")


def norm_lowercase(text: Column) -> Column:
    """Lower case character by character: a final sigma is no special case."""
    return F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))


def norm_nmt(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, NMT_DELETED, ""), NMT_BLANK, " ")


def norm_replace(text: Column, pattern: str, content: str) -> Column:
    """Replace every occurrence of the literal `pattern`."""
    return F.replace(text, F.lit(pattern), F.lit(content))


def norm_strip_accents(text: Column) -> Column:
    """Delete combining marks; composed letters keep theirs unless NFD ran first."""
    return F.regexp_replace(text, r"\p{M}", "")


def norm_strip(text: Column, left: bool = True, right: bool = True) -> Column:
    ends = [e for e, wanted in ((f"^[{UWS}]+", left), (rf"(?<![{UWS}])[{UWS}]+\z", right)) if wanted]
    return F.regexp_replace(text, "|".join(ends), "") if ends else text


def norm_bert(
    text: Column, clean_text: bool = True, handle_chinese_chars: bool = True,
    strip_accents: bool = True, lowercase: bool = True,
) -> Column:
    out = text
    if clean_text:
        out = F.regexp_replace(out, r"[\x{FFFD}\p{C}&&[^\t\n\r]]", "")
        out = F.regexp_replace(out, f"[{UWS}]", " ")
    if handle_chinese_chars:
        out = F.regexp_replace(out, f"({CHINESE})", " $1 ")
    if strip_accents:
        out = F.regexp_replace(norm_nfd(out), r"\p{Mn}", "")
    if lowercase:
        out = norm_lowercase(out)
    return out


def norm_sequence(text: Column, steps: Sequence[Callable[[Column], Column]]) -> Column:
    return reduce(lambda c, step: step(c), steps, text)


NORMALIZERS: dict[str, Callable[..., Column]] = {
    "bert": norm_bert,
    "lowercase": norm_lowercase,
    "nfc": norm_nfc,
    "nfd": norm_nfd,
    "nfkc": norm_nfkc,
    "nfkd": norm_nfkd,
    "nmt": norm_nmt,
    "replace": norm_replace,
    "strip": norm_strip,
    "strip_accents": norm_strip_accents,
}


def normalize(text: Column, spec: Sequence[tuple[str, dict]]) -> Column:
    """Apply named normalisers in order."""
    return reduce(lambda c, step: NORMALIZERS[step[0]](c, **step[1]), spec, text)


