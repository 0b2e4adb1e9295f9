"""Pre-tokenisers: string -> array<string>."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.charclasses import PUNCT, UWORD, UWS, literal

# The five treatments of a delimiter.
BEHAVIORS = ["removed", "isolated", "merged_with_previous", "merged_with_next", "contiguous"]

# Script names. Hiragana and Katakana count as Han.
SCRIPTS = """
COMMON LATIN GREEK CYRILLIC ARMENIAN HEBREW ARABIC SYRIAC THAANA DEVANAGARI BENGALI GURMUKHI GUJARATI ORIYA
TAMIL TELUGU KANNADA MALAYALAM SINHALA THAI LAO TIBETAN MYANMAR GEORGIAN HANGUL ETHIOPIC CHEROKEE
CANADIAN_ABORIGINAL OGHAM RUNIC KHMER MONGOLIAN BOPOMOFO YI OLD_ITALIC GOTHIC DESERET INHERITED TAGALOG
HANUNOO BUHID TAGBANWA LIMBU TAI_LE LINEAR_B UGARITIC SHAVIAN OSMANYA CYPRIOT BRAILLE BUGINESE COPTIC
NEW_TAI_LUE GLAGOLITIC TIFINAGH SYLOTI_NAGRI OLD_PERSIAN KHAROSHTHI BALINESE CUNEIFORM PHOENICIAN PHAGS_PA
NKO SUNDANESE BATAK LEPCHA OL_CHIKI VAI SAURASHTRA KAYAH_LI REJANG LYCIAN CARIAN LYDIAN CHAM TAI_THAM
TAI_VIET AVESTAN EGYPTIAN_HIEROGLYPHS SAMARITAN MANDAIC LISU BAMUM JAVANESE MEETEI_MAYEK IMPERIAL_ARAMAIC
OLD_SOUTH_ARABIAN INSCRIPTIONAL_PARTHIAN INSCRIPTIONAL_PAHLAVI OLD_TURKIC BRAHMI KAITHI MEROITIC_HIEROGLYPHS
MEROITIC_CURSIVE SORA_SOMPENG CHAKMA SHARADA TAKRI MIAO CAUCASIAN_ALBANIAN BASSA_VAH DUPLOYAN ELBASAN
GRANTHA PAHAWH_HMONG KHOJKI LINEAR_A MAHAJANI MANICHAEAN MENDE_KIKAKUI MODI MRO OLD_NORTH_ARABIAN NABATAEAN
PALMYRENE PAU_CIN_HAU OLD_PERMIC PSALTER_PAHLAVI SIDDHAM KHUDAWADI TIRHUTA WARANG_CITI AHOM
ANATOLIAN_HIEROGLYPHS HATRAN MULTANI OLD_HUNGARIAN SIGNWRITING ADLAM BHAIKSUKI MARCHEN NEWA OSAGE TANGUT
MASARAM_GONDI NUSHU SOYOMBO ZANABAZAR_SQUARE HANIFI_ROHINGYA OLD_SOGDIAN SOGDIAN DOGRA GUNJALA_GONDI MAKASAR
MEDEFAIDRIN ELYMAIC NANDINAGARI NYIAKENG_PUACHUE_HMONG WANCHO YEZIDI CHORASMIAN DIVES_AKURU
KHITAN_SMALL_SCRIPT
""".split()

WHITESPACE_PATTERN = f"[{UWORD}]+|[^{UWORD}{UWS}]+"
BERT_PATTERN = f"[{PUNCT}]|[^{PUNCT}{UWS}]+"
PUNCTUATION_PATTERNS = {
    "removed": f"[^{PUNCT}]+",
    "isolated": f"[{PUNCT}]|[^{PUNCT}]+",
    "merged_with_previous": f"[^{PUNCT}]*[{PUNCT}]|[^{PUNCT}]+",
    "merged_with_next": f"[{PUNCT}][^{PUNCT}]*|[^{PUNCT}]+",
    "contiguous": f"[{PUNCT}]+|[^{PUNCT}]+",
}
# The published byte-level word pattern.
BYTE_LEVEL_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{UWS}\p{{L}}\p{{N}}]+|[{UWS}]+(?![^{UWS}])|[{UWS}]+"
)


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def check_behavior(behavior: str) -> None:
    if behavior not in BEHAVIORS:
        raise ValueError(f"behavior must be one of {BEHAVIORS}, got {behavior!r}")


def pretok_whitespace(text: Column) -> Column:
    """Runs of word characters and runs of other visible characters."""
    return matches(text, WHITESPACE_PATTERN)


def pretok_whitespace_split(text: Column) -> Column:
    return matches(text, f"[^{UWS}]+")


def pretok_bert(text: Column) -> Column:
    """Blanks dropped, each punctuation character on its own."""
    return matches(text, BERT_PATTERN)


def byte_alphabet() -> str:
    """The printable character that stands for each byte, at the byte's position.

    Printable Latin-1 bytes stand for themselves, the others take the characters from U+0100 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in printable else chr(next(spare)) for b in range(256))


LATIN1 = "".join(map(chr, range(256)))


def to_byte_chars(text: Column) -> Column:
    """One printable character per UTF-8 byte."""
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, LATIN1, byte_alphabet())


def pretok_byte_level(text: Column, add_prefix_space: bool = True) -> Column:
    if add_prefix_space:
        text = F.when((text != "") & ~text.startswith(" "), F.concat(F.lit(" "), text)).otherwise(text)
    return F.transform(matches(text, BYTE_LEVEL_PATTERN), to_byte_chars)


def _non_empty(pieces: Column) -> Column:
    return F.filter(pieces, lambda p: p != "")


def pretok_char_delimiter(text: Column, delimiter: str) -> Column:
    if len(delimiter) != 1:
        raise ValueError("delimiter must be one character")
    return _non_empty(F.split(text, literal(delimiter), -1))


def pretok_digits(text: Column, individual_digits: bool = False) -> Column:
    return matches(text, r"\p{N}|\P{N}+" if individual_digits else r"\p{N}+|\P{N}+")


def pretok_metaspace(text: Column, replacement: str = "_", add_prefix_space: bool = True) -> Column:
    if len(replacement) != 1:
        raise ValueError(f"replacement must be one character, got {len(replacement)}")
    marked = F.replace(text, F.lit(" "), F.lit(replacement))
    if add_prefix_space:
        bare = (marked != "") & ~marked.startswith(replacement)
        marked = F.when(bare, F.concat(F.lit(replacement), marked)).otherwise(marked)
    r = literal(replacement)
    return matches(marked, f"{r}[^{r}]*|[^{r}]+")


def pretok_punctuation(text: Column, behavior: str = "isolated") -> Column:
    check_behavior(behavior)
    return matches(text, PUNCTUATION_PATTERNS[behavior])


def pretok_split(text: Column, pattern: str, behavior: str, invert: bool = False) -> Column:
    """Split at the literal `pattern`; with `invert` the text between the matches is the delimiter."""
    check_behavior(behavior)
    if pattern == "":
        return F.filter(F.array(text), lambda p: p != "")
    p = literal(pattern)
    if behavior == "contiguous":
        between, runs = F.split(text, f"(?:{p})+", -1), matches(text, f"(?:{p})+")
        both = F.zip_with(between, runs, lambda x, run: F.array(x, F.coalesce(run, F.lit(""))))
        return _non_empty(F.flatten(both))
    if behavior == "removed" and invert:
        return matches(text, p)
    if invert:
        behavior = {"merged_with_previous": "merged_with_next", "merged_with_next": "merged_with_previous"}.get(
            behavior, behavior
        )
    between = F.split(text, p, -1)
    match = F.lit(pattern)
    # Every piece but the last is followed by a match.
    followed, final = F.slice(between, 1, F.size(between) - 1), F.slice(between, -1, 1)
    if behavior == "isolated":
        between = F.concat(F.flatten(F.transform(followed, lambda x: F.array(x, match))), final)
    elif behavior == "merged_with_previous":
        between = F.concat(F.transform(followed, lambda x: F.concat(x, match)), final)
    elif behavior == "merged_with_next":
        between = F.transform(between, lambda x, i: F.when(i > 0, F.concat(match, x)).otherwise(x))
    return _non_empty(between)


def pretok_unicode_scripts(text: Column) -> Column:
    """Runs of one script; a blank stays with the script before it."""
    anything = r" \p{IsUNKNOWN}"
    han = r"\p{IsHAN}\p{IsHIRAGANA}\p{IsKATAKANA}\x{30FC}"
    runs = [rf"[\p{{Is{s}}}&&[^ \x{{30FC}}]][\p{{Is{s}}}{anything}&&[^\x{{30FC}}]]*" for s in SCRIPTS]
    return matches(text, "|".join([*runs[:2], f"[{han}][{han}{anything}]*", *runs[2:]]))


def pretok_sequence(text: Column, steps: Sequence[Callable[[Column], Column]]) -> Column:
    """Each step splits the pieces of the one before it."""
    pieces = F.array(text)
    for number, step in enumerate(steps):
        pieces = step(text) if number == 0 else F.flatten(F.transform(pieces, step))
    return pieces


PRETOKENIZERS: dict[str, Callable[..., Column]] = {
    "whitespace": pretok_whitespace,
    "whitespace_split": pretok_whitespace_split,
    "bert": pretok_bert,
    "byte_level": pretok_byte_level,
    "char_delimiter": pretok_char_delimiter,
    "digits": pretok_digits,
    "metaspace": pretok_metaspace,
    "punctuation": pretok_punctuation,
    "split": pretok_split,
    "unicode_scripts": pretok_unicode_scripts,
}


def pretokenize(text: Column, spec: Sequence[tuple[str, dict]]) -> Column:
    """Apply named pre-tokenisers in order."""

    def bound(name: str, params: dict) -> Callable[[Column], Column]:
        return lambda c: PRETOKENIZERS[name](c, **params)

    return pretok_sequence(text, [bound(name, params) for name, params in spec])
