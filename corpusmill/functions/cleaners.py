"""Text cleaners.

Each cleaner has two forms, both Column -> Column: one for a text (string) and one for a list of
words (array<string>). The text forms are built from expressions that take part in whole-stage code
generation; only word lists and the stop-word tokeniser need higher-order functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.charclasses import ASCII_PUNCTUATION, BLANKS, WORD, WS
from corpusmill.functions.treebank import split_blanks, treebank_tokens

ColumnFn = Callable[[Column], Column]

# English stop words.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him
his himself she she's her hers herself it it's its itself they them their theirs themselves what which who
whom this that that'll these those am is are was were be been being have has had having do does did doing a
an the and but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here there when
where why how all any both each few more most other some such no nor not only own same so than too very s t
can will just don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# The look-ahead lets most places fail on one character.
URL = f"(?=[hw])(?:http|www)[^{WS}]+"
MENTION = f"@[{WORD}]+"
RETWEET = f"[rR](?<![{WORD}][rR])[tT](?![{WORD}])"
# In text with single blanks, a whole word holding a character outside the wanted class, and its blank. The
# leftmost match of such a word starts where the word does.
NOT_ALPHA_WORD = r"\p{L}*+[^\p{L} ][^ ]* ?"
NOT_ASCII_WORD = r"[^ \x{80}-\x{10FFFF}]*+[^\x00-\x7F][^ ]* ?"

# What is known of the blanks of a text: nothing; only spaces; single spaces and none at the ends.
RAW, SPACED, TIDY = range(3)


def normalize_blanks(text: Column, state: int = RAW) -> Column:
    """Single blanks between words and none at the ends; `state` saves the work already done."""
    if state == RAW:
        text = F.translate(text, BLANKS, " " * len(BLANKS))
    return text if state == TIDY else F.trim(F.regexp_replace(text, " {2,}", " "))


def words_of(text: Column) -> Column:
    """The blank-separated words of `text`."""
    return split_blanks(text)


def _through_text(text_form: ColumnFn) -> ColumnFn:
    return lambda words: words_of(text_form(F.array_join(words, " ")))


def _each(text_form: ColumnFn) -> ColumnFn:
    return lambda words: F.transform(words, text_form)


@dataclass(frozen=True)
class Cleaner:
    """The two forms of a cleaner.

    `text` takes the column and, if `blanks` is set, what is known of its blanks; `blanks` tells what is
    known after it, given what was known before.
    """

    text: Callable[..., Column]
    words: ColumnFn
    blanks: Callable[[int], int] | None = None

    def apply(self, text: Column, state: int = RAW) -> tuple[Column, int]:
        if self.blanks is None:
            return self.text(text), RAW
        return self.text(text, state), self.blanks(state)


def stopwords(stop_words: Iterable[str] = tuple(ENGLISH_STOPWORDS)) -> Cleaner:
    unwanted = [w.lower() for w in stop_words]

    def words(tokens: Column) -> Column:
        return F.filter(tokens, lambda w: ~F.lower(w).isin(unwanted))

    # Tokens hold no blanks.
    return Cleaner(lambda text, state=RAW: F.array_join(words(treebank_tokens(text)), " "), words, lambda state: TIDY)


def lowercase() -> Cleaner:
    return Cleaner(lambda text, state=RAW: F.lower(text), _each(F.lower), lambda state: state)


def _no_longer_single(state: int) -> int:
    return min(state, SPACED)


def strip_urls() -> Cleaner:
    def text(c: Column, state: int = RAW) -> Column:
        return F.regexp_replace(c, URL, "")

    return Cleaner(text, _each(lambda c: text(c)), _no_longer_single)


def strip_punctuation(punctuation: str = ASCII_PUNCTUATION) -> Cleaner:
    # Words never hold blanks, so a blank among the characters has nothing to delete.
    unwanted = "".join(c for c in dict.fromkeys(punctuation) if not c.isspace())

    def delete(c: Column) -> Column:
        return F.translate(c, unwanted, "")

    return Cleaner(lambda text, state=RAW: delete(normalize_blanks(text, state)), _each(delete), lambda state: SPACED)


def keep_alpha_words() -> Cleaner:
    return Cleaner(
        lambda text, state=RAW: F.rtrim(F.regexp_replace(normalize_blanks(text, state), NOT_ALPHA_WORD, "")),
        lambda words: F.filter(words, lambda w: w.rlike(r"^\p{L}+\z")),
        lambda state: TIDY,
    )


def newline_to_space() -> Cleaner:
    def text(c: Column, state: int = RAW) -> Column:
        return F.replace(c, F.lit("\n"), F.lit(" ")) if state == RAW else c

    return Cleaner(text, _each(lambda c: text(c)), lambda state: state)


def keep_ascii_words() -> Cleaner:
    return Cleaner(
        lambda text, state=RAW: F.rtrim(F.regexp_replace(normalize_blanks(text, state), NOT_ASCII_WORD, "")),
        lambda words: F.filter(words, lambda w: w.rlike(r"^[\x00-\x7F]*\z")),
        lambda state: TIDY,
    )


def strip_mentions() -> Cleaner:
    def text(c: Column, state: int = RAW) -> Column:
        return F.regexp_replace(c, MENTION, "")

    return Cleaner(text, _through_text(text), _no_longer_single)


def strip_retweet() -> Cleaner:
    def text(c: Column, state: int = RAW) -> Column:
        return F.regexp_replace(c, RETWEET, "")

    return Cleaner(text, _through_text(text), _no_longer_single)


def limit_chars(limit: int = 300) -> Cleaner:
    def text(c: Column) -> Column:
        return F.substring(c, 1, limit)

    return Cleaner(text, _through_text(text))


_registry: dict[str, Callable[..., Cleaner]] = {
    "stopwords": stopwords,
    "lowercase": lowercase,
    "strip_urls": strip_urls,
    "strip_punctuation": strip_punctuation,
    "keep_alpha_words": keep_alpha_words,
    "newline_to_space": newline_to_space,
    "keep_ascii_words": keep_ascii_words,
    "strip_mentions": strip_mentions,
    "strip_retweet": strip_retweet,
    "limit_chars": limit_chars,
}

# The configured order. It ends with spelling, which needs frequency files: build_corpus and run_spec take it as a
# step ("spell_correct", {"dictionary": ..., "bigrams": ...}) after these.
DEFAULT_CHAIN: list[tuple[str, dict[str, Any]]] = [
    ("stopwords", {}),
    ("lowercase", {}),
    ("strip_urls", {}),
    ("strip_punctuation", {}),
    ("keep_alpha_words", {}),
    ("newline_to_space", {}),
    ("keep_ascii_words", {}),
    ("strip_mentions", {}),
    ("strip_retweet", {}),
]

Spec = Sequence["str | tuple[str, dict[str, Any]]"]


def register_cleaner(name: str, text_fn: ColumnFn, words_fn: ColumnFn | None = None) -> None:
    """Add a cleaner made of user expressions; without a word form, each word is cleaned as a text."""
    made = Cleaner(text_fn, words_fn or _each(text_fn))
    _registry[name] = lambda: made


def cleaner(name: str, **params: Any) -> Cleaner:
    if name not in _registry:
        raise ValueError(f"unknown cleaner {name!r}; known: {sorted(_registry)}")
    return _registry[name](**params)


def resolve(spec: Spec) -> list[Cleaner]:
    steps = [(s, {}) if isinstance(s, str) else s for s in spec]
    return [cleaner(name, **params) for name, params in steps]


def clean_text(text: Column, spec: Spec = tuple(DEFAULT_CHAIN)) -> Column:
    """Apply the cleaners of `spec` in order, in text form."""
    state = RAW
    for step in resolve(spec):
        text, state = step.apply(text, state)
    return text


def clean_words(words: Column, spec: Spec) -> Column:
    """Apply the cleaners of `spec` in order, in word-list form."""
    return reduce(lambda c, step: step.words(c), resolve(spec), words)


def clean_column(df: DataFrame, column: str, spec: Spec) -> Column:
    """Text form for a string column, word-list form for an array of strings."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return clean_text(F.col(column), spec)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return clean_words(F.col(column), spec)
    raise TypeError(f"{column} must be a string or an array of strings, not {kind.simpleString()}")
