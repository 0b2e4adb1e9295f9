"""Treebank word tokenisation as a cascade of built-in expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.charclasses import BLANKS, UWORD, WS

_S = f"[{WS}]"
_W = f"[{UWORD}]"

# The published Treebank rules as (pattern, replacement), in order of application. Rules that
# put the same blanks around different characters are one pattern.
OPENING = [
    ("([«“‘„]|[`]+)", " $1 "),
    ('^"', "``"),
    ("(``)", " $1 "),
    ("([ (\\[{<])(\"|'{2})", "$1 `` "),
]
OPENING_APOSTROPHE = [(f"(?i)(')(?!re|ve|ll|m|t|s|d|n)({_W})(?!{_W})", "$1 $2")]
PUNCTUATION = [
    (f"([^.])(\\.)([\\])}}>\"'»”’ ]*){_S}*$", "$1 $2 $3 "),
    ("([:,])([^\\p{Nd}])", " $1 $2"),
    ("([:,])$", " $1 "),
    ("(\\.{2,})", " $1 "),
    ("([;@#$%&?!*])", " $1 "),
    (f"([^.])(\\.)([\\])}}>\"']*){_S}*$", "$1 $2$3 "),
]
APOSTROPHE_BLANK = [("([^'])' ", "$1 ' ")]
BRACKETS = [("([\\]\\[(){}<>])", " $1 "), ("--", " -- ")]
CLOSING = [("([»”’])", " $1 "), ("''|\"", " '' ")]
CLOSING_APOSTROPHE = [
    (f"{_S}+", " "),
    ("([^' ])('[sS]|'[mM]|'[dD]|') ", "$1 $2 "),
    ("([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
    ("(?i) ('t)(is|was)\\b", " $1 $2 "),
]
CONTRACTIONS = [
    (
        f"(?i)\\b(?:(?:(can)(not)|(d)('ye)|(gim)(me)|(gon)(na)|(got)(ta)|(lem)(me)|(more)('n))\\b|(wan)(na)(?={_S}))",
        " $1$3$5$7$9$11$13$15 $2$4$6$8$10$12$14$16 ",
    )
]
# A sentence ends at a period, question or exclamation mark before blanks and a capital letter.
SENTENCE_BREAK = f"(?<=[.?!]){_S}+(?=\\p{{Lu}})"


def _rules(rules: list[tuple[str, str]], needs: str = "") -> Callable[[Column], Column]:
    """The rules in order; texts with none of the characters they need are passed by."""

    def apply(sentence: Column) -> Column:
        out = reduce(lambda c, rule: F.regexp_replace(c, *rule), rules, sentence)
        if not needs:
            return out
        return F.when(reduce(or_, [sentence.contains(c) for c in needs]), out).otherwise(sentence)

    return apply


STAGES = [
    _rules(OPENING, "\"'`«“‘„"),
    _rules(OPENING_APOSTROPHE, "'"),
    _rules(PUNCTUATION),
    _rules(APOSTROPHE_BLANK, "'"),
    _rules(BRACKETS),
    lambda sentence: F.concat(F.lit(" "), sentence, F.lit(" ")),
    _rules(CLOSING, "\"'»”’"),
    _rules(CLOSING_APOSTROPHE, "'"),
    _rules(CONTRACTIONS),
]


def split_blanks(text: Column) -> Column:
    """The runs of other characters than white space; a cut at single blanks is several times as fast as a pattern for the runs."""
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def treebank_tokens(text: Column) -> Column:
    """Word tokens of `text`, sentence by sentence."""
    spaced = reduce(F.transform, STAGES, F.split(text, SENTENCE_BREAK))
    return split_blanks(F.array_join(spaced, " "))
