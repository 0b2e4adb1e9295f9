"""Toxicity classifier whose scores do not depend on which group a text mentions.

Training compares counterfactual forms of the labelled texts. A text with identity terms is set beside copies in which
they are swapped: for another term of the same language, and for a neutral word. A text without any is set in two
forms that mention somebody at a seeded place, one by a group's term and one by the neutral word. The loss
penalises the squared change of the raw score between the forms of a pair, so that an identity term can gain weight only
as far as its counterparts do, and neutral mentions are not scored up. Each labelled text makes one or two pairs, so
the sample bounds them too.

Texts of any length are read whole, in training and in scoring; the swap is made wherever a term stands in them.
The settings were chosen by `inner_fold_errors`, on a fold of the training rows, never on the held-out fold.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.linear import BITS, Model, held_out, score, scorer, train, training_texts
from corpusmill.llm.words import find_words, mix, ngram_hashes

SAMPLE_ROWS = 12_000
THRESHOLD = 0.5
PENALTY = 1.0
_SETTINGS = {"epochs": 5, "alpha": 1.0, "l1": 12.0}
# Words are also known by their first bytes, as insults come with endings.
PREFIXES = (4, 5, 6)

# Identity terms per language; the first of each row is the neutral word.
IDENTITY_TERMS = [
    ["people", "women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees", "blacks", "whites", "asians", "africans", "arabs", "latinos", "gays", "lesbians", "transgender", "disabled", "elderly"],
    ["person", "woman", "man", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "immigrant", "refugee", "black", "white", "asian", "african", "arab", "latino", "gay", "lesbian"],
    ["leute", "frauen", "männer", "muslime", "christen", "juden", "hindus", "buddhisten", "einwanderer", "flüchtlinge", "schwarze", "weiße", "asiaten", "afrikaner", "araber", "schwule", "lesben", "behinderte", "alte"],
    ["gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "immigrés", "réfugiés", "noirs", "blancs", "asiatiques", "africains", "arabes", "homosexuels", "lesbiennes", "handicapés"],
    ["gente", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "hindúes", "budistas", "inmigrantes", "refugiados", "negros", "blancos", "asiáticos", "africanos", "árabes", "homosexuales", "lesbianas", "discapacitados"],
]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = find_words(texts, lower=True)
    text_of, hashes = words.text_of, words.hashes
    pairs, first = ngram_hashes(hashes, text_of, 2)
    ids = [hashes, pairs, *[mix(words.prefix_hashes(n) + np.uint64(n)) for n in PREFIXES]]
    owners = [text_of, text_of[first], *[text_of] * len(PREFIXES)]
    return (np.concatenate(ids) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


class Swapper:
    """Pairs of counterfactual forms of a text, where None is the text itself."""

    def __init__(self, terms: list[list[str]]) -> None:
        self.terms = [row for row in terms if len(row) > 1]
        self.rows = {t: row for row in reversed(self.terms) for t in row[1:]}
        listed = sorted({t for row in self.terms for t in row[1:]}, key=lambda t: (-len(t), t))
        self.pattern = re.compile(rf"\b(?:{'|'.join(map(re.escape, listed))})\b", re.IGNORECASE) if listed else None

    def __call__(self, key: object, text: str) -> list[tuple[str | None, str]]:
        turn = zlib.crc32(str(key).encode())
        if self.pattern is None:
            return []
        if not self.pattern.search(text):
            return self._mentions(turn, text)

        def other(match: re.Match) -> str:
            row = self.rows[match[0].lower()]
            place = row.index(match[0].lower()) - 1
            return row[1 + (place + 1 + turn % max(1, len(row) - 2)) % (len(row) - 1)]

        return [(None, self.pattern.sub(other, text)), (None, self.pattern.sub(lambda m: self.rows[m[0].lower()][0], text))]

    def _mentions(self, turn: int, text: str) -> list[tuple[str, str]]:
        """The text with a neutral word and with a group's term behind one of its words; none for a text without words."""
        ends = [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        if not ends:
            return []
        at, row = ends[turn % len(ends)], self.terms[turn // 7 % len(self.terms)]
        term = row[1 + turn // 101 % (len(row) - 1)]
        return [(f"{text[:at]} {row[0]}{text[at:]}", f"{text[:at]} {term}{text[at:]}")]


def train_toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, penalty: float = PENALTY, terms: list[list[str]] | None = None,
    without: tuple[int, ...] = (0,), **settings: float,
) -> Model:
    """Learns from labels.toxic outside the held-out folds `without`; without any label, all scores are 0.5."""
    texts = training_texts(docs, labels, "toxic", sample_rows, without=without)
    return train(texts, features, True, Swapper(IDENTITY_TERMS if terms is None else terms), penalty=penalty, **(_SETTINGS | settings))


def inner_fold_errors(docs: DataFrame, labels: DataFrame, fold: int = 1, **settings: float) -> dict[tuple[int, int], int]:
    """{(label, predicted): documents} on one fold of the training rows by a model that has not seen it, for choosing settings."""
    model = train_toxicity(docs, labels, without=(0, fold), **settings)
    asked = training_texts(docs, labels, "toxic", SAMPLE_ROWS).where(held_out("doc_id", fold))
    judged = asked.select("label", (scorer(docs.sparkSession, features, model)(F.col("text")) >= THRESHOLD).cast("int").alias("predicted"))
    return {(r.label, r.predicted): r.n for r in judged.groupBy("label", "predicted").agg(F.count("*").alias("n")).collect()}


def classify_toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD, penalty: float = PENALTY
) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`, from its text alone.

    Null and empty texts get the score of the bias; null ids are scored, never learned from; repeated rows
    are scored each; an empty table gives no rows; other columns are not read.
    """
    scored = score(docs, features, train_toxicity(docs, labels, sample_rows, penalty))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
