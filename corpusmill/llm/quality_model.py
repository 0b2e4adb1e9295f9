"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Besides words and word pairs, the n-grams are also taken over word shapes (which kinds of characters a word
has, its last sign, whether it repeats the word before), since a corpus always brings words that were not in
the labelled sample. All n-grams are hashed into one table of weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.linear import BITS, Model, held_out, score, train, training_texts
from corpusmill.llm.words import Words, find_words, mix, ngram_hashes

# At most so many labelled documents are learned from; all texts are scored.
SAMPLE_ROWS = 8_000
THRESHOLD = 0.3
_SETTINGS = {"epochs": 4, "alpha": 1.0, "l1": 0.1}

_BYTE = np.arange(256)
_LOWER = ((_BYTE >= ord("a")) & (_BYTE <= ord("z"))) | (_BYTE >= 0xC0)
_UPPER = (_BYTE >= ord("A")) & (_BYTE <= ord("Z"))
_DIGIT = (_BYTE >= ord("0")) & (_BYTE <= ord("9"))
_OTHER = ~(_LOWER | _UPPER | _DIGIT | (_BYTE >= 0x80))


def word_shapes(words: Words, hashes: np.ndarray) -> np.ndarray:
    """A number per word: how many (0, 1, more) characters of each kind, its last sign, and whether it repeats the word before."""
    shape = np.zeros(len(words.start), np.int64)
    for kind in (_LOWER, _UPPER, _DIGIT, _OTHER):
        total = np.zeros(len(words.data) + 1, np.int32)
        np.cumsum(kind[words.data], out=total[1:])
        shape = shape * 3 + np.minimum(total[words.end] - total[words.start], 2)
    last = words.data[words.end - 1].astype(np.int64)
    repeats = np.zeros(len(words.start), np.int64)
    repeats[1:] = hashes[1:] == hashes[:-1]
    repeats[words.bounds[:-1][words.counts > 0]] = 0
    return (shape * 256 + np.where(_OTHER[last], last, 0)) * 2 + repeats


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = find_words(texts)
    text_of, hashes = words.text_of, words.hashes
    shapes = mix(word_shapes(words, hashes).astype(np.uint64) + np.uint64(1 << 40))
    ids, owners = [hashes, shapes], [text_of, text_of]
    for source, n, seed in ((hashes, 2, 1), (shapes, 2, 2), (shapes, 3, 3)):
        grams, first = ngram_hashes(source, text_of, n, seed)
        ids.append(grams)
        owners.append(text_of[first])
    return (np.concatenate(ids) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def train_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from labels.quality outside the held-out fold; without any label, all scores are 0.5."""
    return train(training_texts(docs, labels, "quality", sample_rows), features, binary=False, **_SETTINGS)


def classify_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`, from its text alone.

    Null and empty texts get the score of the bias; null ids are scored, never learned from; repeated rows
    are scored each; an empty table gives no rows; other columns are not read.
    """
    scored = score(docs, features, train_quality(docs, labels, sample_rows))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
