"""Learning of a unigram vocabulary by expectation maximisation over distinct words.

Words, pieces, scores, expected counts and losses are tables; only single numbers return to the driver, and in the end
the pieces of the vocabulary. Words are dealt to parts of bounded length. What a part needs of the pieces is joined to the
places where they occur in its words, and a part is worked through as one graph (`lattice.py`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.lattice import Lattice
from corpusmill.operators.relational import first_rows
from corpusmill.operators.repeats import maximal_repeats
from corpusmill.operators.segment import UNK_PENALTY
from corpusmill.operators.vocab import Vocabulary, character_counts, vocabulary
from corpusmill.operators.words import SPECIAL_TOKENS
from corpusmill.session import materialize

# Pieces expected less often than this are dropped, and more pieces than wanted are kept
# until the last step.
LEAST_EXPECTED = 0.5
SPARE = 1.1

# Characters of the words of a part, and substrings handed over at once.
PART_CHARACTERS = 200_000
SUBSTRINGS_PER_BATCH = 50_000


def seed_pieces(counts: DataFrame, max_piece_length: int, seed_size: int) -> DataFrame:
    """(piece, freq): maximal repeats, those with the largest freq * length first."""
    repeats = maximal_repeats(counts, max_piece_length)
    return first_rows(repeats, seed_size, F.desc(F.col("freq") * F.length("piece")), "piece")


def digamma(x: Column | float) -> Column:
    """By its recurrence up to 7 and more, and the asymptotic series from there."""
    x = F.lit(x) if isinstance(x, float) else x
    y = x + 6.5
    z = 1 / (y * y)
    series = F.log(y) + z / 24 - 7 * z * z / 960 + 31 * z * z * z / 8064 - 127 * z * z * z * z / 30720
    for i in range(7):
        series = series - 1 / (x + i)
    return series


@dataclass
class Scores:
    """(piece, score), how many there are, and the score of a character that no piece covers."""

    table: DataFrame
    size: int
    lowest: float

    @property
    def unknown(self) -> float:
        return self.lowest - UNK_PENALTY


@dataclass
class Layout:
    """Words (part, at, size, word, cnt) and the places (part, piece, places) where pieces occur in them."""

    words: DataFrame
    places: DataFrame


def _substrings(longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(pieces, pa.string()), pa.array(places, pa.int32())], ["part", "piece", "place"]
            )

        parts: list[int] = []
        pieces: list[str] = []
        places: list[int] = []
        for batch in batches:
            for part, at, word in zip(*(batch.column(c).to_pylist() for c in ("part", "at", "word"))):
                for start in range(len(word)):
                    ends = range(start + 1, min(len(word), start + longest) + 1)
                    pieces += [word[start:end] for end in ends]
                    parts += [part] * len(ends)
                    places += [at + start] * len(ends)
                    if len(pieces) >= SUBSTRINGS_PER_BATCH:
                        yield flush()
                        parts, pieces, places = [], [], []
        if pieces:
            yield flush()

    return cut


def lay_out(words: DataFrame, pieces: DataFrame, longest: int) -> Layout:
    """Deal words (word, cnt) to parts and find where pieces (piece) occur in them."""
    characters = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    n_parts = max(2 * words.sparkSession.sparkContext.defaultParallelism, ceil(characters / PART_CHARACTERS))
    part = F.pmod(F.xxhash64("word"), F.lit(n_parts)).cast("int")
    before = Window.partitionBy("part").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    dealt = words.select(part.alias("part"), F.length("word").alias("size"), "word", "cnt")
    at = F.coalesce(F.sum(F.col("size") + 1).over(before), F.lit(0)).cast("int")
    placed = materialize(dealt.select("part", at.alias("at"), "size", "word", "cnt"), "words")
    found = placed.select("part", "at", "word").mapInArrow(_substrings(longest), "part int, piece string, place int")
    places = found.join(pieces.select("piece"), "piece").groupBy("part", "piece").agg(F.collect_list("place").alias("places"))
    return Layout(placed, materialize(places, "places"))


def _lattice(words: pa.Table, arcs: pa.Table, unknown: float, proper: bool = False) -> tuple[Lattice, pa.Array]:
    arcs = arcs.sort_by("piece")
    pieces = arcs["piece"].combine_chunks()
    many = pc.list_value_length(arcs["places"]).to_numpy().astype(np.int64)
    source = pc.list_flatten(arcs["places"]).to_numpy().astype(np.int64)
    length = np.repeat(pc.utf8_length(pieces).to_numpy().astype(np.int64), many)
    score = np.repeat(arcs["score"].to_numpy(), many)
    sizes = words["size"].to_numpy().astype(np.int64)
    at = words["at"].to_numpy().astype(np.int64)
    return Lattice(at, sizes, source, length, np.repeat(np.arange(len(pieces)), many), score, unknown, proper), pieces


def _sums(pieces: pa.Array, values: np.ndarray) -> pa.Table:
    some = np.flatnonzero(values > 0)
    return pa.table({"piece": pieces.take(pa.array(some)), "value": pa.array(values[some], pa.float64())})


def _per_part(layout: Layout, scores: Scores, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """A piece has at most one row in a part, so no key of the join holds more rows than there are parts."""
    arcs = layout.places.join(scores.table, "piece")
    return layout.words.groupBy("part").cogroup(arcs.groupBy("part")).applyInArrow(work, schema)


def expected_pieces(layout: Layout, scores: Scores) -> DataFrame:
    """(piece, value): how often each piece is expected to be used."""
    unknown = scores.unknown

    def work(words: pa.Table, arcs: pa.Table) -> pa.Table:
        lattice, pieces = _lattice(words, arcs, unknown)
        return _sums(pieces, lattice.expected(words["cnt"].to_numpy().astype(float), len(pieces)))

    return _per_part(layout, scores, work, "piece string, value double").groupBy("piece").agg(F.sum("value").alias("value"))


def used_pieces(layout: Layout, scores: Scores) -> DataFrame:
    """(piece, value): how often each piece is used by the most probable way to write each word."""
    unknown = scores.unknown

    def work(words: pa.Table, arcs: pa.Table) -> pa.Table:
        lattice, pieces = _lattice(words, arcs, unknown)
        word, piece = lattice.best()
        weight = words["cnt"].to_numpy().astype(float)[word]
        return _sums(pieces, np.bincount(piece[piece >= 0], weight[piece >= 0], len(pieces)))

    return _per_part(layout, scores, work, "piece string, value double").groupBy("piece").agg(F.sum("value").alias("value"))


def alternatives(layout: Layout, scores: Scores) -> DataFrame:
    """(piece, other): the pieces of the most probable way to write each piece without itself; null for a character none covers."""
    unknown = scores.unknown

    def work(words: pa.Table, arcs: pa.Table) -> pa.Table:
        lattice, pieces = _lattice(words, arcs, unknown, proper=True)
        word, other = lattice.best()
        numbers = pa.array(other, mask=other < 0)
        return pa.table({"piece": words["word"].combine_chunks().take(pa.array(word)), "other": pieces.take(numbers)})

    current = layout.words.join(scores.table.select(F.col("piece").alias("word")), "word", "left_semi")
    return _per_part(Layout(current, layout.places), scores, work, "piece string, other string")


def _maximize(expected: DataFrame) -> Scores:
    values = materialize(expected.where(F.col("value") >= LEAST_EXPECTED), "expected")
    total = digamma(F.sum("value"))
    row = values.agg(F.count("*").alias("n"), total.alias("total"), (digamma(F.min("value")) - total).alias("lowest")).first()
    if not row["n"]:
        return Scores(values.select("piece", F.col("value").alias("score")), 0, 0.0)
    return Scores(values.select("piece", (digamma(F.col("value")) - row["total"]).alias("score")), row["n"], row["lowest"])


def _prune(words: Layout, pieces: Layout, scores: Scores, wanted: int, shrinking_factor: float) -> Scores:
    """Drop the pieces whose loss costs the least likelihood; those that cannot be written otherwise stay."""
    used = materialize(used_pieces(words, scores), "used")
    all_used = used.agg(F.sum("value")).first()[0] or 0.0
    known = scores.table.join(used, "piece", "left").select("piece", "score", F.coalesce("value", F.lit(0.0)).alias("f"))
    others = known.select(F.col("piece").alias("other"), F.col("score").alias("other_score"), F.col("f").alias("other_f"))
    written = alternatives(pieces, scores).join(others, "other", "left").join(known, "piece")
    each = written.groupBy("piece", "score", "f").agg(
        F.bool_or(F.col("other").isNull()).alias("always"), F.count("*").alias("n"), F.sum("other_score").alias("other_score"),
        F.sum(F.log(F.col("other_f") + F.col("f"))).alias("logs"),
    )
    f = F.col("f")
    loss = F.log(f) - log(all_used or 1.0) - F.col("logs") + F.col("n") * F.log(F.lit(all_used) + f * (F.col("n") - 1))
    worth = F.when(F.col("always"), F.lit(None)).otherwise(f * loss)
    stays = F.col("always") | ((f > 0) & (F.col("other_score") <= F.col("score")))
    judged = each.where(stays).select("piece", "score", "always", worth.alias("worth"))
    size = max(wanted, int(scores.size * shrinking_factor))
    kept = first_rows(judged, size, F.desc("always"), F.desc("worth"), "piece", keep="always").select("piece", "score")
    row = kept.agg(F.count("*").alias("n"), F.min("score").alias("lowest")).first()
    return Scores(kept, row["n"], row["lowest"] or 0.0)


def train_unigram(
    counts: DataFrame,
    vocab_size: int = 8_000,
    special_tokens: Sequence[str] = SPECIAL_TOKENS,
    initial_alphabet: Sequence[str] = (),
    shrinking_factor: float = 0.75,
    max_piece_length: int = 16,
    n_sub_iterations: int = 2,
    unk_token: str | None = "[UNK]",
    seed_size: int = 1_000_000,
) -> Vocabulary:
    """Start from maximal repeats, re-estimate and prune until the vocabulary has its size.

    The seeds are bounded by `seed_size` and the number of characters. Null and empty words count for nothing; without a
    word, the vocabulary is the special tokens and the initial alphabet.
    """
    spark = counts.sparkSession
    words = materialize(counts.select("word", "cnt").where(F.length("word") > 0), "words")
    characters = materialize(character_counts(words), "characters")
    seeds = seed_pieces(words, max_piece_length, seed_size)
    weight = (F.col("freq") * F.length("piece")).cast("double")
    weights = materialize(
        characters.select(F.col("ch").alias("piece"), F.col("cnt").cast("double").alias("weight"))
        .unionByName(seeds.select("piece", weight.alias("weight"))),
        "seeds",
    )
    row = weights.agg(F.count("*").alias("n"), F.log(F.sum("weight")).alias("total"), F.log(F.min("weight")).alias("lowest")).first()
    start = weights.select("piece", (F.log("weight") - F.lit(row["total"] or 0.0)).alias("score"))
    scores = Scores(start, row["n"], (row["lowest"] or 0.0) - (row["total"] or 0.0))
    wanted = int(vocab_size * SPARE)
    if scores.size:
        in_words = lay_out(words, weights, max_piece_length)
        in_pieces = lay_out(weights.select(F.col("piece").alias("word"), F.lit(1).alias("cnt")), weights, max_piece_length)
    while scores.size:
        for _ in range(n_sub_iterations):
            scores = _maximize(expected_pieces(in_words, scores))
        if scores.size <= wanted:
            break
        before = scores.size
        scores = _prune(in_words, in_pieces, scores, wanted, shrinking_factor)
        if scores.size >= before:
            break

    # Every character stays, with a low score if learning dropped it. Both lists are bounded, by Unicode and by vocab_size.
    found = {r["ch"]: r["score"] for r in characters.join(scores.table, F.col("ch") == F.col("piece"), "left").select("ch", "score").collect()}
    required = sorted(found.keys() | {c[0] for c in initial_alphabet if c})
    final = {c: scores.lowest - 0.0001 * (i + 1) if found.get(c) is None else found[c] for i, c in enumerate(required)}
    for piece, score in scores.table.orderBy(F.desc("score"), "piece").limit(vocab_size).collect():
        if len(final) + len(special_tokens) >= vocab_size:
            break
        final.setdefault(piece, score)
    ranked = sorted(final.items(), key=lambda x: (-x[1], x[0]))
    rows = [(i, t, None, None) for i, t in enumerate(special_tokens)]
    rows += [(len(special_tokens) + i, p, None, s) for i, (p, s) in enumerate(ranked)]
    return vocabulary(spark, "unigram", rows, unk_token=unk_token)
