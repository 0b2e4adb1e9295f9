"""Learning of word-level, byte-pair and word-piece vocabularies from word counts.

A learned vocabulary is two tables: `vocab (id, token, cnt, score)` and `merges (rank, left, right)`.
Both are bounded by the `vocab_size` parameter; the word counts they are learned from never leave Spark.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.operators.relational import top_k_vocab
from corpusmill.operators.words import SPECIAL_TOKENS
from corpusmill.session import materialize

VOCAB_SCHEMA = "id int, token string, cnt bigint, score double"
MERGES_SCHEMA = "rank int, left string, right string"

# Per round: pairs that make up segments, at first and at most, and distinct segments looked at.
FIRST_PAIRS = 64
MOST_PAIRS = 4096
SEGMENTS_PER_ROUND = 50_000
# Pairs that a task holds before it hands them over, and room for a code point beside another.
PAIRS_HELD = 500_000
_POINT_BITS = 21


@dataclass
class Vocabulary:
    kind: str
    vocab: DataFrame
    merges: DataFrame
    params: dict[str, Any] = field(default_factory=dict)


def vocabulary(spark: SparkSession, kind: str, rows: list[tuple], merges: list[tuple] = [], **params: Any) -> Vocabulary:
    return Vocabulary(
        kind, spark.createDataFrame(rows, VOCAB_SCHEMA), spark.createDataFrame(merges, MERGES_SCHEMA), params
    )


def train_word_level(
    counts: DataFrame, vocab_size: int = 30_000, min_frequency: int = 0, special_tokens: Sequence[str] = SPECIAL_TOKENS
) -> Vocabulary:
    """Special tokens first, then words by falling count and rising word."""
    spark, n = counts.sparkSession, len(special_tokens)
    specials = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(special_tokens)], VOCAB_SCHEMA)
    chosen = top_k_vocab(counts, max(vocab_size - n, 0), min_frequency)
    # The window runs over the chosen words only, of which there are at most vocab_size.
    order = Window.orderBy(F.desc("cnt"), "word")
    ranked = chosen.select(
        (F.row_number().over(order) + n - 1).cast("int").alias("id"), F.col("word").alias("token"), "cnt",
        F.lit(None).cast("double").alias("score"),
    )
    merges = spark.createDataFrame([], MERGES_SCHEMA)
    return Vocabulary("word_level", specials.unionByName(ranked), merges, {"unk_token": special_tokens[0] if n else None})


def adjacent_pairs(symbols: Column) -> Column:
    """The concatenated neighbours of a list of symbols."""
    n = F.size(symbols)
    return F.zip_with(F.slice(symbols, 1, n - 1), F.slice(symbols, 2, n - 1), lambda a, b: F.concat(a, b))


def pair_counts(words: DataFrame, word: str = "word") -> DataFrame:
    """(pair, cnt): how often two characters stand next to each other, weighted by the word counts."""
    pairs = words.where(F.length(word) > 1).select(F.explode(adjacent_pairs(F.split(word, ""))).alias("pair"), "cnt")
    return pairs.groupBy("pair").agg(F.sum("cnt").alias("cnt"))


def character_counts(words: DataFrame) -> DataFrame:
    chars = words.select(F.explode(F.split("word", "")).alias("ch"), "cnt").where("ch <> ''")
    return chars.groupBy("ch").agg(F.sum("cnt").alias("cnt"))


def affixed_characters(words: DataFrame, alphabet: Sequence[str], prefix: str, suffix: str) -> list[str]:
    """The characters of the alphabet with the affixes of the positions they occur at."""
    n = F.length("word")

    def form(inner: Column, last: Column, ch: Column) -> Column:
        return F.struct(inner.alias("inner"), last.alias("last"), ch.alias("ch"))

    ends = F.array(
        form(F.lit(False), n == 1, F.substr("word", F.lit(1), F.lit(1))), form(n > 1, F.lit(True), F.substr("word", n, F.lit(1)))
    )
    middle = F.split(F.substr("word", F.lit(2), F.greatest(n - 2, F.lit(0))), "")
    between = F.transform(middle, lambda c: form(F.lit(True), F.lit(False), c))
    forms = words.where(n > 0).select(F.explode(F.concat(ends, between)).alias("f")).select("f.*").distinct()
    known = set(alphabet)
    rows = sorted((r["inner"], r["last"], r["ch"]) for r in forms.collect() if r["ch"] in known)
    return [(prefix if inner else "") + c + (suffix if last else "") for inner, last, c in rows]


def symbol_char(number: int) -> str:
    """The character that stands for a symbol; the order of characters is the order of numbers."""
    point = number + 1
    return chr(point if point < 0xD800 else point + 0x800)


def symbol_number(char: str) -> int:
    point = ord(char)
    return (point if point < 0xD800 else point - 0x800) - 1


class Symbols:
    """Numbered symbols. A word is written with one character per symbol, so that a merge is a `replace`."""

    def __init__(self, prefix: str, suffix: str) -> None:
        self.prefix, self.suffix = prefix, suffix
        self.names: list[str] = []
        self.counts: list[int | None] = []
        self.numbers: dict[str, int] = {}

    def add(self, name: str, count: int | None) -> int:
        if name not in self.numbers:
            self.numbers[name] = len(self.names)
            self.names.append(name)
            self.counts.append(count)
        return self.numbers[name]

    def joined(self, left: str, right: str) -> str:
        if self.prefix and right.startswith(self.prefix):
            right = right[len(self.prefix):]
        return left + right

    def write(self, word: Column, alphabet: Sequence[str], dropped: Sequence[str] = ()) -> Column:
        """The word in symbol characters, without the dropped characters."""

        def part(text: Column, first: bool, last: bool) -> Column:
            names = {c: ("" if first else self.prefix) + c + (self.suffix if last else "") for c in alphabet}
            known = {c: symbol_char(self.numbers[n]) for c, n in names.items() if n in self.numbers}
            return F.translate(text, "".join([*known, *dropped]), "".join(known.values()))

        n = F.length(word)
        if not self.prefix and not self.suffix:
            return part(word, True, True)
        # substring() with a column length, by expression, as the parts depend on the word's length.
        middle = F.when(n > 2, part(F.substr(word, F.lit(2), F.greatest(n - 2, F.lit(0))), False, False)).otherwise(F.lit(""))
        whole = F.concat(part(F.substr(word, F.lit(1), F.lit(1)), True, False), middle, part(F.substr(word, n, F.lit(1)), False, True))
        return F.when(n < 2, part(word, True, True)).otherwise(whole)


def _points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words, and the word of each."""
    texts = words.to_pylist()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    return flat, np.repeat(np.arange(len(texts)), sizes)


def _as_pairs(points: np.ndarray) -> np.ndarray:
    """Each code point with the next as one number."""
    return points[:-1] << _POINT_BITS | points[1:]


def symbol_pair_counts(words: DataFrame) -> DataFrame:
    """`pair_counts` of words without nulls, summed up in each task before pairs become rows."""

    def rows(keys: list[np.ndarray], totals: list[np.ndarray]) -> pa.RecordBatch:
        pairs, total = _sums_by_key(np.concatenate(keys), np.concatenate(totals))
        text = np.stack([pairs >> _POINT_BITS, pairs & (1 << _POINT_BITS) - 1], axis=1).astype(np.uint32).tobytes().decode("utf-32-le")
        return pa.RecordBatch.from_arrays([pa.array([text[i:i + 2] for i in range(0, len(text), 2)], pa.string()), pa.array(total)], names=["pair", "cnt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, totals, held = [], [], 0
        for batch in batches:
            flat, word = _points(batch.column(0))
            same = np.flatnonzero(word[1:] == word[:-1])
            key, total = _sums_by_key(_as_pairs(flat)[same], batch.column(1).fill_null(0).to_numpy()[word[same]])
            keys.append(key)
            totals.append(total)
            held += len(key)
            if held >= PAIRS_HELD:
                yield rows(keys, totals)
                keys, totals, held = [], [], 0
        if held:
            yield rows(keys, totals)

    found = words.select("word", F.col("cnt").cast("bigint")).mapInArrow(run, "pair string, cnt bigint")
    return found.groupBy("pair").agg(F.sum("cnt").alias("cnt"))


def _sums_by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, of = np.unique(keys, return_inverse=True)
    if len(of) and np.bincount(of, weights=np.abs(values.astype(float))).max() >= 2**63:
        raise OverflowError("counts of a pair beyond 64 bits")
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, of, values)
    return distinct, total


def cut_words(words: DataFrame, heavy: Sequence[str]) -> DataFrame:
    """(word, cnt): a NUL between all symbols that form none of the heavy pairs, and at the end."""
    known = np.sort(np.array([ord(a) << _POINT_BITS | ord(b) for a, b in heavy], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, word = _points(batch.column(0))
            apart = np.ones(len(flat), bool)
            apart[:-1] = (word[1:] != word[:-1]) | ~np.isin(_as_pairs(flat), known)
            ends = np.arange(1, len(flat) + 1) + np.cumsum(apart)
            cut = np.zeros(len(flat) + np.count_nonzero(apart), np.uint32)
            cut[ends - 1 - apart] = flat
            text = cut.tobytes().decode("utf-32-le")
            bounds = np.concatenate([[0], ends])[np.searchsorted(word, np.arange(batch.num_rows + 1))].tolist()
            yield pa.RecordBatch.from_arrays([pa.array([text[a:b] for a, b in zip(bounds, bounds[1:])], pa.string()), batch.column(1)], names=["word", "cnt"])

    chosen = words.select("word", "cnt")
    return chosen.mapInArrow(run, chosen.schema)


def segments(cut: DataFrame) -> DataFrame:
    """(word, cnt): the pieces of cut words with a symbol or more to merge, counted anew."""
    pieces = cut.select(F.explode(F.split("word", "\0")).alias("word"), "cnt")
    return pieces.where(F.length("word") > 1).groupBy("word").agg(F.sum("cnt").alias("cnt"))


def replace_segments(cut: DataFrame, merged: dict[str, str]) -> DataFrame:
    """Whole words again, with each segment in its merged form; there are at most SEGMENTS_PER_ROUND forms."""
    shared = cut.sparkSession.sparkContext.broadcast(merged)

    @F.arrow_udf("string")
    def whole(words: pa.Array) -> pa.Array:
        form = shared.value
        return pa.array(["".join(form.get(p, p) for p in w.split("\0")) for w in words.to_pylist()], pa.string())

    return cut.select(whole("word").alias("word"), "cnt")


def merge_order(
    pieces: list[tuple[str, int]], symbols: Symbols, room: int, least: int, excluded: tuple[int, int, int] | None
) -> tuple[list[tuple[int, int]], dict[str, str]]:
    """The merges (left, right) that the segments determine, in order, and the segments they change.

    All pairs ranked before the excluded one lie within segments. A merged symbol arises from one pair
    only, so a pair across a cut is never more frequent than the pair that was cut there, nor ranked
    before it. Hence the order is that of the whole table down to the rank of the excluded pair. A merge
    whose text is a symbol already would break this, so it is taken alone.
    """
    words = [[symbol_number(c) for c in text] for text, _ in pieces]
    weight = [cnt for _, cnt in pieces]
    count: dict[tuple[int, int], int] = defaultdict(int)
    where: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i, word in enumerate(words):
        for pair in zip(word, word[1:]):
            count[pair] += weight[i]
            where[pair].add(i)
    queue = [(-c, *pair) for pair, c in count.items()]
    heapify(queue)
    merges: list[tuple[int, int]] = []
    changed: set[int] = set()
    while queue and room > 0:
        negative, left, right = heappop(queue)
        pair, c = (left, right), count[left, right]
        if c != -negative:
            if c > 0:
                heappush(queue, (-c, left, right))
            continue
        if c < least or (excluded is not None and (-c, left, right) >= excluded):
            break
        name = symbols.joined(symbols.names[left], symbols.names[right])
        known = name in symbols.numbers
        if known and merges:
            break
        number = symbols.add(name, c)
        merges.append((left, right))
        room -= not known
        touched = set()
        for i in where.pop(pair):
            word, merged, at = words[i], [], 0
            while at < len(word):
                joined = word[at : at + 2] == [left, right]
                merged.append(number if joined else word[at])
                at += 2 if joined else 1
            for old in zip(word, word[1:]):
                count[old] -= weight[i]
            for new in zip(merged, merged[1:]):
                count[new] += weight[i]
                where[new].add(i)
                touched.add(new)
            words[i] = merged
            changed.add(i)
        for new in touched:
            if new != pair and count[new] > 0:
                heappush(queue, (-count[new], *new))
        if known:
            break
    return merges, {pieces[i][0]: "".join(map(symbol_char, words[i])) for i in changed}


def train_bpe(
    counts: DataFrame,
    vocab_size: int = 30_000,
    min_frequency: int = 0,
    special_tokens: Sequence[str] = SPECIAL_TOKENS,
    initial_alphabet: Sequence[str] = (),
    limit_alphabet: int | None = None,
    continuing_subword_prefix: str = "",
    end_of_word_suffix: str = "",
    kind: str = "bpe",
) -> Vocabulary:
    """Merge the most frequent pair of neighbouring symbols until the vocabulary is full.

    Ties go to the pair with the lowest left and then right number. A round is two Spark jobs over the
    table of distinct words: one ranks the pairs, the other cuts the words down to segments of the
    top-ranked pairs. The distinct segments, of which at most SEGMENTS_PER_ROUND are taken, decide all
    merges up to the rank of the first pair left out; the words themselves stay in Spark.
    """
    spark = counts.sparkSession
    counts = materialize(counts.select("word", "cnt"), "words")
    # At most one row per Unicode character.
    frequency = {r["ch"]: r["cnt"] for r in character_counts(counts).collect()}
    wanted = {c[0] for c in initial_alphabet if c}
    ranked_chars = sorted(frequency.keys() | wanted, key=lambda c: (c not in wanted, -frequency.get(c, 0), c))
    alphabet = sorted(ranked_chars if limit_alphabet is None else ranked_chars[: max(limit_alphabet, len(wanted))])

    clash = set(special_tokens) & set(alphabet)
    if clash:
        raise ValueError(f"special tokens must be longer than one character: {sorted(clash)}")
    symbols = Symbols(continuing_subword_prefix, end_of_word_suffix)
    for c in alphabet:
        symbols.add(c, frequency.get(c))
    if continuing_subword_prefix or end_of_word_suffix:
        for name in affixed_characters(counts, alphabet, continuing_subword_prefix, end_of_word_suffix):
            symbols.add(name, None)

    room_for = vocab_size - len(special_tokens)
    written = symbols.write(F.col("word"), alphabet, sorted(set(ranked_chars) - set(alphabet)))
    words = counts.select(written.alias("word"), "cnt").where(F.length("word") > 1)
    words = materialize(words.repartition(spark.sparkContext.defaultParallelism), "symbols")
    least = max(1, min_frequency)
    merges: list[tuple[str, str]] = []
    n_pairs = FIRST_PAIRS
    while len(symbols.names) < room_for:
        ranking = symbol_pair_counts(words).where(F.col("cnt") >= least).orderBy(F.desc("cnt"), "pair")
        ranked = ranking.limit(n_pairs + 1).collect()
        if not ranked:
            break
        while True:
            cut = cut_words(words, [r["pair"] for r in ranked[:n_pairs]])
            distinct = segments(cut)
            # The segments of one pair are that pair, or runs of one symbol, of which there is one for each length.
            pieces = (distinct if n_pairs == 1 else distinct.limit(SEGMENTS_PER_ROUND + 1)).collect()
            if len(pieces) <= SEGMENTS_PER_ROUND or n_pairs == 1:
                break
            n_pairs = max(1, n_pairs // 4)
        excluded = None
        if len(ranked) > n_pairs:
            out = ranked[n_pairs]
            excluded = (-out["cnt"], *(symbol_number(c) for c in out["pair"]))
        if len(pieces) < SEGMENTS_PER_ROUND // 4:
            n_pairs = min(n_pairs * 2, MOST_PAIRS)
        found, merged = merge_order([tuple(p) for p in pieces], symbols, room_for - len(symbols.names), least, excluded)
        merges += [(symbols.names[left], symbols.names[right]) for left, right in found]
        if len(symbols.names) < room_for:
            words = materialize(replace_segments(cut, merged), "symbols").where(F.length("word") > 1)

    rows = [(i, t, None, None) for i, t in enumerate(special_tokens)]
    rows += [(len(rows) + i, name, symbols.counts[i], None) for i, name in enumerate(symbols.names)]
    params = {
        "unk_token": special_tokens[0] if special_tokens else None,
        "continuing_subword_prefix": continuing_subword_prefix,
        "end_of_word_suffix": end_of_word_suffix,
    }
    return vocabulary(spark, kind, rows, [(i, a, b) for i, (a, b) in enumerate(merges)], **params)


def train_wordpiece(
    counts: DataFrame, vocab_size: int = 30_000, continuing_subword_prefix: str = "##", **params: Any
) -> Vocabulary:
    """Byte-pair learning over symbols that carry the prefix everywhere but at the start of a word."""
    return train_bpe(
        counts, vocab_size, continuing_subword_prefix=continuing_subword_prefix, kind="wordpiece", **params
    )
