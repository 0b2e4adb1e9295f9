"""Spelling correction as joins over distinct words.

A dictionary is a table (term, cnt), word-pair frequencies are a table (left, right, cnt). Nothing is
looked up per text: the distinct words of the corpus are resolved once and joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.edit_walk import Trie, walk
from corpusmill.operators.hotkeys import lookup_join
from corpusmill.session import discard, materialize

# What a term is, and the size of the corpus behind word-pair estimates.
TERM = r"[\p{L}\p{N}]+['’]*[\p{L}\p{N}]*"
CORPUS_WORDS = 1_024_908_267_229.0

MAX_DISTANCE = 2
PREFIX_LENGTH = 7


def build_dictionary(counts: DataFrame, count_threshold: int = 1) -> DataFrame:
    """(term, cnt) from word counts, without terms rarer than the threshold."""
    return counts.select(F.col("word").alias("term"), "cnt").where(F.col("cnt") >= count_threshold)


def delete_variants(word: Column, max_distance: int = MAX_DISTANCE, prefix_length: int = PREFIX_LENGTH) -> Column:
    """All ways to delete up to `max_distance` characters from the word's prefix."""

    def shorter(w: Column) -> Column:
        def without(i: Column) -> Column:
            return F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1))

        return F.transform(F.when(F.length(w) > 0, F.sequence(F.lit(1), F.length(w))).otherwise(F.array()), without)

    level = F.array(F.substring(word, 1, prefix_length))
    levels = [level]
    for _ in range(max_distance):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        levels.append(level)
    return F.array_distinct(reduce(F.concat, levels))


def delete_index(dictionary: DataFrame, max_distance: int = MAX_DISTANCE, prefix_length: int = PREFIX_LENGTH) -> DataFrame:
    """(variant, term, cnt)"""
    return dictionary.select(F.explode(delete_variants(F.col("term"), max_distance, prefix_length)).alias("variant"), "term", "cnt")


def alignment_distance(a: str, b: str) -> int:
    """Edits by insertion, deletion, replacement and swap of neighbours, no place edited twice."""
    two_ago: list[int] = []
    ago, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        two_ago, ago, row = ago, row, [i]
        for j, y in enumerate(b, 1):
            best = min(ago[j] + 1, row[j - 1] + 1, ago[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two_ago[j - 2] + 1)
            row.append(best)
    return row[-1]


def edit_distance(a: Column, b: Column, at_most: int) -> Column:
    """The distance of two strings, or `at_most` + 1 for anything above.

    A swap counts twice in the built-in distance, so that one decides all pairs but those where swaps may
    matter; only these reach Python. With a swap, a distance of d within `at_most` leaves at most 2 d - plain other edits,
    and no swap changes the characters, so strings that differ in more of them are decided too.
    """

    @F.arrow_udf("int")
    def aligned(xs: pa.Array, ys: pa.Array) -> pa.Array:
        pairs = zip(xs.to_pylist(), ys.to_pylist())
        return pa.array([None if x is None or y is None else alignment_distance(x, y) for x, y in pairs], pa.int32())

    plain = F.levenshtein(a, b, 2 * at_most)
    others = 2 * F.least(F.lit(at_most), plain - 1) - plain
    chars, other_chars = F.split(a, ""), F.split(b, "")
    unsure = (
        (plain >= 2) & (F.abs(F.length(a) - F.length(b)) <= others)
        & (F.size(F.array_except(chars, other_chars)) <= others) & (F.size(F.array_except(other_chars, chars)) <= others)
    )
    exact = F.coalesce(aligned(F.when(unsure, a), F.when(unsure, b)), plain)
    return F.when(plain < 0, at_most + 1).otherwise(F.least(exact, F.lit(at_most + 1)))


# Terms of a range of the dictionary, which one task holds as a trie; words that are walked at once; words of a block.
RANGE_TERMS = 200_000
WORDS_AT_ONCE = 2_000
BLOCK_WORDS = 100_000
LEAST_BLOCK_WORDS = 5_000


def _ranges(dictionary: DataFrame, max_distance: int, range_terms: int) -> tuple[DataFrame, DataFrame]:
    """(the dictionary as one row for each range with its terms and counts, the ranges that words of a length must see).

    Terms go by length: short lengths share a range, one with more terms than a range holds is split by the start of the
    term. A word sees all ranges with lengths within the distance of its own, so no pair is lost.
    """
    sized = dictionary.where("term IS NOT NULL").select("term", "cnt", F.length("term").alias("size"))
    sizes = sized.groupBy("size").agg(F.count("*").alias("n"))
    # One row for each length that occurs.
    shorter = F.coalesce(F.sum("n").over(Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = materialize(sizes.select("size", F.floor(shorter / range_terms).alias("band"), F.ceil(F.col("n") / range_terms).alias("parts")), "sizes")
    part = F.pmod(F.xxhash64(F.substring("term", 1, 3)), F.col("parts"))
    dealt = sized.join(F.broadcast(sizes), "size").groupBy("band", part.alias("part"))
    packed = dealt.agg(F.array_sort(F.collect_list(F.struct("term", "cnt"))).alias("terms"))
    near = F.explode(F.sequence(F.greatest(F.col("size") - max_distance, F.lit(0)), F.col("size") + max_distance)).alias("size")
    seen = sizes.select(near, "band", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    return packed, seen.distinct()


def _walk_ranges(tokens: DataFrame, dictionary: DataFrame, max_distance: int, best: bool, range_terms: int) -> DataFrame:
    """(token, term, cnt, distance): all terms within the distance, or with `best` the first of each range."""
    spark = tokens.sparkSession
    asked = materialize(tokens.select("token").where("token IS NOT NULL").distinct(), "asked")
    packed, seen = _ranges(dictionary, max_distance, range_terms)
    n = asked.count()
    blocks = max(-(-n // BLOCK_WORDS), min(2 * spark.sparkContext.defaultParallelism, n // LEAST_BLOCK_WORDS), 1)
    # Words with a common start share the top of the walk, so they share a block, but for starts of very many words.
    start = F.substring("token", 1, 2)
    starts = asked.groupBy(start.alias("start")).agg(F.ceil(F.count("*") * blocks / F.lit(max(n, 1))).alias("shares"))
    placed = asked.join(starts, start == F.col("start")).withColumn(
        "block", F.pmod(F.xxhash64("start", F.pmod(F.xxhash64("token"), F.col("shares"))), F.lit(blocks)).cast("int")
    )
    words = placed.join(F.broadcast(seen), F.length("token") == F.col("size")).select("block", "band", "part", "token", F.lit(None).cast(packed.schema["terms"].dataType).alias("terms"))
    every = packed.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "band", "part", F.lit(None).cast("string").alias("token"), "terms")
    place = ["block", "band", "part"]
    # The work of a row does not show in its bytes, so the number of tasks is not left to them.
    tasks = max(4 * spark.sparkContext.defaultParallelism, blocks)
    stream = every.unionByName(words).repartition(tasks, *place).sortWithinPartitions(*place, F.col("token").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, terms, counts = None, None, None
        waiting: list[str] = []

        def rows(asked: pa.Array, word: np.ndarray, term: np.ndarray, distance: np.ndarray) -> Iterator[pa.RecordBatch]:
            for low in range(0, len(word), 1 << 16):
                w, t, d = (x[low:low + (1 << 16)] for x in (word, term, distance))
                yield pa.RecordBatch.from_arrays([asked.take(pa.array(w)), terms.take(pa.array(t)), pa.array(counts[t]), pa.array(d.astype(np.int32))], names=["token", "term", "cnt", "distance"])

        def found() -> Iterator[pa.RecordBatch]:
            left = list(waiting)
            waiting.clear()
            # Where the nearest is enough, only the words without a term at a distance go on to the next one.
            for most in range(max_distance + 1) if best else [max_distance]:
                open_, asked = np.ones(len(left), bool), pa.array(left, pa.string())
                for word, term, distance in walk(left, trie, most):
                    if best:
                        # Terms are in order, so their numbers settle what distance and count leave open.
                        order = np.lexsort((term, -counts[term], distance, word))
                        first = np.ones(len(order), bool)
                        first[1:] = word[order][1:] != word[order][:-1]
                        word, term, distance = (x[order][first] for x in (word, term, distance))
                        open_[word] = False
                    yield from rows(asked, word, term, distance)
                left = [left[i] for i in np.flatnonzero(open_)]
                if not left:
                    break

        for batch in batches:
            packed, asked = batch.column(4), batch.column(3).to_pylist()
            for at, token in enumerate(asked):
                if token is None:
                    if waiting:
                        yield from found()
                    held = packed[at].values
                    terms, counts = held.field("term"), held.field("cnt").to_numpy(zero_copy_only=False)
                    trie = Trie(terms.to_pylist())
                    continue
                waiting.append(token)
                if len(waiting) == WORDS_AT_ONCE:
                    yield from found()
        if waiting:
            yield from found()

    return stream.mapInArrow(run, "token string, term string, cnt bigint, distance int")


def spell_candidates(
    tokens: DataFrame, dictionary: DataFrame, max_distance: int = MAX_DISTANCE, prefix_length: int = PREFIX_LENGTH, range_terms: int = RANGE_TERMS
) -> DataFrame:
    """(token, term, cnt, distance): all terms within the distance of each distinct token.

    The dictionary is dealt into ranges and the tokens into blocks; each block walks the ranges that can hold a term for
    one of its words (see `edit_walk`). No word is spelled out into variants, so none of them is shared by
    very many words. `prefix_length` sizes the index of variants only. Null tokens and terms have no candidates.
    """
    return _walk_ranges(tokens, dictionary, max_distance, False, range_terms)


def spell_best(
    tokens: DataFrame, dictionary: DataFrame, max_distance: int = MAX_DISTANCE, prefix_length: int = PREFIX_LENGTH, range_terms: int = RANGE_TERMS
) -> DataFrame:
    """(token, term, cnt, distance): the nearest term, then the most frequent, then the first by name.

    A token that is a term itself needs no candidates.
    """
    tokens = tokens.select("token")
    exact = tokens.join(dictionary, tokens["token"] == dictionary["term"]).select("token", "term", "cnt", F.lit(0).alias("distance"))
    left = tokens.join(dictionary, tokens["token"] == dictionary["term"], "left_anti")
    order = F.struct("distance", -F.col("cnt"), "term")
    best = (
        _walk_ranges(left, dictionary, max_distance, True, range_terms)
        .groupBy("token").agg(F.min_by(F.struct("term", "cnt", "distance"), order).alias("b")).select("token", "b.*")
    )
    return exact.unionByName(best)


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _best_columns(best: DataFrame, name: str) -> DataFrame:
    """(token, name): the answer as one struct column, ready to be joined several times."""
    return best.select(F.col("token").alias(f"_{name}_token"), F.struct("term", "cnt", "distance").alias(name))


def _cuts(terms: DataFrame, best: DataFrame, dictionary: DataFrame, max_distance: int) -> DataFrame:
    """(token, single, cut, a, b): the two-word splits of imperfect terms that may come as near as the term's own answer.

    A term at distance 1 from its answer is beaten or met only by a split at distance 1. That edit makes the blank,
    as terms have none: put in between two dictionary terms, or in place of the character between them. The nearest
    of halves cut elsewhere are these two terms only if the cut is off by no more than the distance. So cuts farther from
    such a place are left out; words that are terms are looked up by a join.
    """
    singles = terms.join(best.select("token", F.struct("term", "cnt", "distance").alias("single")), "token", "left")
    imperfect = singles.where(~F.coalesce(F.col("single.distance") == 0, F.lit(False)) & (F.length("token") > 1))
    close = F.coalesce(F.col("single.distance") == 1, F.lit(False))
    at = F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("cut")
    cut = [F.substr("token", F.lit(1), F.col("cut")).alias("a"), F.substr("token", F.col("cut") + 1).alias("b")]
    every = imperfect.where(~close).select("token", "single", at).select("token", "single", "cut", *cut)

    # An empty term is one too, so the cuts before and behind the token count as places.
    around = F.explode(F.sequence(F.lit(0), F.length("token"))).alias("cut")
    tried = imperfect.where(close).select("token", "single", around).select("token", "single", "cut", *cut)
    known = dictionary.select(F.col("term").alias("_term")).distinct()
    starts = tried.join(known, F.col("a") == F.col("_term"), "left_semi")
    ends = tried.join(known, F.col("b") == F.col("_term"), "left_semi")
    # A second part that begins behind the character in question has the cut of the first part plus one.
    behind = ends.select("token", F.explode(F.array("cut", F.col("cut") - 1)).alias("cut"))
    places = starts.select("token", "cut").join(behind.distinct(), ["token", "cut"], "left_semi")
    reach = F.sequence(F.col("cut") - max_distance, F.col("cut") + max_distance + 1)
    inside = tried.where((F.col("cut") > 0) & (F.col("cut") < F.length("token")))
    kept = inside.join(places.select("token", F.explode(reach).alias("cut")).distinct(), ["token", "cut"], "left_semi")
    return every.unionByName(kept.select(*every.columns))


def _halved(cuts: DataFrame, parts_best: DataFrame) -> DataFrame:
    """The cuts with the answers of their two parts, (token, single, cut, first, second), where both have one."""
    # A short part is shared by very many words.
    pairs = cuts
    for side, name in (("a", "first"), ("b", "second")):
        answers = parts_best.select(F.col("token").alias(side), "n", F.struct("term", "cnt", "distance").alias(name))
        pairs = lookup_join(pairs, answers, side, "n").where(F.col(name).isNotNull())
    return pairs.drop("a", "b")


def _resolve_terms(terms: DataFrame, best: DataFrame, pairs: DataFrame, bigrams: DataFrame, max_distance: int) -> DataFrame:
    """(token, n, single, resolved): each distinct term alone, then against its two-word splits."""
    singles = terms.join(best.select("token", F.struct("term", "cnt", "distance").alias("single")), "token", "left")
    rare = F.when(F.length("token") == 1, 1).otherwise(0).cast("bigint")
    unknown = F.struct(F.col("token").alias("term"), rare.alias("cnt"), F.lit(max_distance + 1).alias("distance"))
    perfect = F.coalesce(F.col("single.distance") == 0, F.lit(False))
    to_split = singles.where(~perfect & (F.length("token") > 1))

    known = bigrams.select(F.concat_ws(" ", "left", "right").alias("_pair"), F.col("cnt").alias("_pair_cnt"))
    least = bigrams.agg(F.coalesce(F.min("cnt"), F.lit(2**63 - 1)).alias("_least"))
    pairs = pairs.withColumn("text", F.concat_ws(" ", "first.term", "second.term"))
    pairs = pairs.join(known, F.col("text") == F.col("_pair"), "left").crossJoin(F.broadcast(least))

    rejoined = F.concat("first.term", "second.term") == F.col("token")
    shares_term = (F.col("first.term") == F.col("single.term")) | (F.col("second.term") == F.col("single.term"))
    pair_cnt = (
        F.when(F.col("single").isNotNull() & rejoined, F.greatest("_pair_cnt", F.col("single.cnt") + 2))
        .when(F.col("single").isNotNull() & shares_term, F.greatest("_pair_cnt", F.col("single.cnt") + 1))
        .when(F.col("single").isNull() & rejoined, F.greatest("_pair_cnt", F.greatest("first.cnt", "second.cnt") + 2))
        .otherwise(F.col("_pair_cnt"))
    )
    estimate = F.least(F.col("_least"), F.floor(F.col("first.cnt") / F.lit(CORPUS_WORDS) * F.col("second.cnt")).cast("bigint"))
    splits = pairs.select(
        "token", "cut", F.col("text").alias("term"),
        F.when(F.col("_pair_cnt").isNotNull(), pair_cnt).otherwise(estimate).alias("cnt"),
        edit_distance(F.col("token"), F.col("text"), max_distance).alias("distance"),
    )
    # The single-word answer competes as cut 0, so it wins ties.
    options = splits.unionByName(
        to_split.where(F.col("single").isNotNull()).select("token", F.lit(0).alias("cut"), "single.term", "single.cnt", "single.distance")
    )
    chosen = options.groupBy("token").agg(
        F.min_by(F.struct("term", "cnt", "distance"), F.struct("distance", -F.col("cnt"), "cut")).alias("chosen")
    )
    return singles.join(chosen, "token", "left").select(
        "token", "n", "single", F.coalesce(F.when(perfect, F.col("single")), F.col("chosen"), F.col("single"), unknown).alias("resolved")
    )


def spell_compound(
    df: DataFrame, text: str, key: list[str], dictionary: DataFrame, bigrams: DataFrame,
    max_distance: int = MAX_DISTANCE, prefix_length: int = PREFIX_LENGTH, output: str = "corrected",
    find: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Adds the corrected text: lower-cased terms, each corrected, merged with its neighbour or split in two.

    `key` identifies a row. Terms, neighbour pairs and splits are resolved as distinct values; the texts
    themselves take part in one count and one join on their neighbour pairs. `find` takes the place of `spell_best`
    where its answers are kept; it is asked three times: for whole terms, for the halves of those that a split may
    improve, and for the neighbours that may be nearer to a term together than apart.
    """
    if find is None:
        find = partial(spell_best, dictionary=dictionary, max_distance=max_distance, prefix_length=prefix_length)
    # Each term beside the one before it; the shifted list is one longer, so its last pair has no term.
    listed = df.select(*key, terms_of(F.col(text)).alias("_terms"))
    shifted = F.concat(F.array(F.lit("")), F.col("_terms"))
    beside = F.zip_with(shifted, "_terms", lambda before, term: F.struct(before.alias("prev"), term.alias("token")))
    occurrences = (
        listed.select(*key, F.posexplode(beside).alias("_pos", "_t")).where("_t.token IS NOT NULL")
        .select(*key, "_pos", "_t.prev", "_t.token").withColumn("pair", F.concat_ws(" ", "prev", "token"))
    )

    pairs = materialize(occurrences.groupBy("pair", "prev", "token").agg(F.count("*").alias("n")), "pairs")
    distinct = materialize(pairs.groupBy("token").agg(F.sum("n").alias("n")), "terms")
    best = materialize(find(distinct.select("token")), "best")

    cuts = materialize(_cuts(distinct, best, dictionary, max_distance), "cuts")
    halves = cuts.select(F.explode(F.array("a", "b")).alias("token"))
    parts = materialize(halves.groupBy("token").agg(F.count("*").alias("n")), "halves")
    parts_best = materialize(find(parts.select("token")).join(parts, "token"), "parts")
    # Tables are written between joins, so that the shuffle files of one go before the next; what is not read any more goes too.
    halved = materialize(_halved(cuts, parts_best), "halved")
    for done in (cuts, parts, parts_best):
        discard(done)
    resolved = materialize(_resolve_terms(distinct, best, halved, bigrams, max_distance), "resolved")
    for done in (distinct, best, halved):
        discard(done)

    previous = resolved.select(F.col("token").alias("prev"), "n", F.col("resolved").alias("one"))
    current = resolved.select("token", "n", F.col("single").alias("two"), F.col("resolved").alias("own"))
    owned = materialize(lookup_join(pairs, current, "token", "n"), "owned")
    discard(pairs)
    decided = lookup_join(owned, previous, "prev", "n")
    rare = F.when(F.length("token") == 1, 1).otherwise(0)
    apart = F.col("one.distance") + F.coalesce("two.distance", F.lit(max_distance + 1))
    beside = decided = materialize(decided.withColumn("_merged", F.concat("prev", "token")), "beside")
    for done in (owned, resolved):
        discard(done)
    # Together they cost one edit more than the term they make, so at a distance of 1 apart only a term itself is
    # near enough, and at 0 nothing is.
    near = materialize(decided.where(apart > 1).select(F.col("_merged").alias("token")).distinct(), "near")
    terms = decided.where(apart == 1).select(F.col("_merged").alias("token")).distinct().join(near, "token", "left_anti")
    terms = terms.join(dictionary, F.col("token") == F.col("term")).select("token", "term", "cnt", F.lit(0).alias("distance"))
    wholes = materialize(terms.unionByName(find(near).select("token", "term", "cnt", "distance")), "wholes")
    decided = decided.join(_best_columns(wholes, "whole"), F.col("_merged") == F.col("_whole_token"), "left")
    expected = F.col("one.cnt") / F.lit(CORPUS_WORDS) * F.coalesce("two.cnt", rare)
    together = (F.col("whole.distance") + 1 < apart) | ((F.col("whole.distance") + 1 == apart) & (F.col("whole.cnt") > expected))
    table = decided.select(
        "pair", "n", F.coalesce((F.col("prev") != "") & together, F.lit(False)).alias("joins"),
        F.col("whole.term").alias("whole"), F.col("own.term").alias("own"),
    )
    table = materialize(table, "decided")
    for done in (beside, near, wholes):
        discard(done)
    marked = materialize(lookup_join(occurrences.select(*key, "_pos", "pair"), table, "pair", "n").drop("pair"), "marked")
    discard(table)

    # In a run of joinable neighbours every second one joins the term before it.
    within = Window.partitionBy(*key).orderBy("_pos")
    start = F.max(F.when(~F.col("joins"), F.col("_pos"))).over(within)
    folded = marked.withColumn("_joined", F.col("joins") & ((F.col("_pos") - start) % 2 == 1))
    taken = F.coalesce(F.lead("_joined").over(within), F.lit(False))
    words = folded.withColumn("_word", F.when(~taken, F.when(F.col("_joined"), F.col("whole")).otherwise(F.col("own"))))
    texts = words.groupBy(*key).agg(F.array_sort(F.collect_list(F.when(F.col("_word").isNotNull(), F.struct("_pos", "_word")))).alias("_w"))
    joined = texts.select(*key, F.array_join(F.transform("_w", lambda w: w["_word"]), " ").alias(output))
    empty = F.when(F.col(text).isNotNull(), F.lit(""))
    return df.join(joined, key, "left").withColumn(output, F.coalesce(output, empty))
