"""Encoding of tokenised texts with a learned vocabulary."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from operator import length_hint

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.hotkeys import lookup_join
from corpusmill.operators.segment import SEGMENTERS, byte_pairs, draws_of, reader
from corpusmill.operators.vocab import Vocabulary
from corpusmill.session import materialize

# A vocabulary sent to every task has at most this many table rows (tokens and merges).
BROADCAST_ROWS = 400_000
# Draws of a block (`draws_of`), and cuts that a task remembers.
DRAWS_AT_ONCE = 8
REMEMBERED = 200_000
# Kinds that look up a word as it is and no part of it.
WHOLE_WORDS = {"word_level"}


def _entries(v: Vocabulary) -> DataFrame:
    """Tokens and merges in one table, under the text they cover in a word."""
    prefix = v.params.get("continuing_subword_prefix") or ""
    suffix = v.params.get("end_of_word_suffix") or ""

    def covered(token: Column) -> Column:
        if prefix:
            token = F.when(token.startswith(prefix), F.substring(token, len(prefix) + 1, 2**31 - 1)).otherwise(token)
        if suffix:
            token = F.when(token.endswith(suffix), F.substr(token, F.lit(1), F.length(token) - len(suffix))).otherwise(token)
        return token

    none = F.lit(None)
    tokens = v.vocab.select(
        covered(F.col("token")).alias("key"), "token", "id", "score",
        none.cast("string").alias("left"), none.cast("string").alias("right"), none.cast("int").alias("rank"),
    )
    merges = v.merges.select(
        F.concat(covered(F.col("left")), covered(F.col("right"))).alias("key"),
        none.cast("string").alias("token"), none.cast("int").alias("id"), none.cast("double").alias("score"),
        "left", "right", "rank",
    )
    return tokens.unionByName(merges)


def _lookups(entries: list) -> tuple[dict, dict]:
    pieces = {e["token"]: (e["id"], e["score"]) for e in entries if e["token"] is not None}
    ranks = {(e["left"], e["right"]): e["rank"] for e in entries if e["rank"] is not None}
    return pieces, ranks


def _constants(v: Vocabulary, options: dict) -> dict:
    """Single values of the vocabulary that every segmenter may need."""
    unk = v.params.get("unk_token")
    row = v.vocab.agg(
        F.max(F.length("token")).alias("longest"), F.min("score").alias("lowest"),
        F.max(F.when(F.col("token") == F.lit(unk), F.col("id"))).alias("unk_id"),
    ).first()
    return {**v.params, "longest": row["longest"] or 0, "lowest": row["lowest"] or 0.0, "unk_id": row["unk_id"], **options}


def encode(df: DataFrame, tokens: str, v: Vocabulary, **options) -> DataFrame:
    """Adds `ids`: the ids of all words of the array column `tokens`, in order.

    The vocabulary, whose size is a parameter of its training, goes to every task and the texts are not
    shuffled. One of more than BROADCAST_ROWS rows is refused: `encode_by_join` is the plan for it.
    """
    constants = _constants(v, options)
    found = _entries(v).limit(BROADCAST_ROWS + 1).collect()
    if len(found) > BROADCAST_ROWS:
        raise ValueError(f"a vocabulary of more than {BROADCAST_ROWS} rows needs encode_by_join")
    return df.withColumn("ids", _encode_in_tasks(df, v.kind, found, constants)(F.col(tokens)))


def encode_with_dropout(df: DataFrame, tokens: str, v: Vocabulary, key: list[str], dropout: float, seed: int = 0, **options) -> DataFrame:
    """`encode` for byte pairs where each merge that is next is passed over with probability `dropout` until another was made.

    Draws are hashes of the seed, the columns `key` and the place of a word, so partitions, retries and reruns change
    nothing, and rows with one key and equal words are cut up alike. With 0 it is `encode`, with 1 there are no merges.
    """
    if v.kind != "bpe":
        raise ValueError("only byte pairs have merges to pass over")
    if not 0.0 <= dropout <= 1.0:
        raise ValueError("dropout is a probability")
    constants = _constants(v, options)
    found = _entries(v).limit(BROADCAST_ROWS + 1).collect()
    if len(found) > BROADCAST_ROWS:
        raise ValueError(f"a vocabulary of more than {BROADCAST_ROWS} rows is not sent to every task")
    shared = df.sparkSession.sparkContext.broadcast(_lookups(found))

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pieces, ranks = shared.value
        known: dict[tuple[str, int], list[int] | None] = {}
        needed: dict[str, int] = {}

        def cut_by(word: str, draws: Iterator[float]) -> list[int]:
            return byte_pairs(word, pieces, ranks, **constants, dropout=dropout, draws=draws)

        def cut_for(word: str, mask: int) -> list[int] | None:
            """The cut if the first draws are those of the mask, null if these do not decide it."""
            if (word, mask) in known:
                return known[word, mask]
            try:
                cut = cut_by(word, iter([-1.0 if mask >> (DRAWS_AT_ONCE - 1 - i) & 1 else 2.0 for i in range(DRAWS_AT_ONCE)]))
            except StopIteration:
                cut = None
            if len(known) < REMEMBERED:
                known[word, mask] = cut
            return cut

        def draws_for(word: str) -> int:
            """How many draws the word takes if none of them passes over a merge."""
            if word in needed:
                return needed[word]
            most = 3 * len(word) + 1
            left = iter([2.0] * most)
            cut = cut_by(word, left)
            taken = most - length_hint(left)
            if len(needed) < REMEMBERED:
                needed[word] = taken
                if taken <= DRAWS_AT_ONCE:
                    known[word, 0] = cut
            return taken

        for names, rows in batches:
            flat = rows.flatten().dictionary_encode()
            words = flat.dictionary.to_pylist()
            code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            draws = np.array([draws_for(w) for w in words], np.int64)
            mask = np.zeros(len(code), np.int64)
            lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            texts = names.to_pylist()
            for name, begin, end in zip(texts, (ends - lengths).tolist(), ends.tolist(), strict=True):
                places = np.flatnonzero(draws[code[begin:end]] > 0)
                if len(places):
                    mask[begin + places] = _draw_masks(seed, name, places.tolist(), dropout)
            # Where none of the draws that a word then takes passes over a merge, the others do not matter.
            mask[mask >> np.maximum(DRAWS_AT_ONCE - draws[code], 0) == 0] = 0
            # Words with the same draws are cut up once for a batch; a word whose first draws do not decide it, each time.
            both, of = np.unique(code * (1 << DRAWS_AT_ONCE) + mask, return_inverse=True)
            cut = [cut_for(words[b >> DRAWS_AT_ONCE], b & ((1 << DRAWS_AT_ONCE) - 1)) for b in both.tolist()]
            undecided = np.array([c is None for c in cut], bool)
            for at in np.flatnonzero(undecided[of]).tolist():
                row = int(np.searchsorted(ends, at, "right"))
                place = at - int(ends[row] - lengths[row])
                of[at] = len(cut)
                cut.append(cut_by(words[code[at]], draws_of(seed, texts[row], place)))
            yield _listed_ids(rows, [c or [] for c in cut], of)

    return df.withColumn("ids", ids_of(F.to_json(F.struct(*key)), F.col(tokens)))


def encode_by_join(df: DataFrame, tokens: str, v: Vocabulary, key: list[str], **options) -> DataFrame:
    """The same for a vocabulary of any size: the distinct words are cut up once by joins with it and joined back.

    `key` identifies a row.
    """
    return _encode_by_join(df, tokens, v.kind, _entries(v), _constants(v, options), key)


def _draw_masks(seed: int, name: str, places: list[int], dropout: float) -> np.ndarray:
    """For each place, which of the first block of its draws (`draws_of`) pass over a merge, as bits from the highest."""
    key = name.encode()
    blocks = b"".join([blake2b(b"%d:%d:0:%b" % (seed, place, key), digest_size=64).digest() for place in places])
    passed = np.frombuffer(blocks, ">u8").astype(np.uint64).reshape(-1, DRAWS_AT_ONCE) / 2.0**64 < dropout
    return np.packbits(passed, axis=1)[:, 0]


def _listed_ids(rows: pa.Array, cut: list[list[int]], of: np.ndarray) -> pa.Array:
    """The rows with each word replaced by the ids of its entry in `cut`; `of` has the entries of all words in order."""
    sizes = np.array([len(c) for c in cut], dtype=np.int64)
    values = np.fromiter((i for c in cut for i in c), dtype=np.int32, count=int(sizes.sum()))
    ends = np.cumsum(sizes[of])
    shift = (np.cumsum(sizes) - sizes)[of] - (ends - sizes[of])
    ids = values[np.arange(len(shift) and ends[-1]) + np.repeat(shift, sizes[of])]
    lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()), mask=rows.is_null())


def _encode_in_tasks(df: DataFrame, kind: str, entries: list, constants: dict):
    shared = df.sparkSession.sparkContext.broadcast(_lookups(entries))

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segment = reader(kind, *shared.value, **constants)
        for rows in batches:
            flat = rows.flatten().dictionary_encode()
            # Each distinct word of a batch is cut up once; the rest is index arithmetic.
            cut = [segment(w) for w in flat.dictionary.to_pylist()]
            yield _listed_ids(rows, cut, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64))

    return ids_of


def _encode_by_join(df: DataFrame, tokens: str, kind: str, entries: DataFrame, constants: dict, key: list[str]) -> DataFrame:
    occurrences = df.select(*key, F.posexplode(tokens).alias("_pos", "_word"))
    words = materialize(occurrences.groupBy("_word").agg(F.count("*").alias("_n")), "words")
    if kind in WHOLE_WORDS and not constants.get("continuing_subword_prefix") and not constants.get("end_of_word_suffix"):
        parts = words.where(F.length("_word") > 0).select("_word", F.col("_word").alias("key"))
    else:
        # All substrings up to the longest token, with how many words hold them.
        n, longest = F.length("_word"), constants["longest"]
        starts = words.select("_word", n.alias("_len"), F.explode(F.sequence(F.lit(1), n)).alias("_from")).where("_len > 0")
        sizes = F.sequence(F.lit(1), F.least(F.lit(longest), F.col("_len") - F.col("_from") + 1))
        parts = starts.select("_word", "_from", F.explode(sizes).alias("_size")).select(
            "_word", F.substr("_word", F.col("_from"), F.col("_size")).alias("key")
        ).distinct()
    known = entries.groupBy("key").agg(F.collect_list(F.struct("token", "id", "score", "left", "right", "rank")).alias("_entry"))
    weighted = materialize(
        known.join(parts.groupBy("key").agg(F.count("*").alias("_weight")), "key").select("key", "_weight", "_entry"), "pieces"
    )
    per_word = (
        lookup_join(parts, weighted, "key", "_weight").where(F.col("_entry").isNotNull())
        .groupBy("_word").agg(F.flatten(F.collect_list("_entry")).alias("_entries"))
    )
    segment = SEGMENTERS[kind]

    @F.pandas_udf("array<int>")
    def cut(words: pd.Series, entries: pd.Series) -> pd.Series:
        out = []
        for word, found in zip(words, entries):
            pieces, ranks = _lookups([] if found is None else list(found))
            out.append(segment(word, pieces, ranks, **constants))
        return pd.Series(out, dtype=object)

    table = words.join(per_word, "_word", "left").select("_word", "_n", cut("_word", "_entries").alias("_ids"))
    coded = lookup_join(occurrences, materialize(table, "encoded"), "_word", "_n")
    rebuilt = coded.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_ids"))).alias("_parts"))
    ids = F.flatten(F.transform("_parts", lambda p: p["_ids"]))
    empty = F.when(F.col(tokens).isNotNull(), F.array().cast("array<int>"))
    return df.join(rebuilt.select(*key, ids.alias("ids")), key, "left").withColumn("ids", F.coalesce("ids", empty))
