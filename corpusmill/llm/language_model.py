"""Scores of texts under an n-gram model kept as a weighted automaton with failure arcs.

Words are counted over all training texts. An n-gram is in the model if it occurs LEAST times, whatever the size of
the corpus; the model's n-grams, their counts and back-off weights are written tables that grow with it.
Probabilities are discounted counts; what the discount frees goes to the shorter context.

In the automaton a state is a context, an arc a word with its log-probability, and the failure arc of a state
leads to the next shorter context at the cost of its back-off weight. No task holds the whole automaton: texts
are dealt to parts, each part asks for its distinct n-grams and gets the states and arcs that its texts can take, and
each text is read along these from left to right, all positions of a part at once. The log-probability of an arc
follows from the counts of its n-gram and of the state it leaves, both of which the part has. Every word has its
smoothed share of the tokens, by exact counts.

N-grams travel as sorted arrays of numbers, one for each bucket, a range of their hashes; the number of buckets grows with
the tokens, so that a bucket is about as large in every corpus. Orders are counted one by one in passes over
classes of the hash, and parts are scored in slices. The shuffle files of a pass or slice go as it ends, so the
disk in use is bounded by a share of the corpus. Neither number changes a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.linear import held_out
from corpusmill.llm.words import Words, find_words, mix, slices, string_column
from corpusmill.session import discard, materialize

ORDER = 3
# An n-gram of two and more words that occurs so often is in the model, at every size of the corpus.
LEAST = 2
DISCOUNT = 0.5
SMOOTHING = 0.5

END = np.uint64(0xE4D0F7E87)
START = np.uint64(0x51A27C0FFEE)  # the context before the first word; it is never predicted
# Texts are read in parts of about this many bytes; a longer text is a part of its own.
PART_BYTES = 1 << 21
# Training tokens for each bucket of n-grams.
BUCKET_TOKENS = 1 << 20
# The most slices of the parts; a small corpus needs fewer.
SLICES = 5
SLICE_TOKENS = 1 << 21


class Tally:
    """Counts of 64-bit keys, added up in a task before they are shuffled; handed over at a million keys."""

    LIMIT = 1 << 20

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if not len(keys):
            return
        found = np.unique(keys, return_counts=True)
        self.parts.append(found)
        self.size += len(found[0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(counts, first)

    def batches(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.parts or (self.size < 4 * self.LIMIT and not last):
            return
        keys, counts = self.merged()
        if len(keys) < self.LIMIT and not last:
            self.parts, self.size = [(keys, counts)], len(keys)
            return
        for low in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[low:low + (1 << 16)].view(np.int64)), pa.array(counts[low:low + (1 << 16)].astype(np.int64))], names=["gram", "n"])
        self.parts, self.size = [], 0


def count(texts: DataFrame, keys_of: Callable[[Words], np.ndarray]) -> DataFrame:
    """(gram, n) over all rows (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for part in slices(batch):
                tally.add(keys_of(find_words(part.column(0), lower=True)))
                yield from tally.batches(False)
        yield from tally.batches(True)

    return texts.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def token_hashes(words: Words) -> np.ndarray:
    return np.concatenate([words.hashes, np.full(words.n_texts, END)])


def sequences(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, bounds): START, the words and END of each text."""
    bounds = words.bounds + 2 * np.arange(words.n_texts + 1)
    tokens = np.empty(bounds[-1], np.uint64)
    tokens[np.arange(len(words.start)) + 2 * words.text_of + 1] = words.hashes
    tokens[bounds[:-1]] = START
    tokens[bounds[1:] - 1] = END
    return tokens, bounds


def join_keys(before: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The number of an n-gram from those of the n-grams without its last and without its first word."""
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0xD6E8FEB86659FD93) + suffix)


def gram_keys(words: Words, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(numbers of the n-grams of 1 to `order` words that end at each position, place of each position in its text, bounds)."""
    tokens, bounds = sequences(words)
    place = np.arange(len(tokens)) - np.repeat(bounds[:-1], np.diff(bounds))
    keys = [tokens]
    for _ in range(2, order + 1):
        longer = np.zeros_like(tokens)
        longer[1:] = join_keys(keys[-1][:-1], keys[-1][1:])
        keys.append(longer)
    return keys, place, bounds


def pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values), codec="zstd", asbytes=True)


def unpack(blob: bytes, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, decompressed_size=8 * n, codec="zstd"), kind)


def numbers(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The 64-bit numbers that each row of a binary column holds."""
    return [np.frombuffer(b, np.uint64) for b in column.to_pylist()]


def joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def bucket_runs(grams: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, low, high) of each run of sorted n-grams; a bucket is a range of their numbers, so no sort is needed."""
    bucket = ((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = [*np.flatnonzero(np.concatenate([bucket[:1] == bucket[:1], bucket[1:] != bucket[:-1]])).tolist(), len(bucket)]
    return [(int(bucket[low]), low, high) for low, high in zip(edges, edges[1:])]


class GramTally:
    """Counts of n-grams of one order with their two shorter parts, added up in a task before they are shuffled."""

    LIMIT = 1 << 19

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, gram: np.ndarray, before: np.ndarray, suffix: np.ndarray) -> None:
        self.parts.append((gram, before, suffix, np.ones(len(gram), np.int64)))
        self.size += len(gram)

    def batches(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.size or (self.size < 4 * self.LIMIT and not last):
            return
        gram, before, suffix, n = merge_counts(self.parts)
        if len(gram) < self.LIMIT and not last:
            self.parts, self.size = [(gram, before, suffix, n)], len(gram)
            return
        runs = bucket_runs(gram, self.buckets)
        for at in range(0, len(runs), 1 << 8):
            some = runs[at:at + (1 << 8)]
            yield pa.RecordBatch.from_arrays([
                pa.array([b for b, _, _ in some], pa.int64()), pa.array([before[low:high].tobytes() for _, low, high in some], pa.binary()),
                pa.array([suffix[low:high].tobytes() for _, low, high in some], pa.binary()), pa.array([pack(n[low:high]) for _, low, high in some], pa.binary()),
            ], names=["bucket", "before", "suffix", "n"])
        self.parts, self.size = [], 0


def merge_counts(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(gram, before, suffix, n) of each n-gram once, by number."""
    gram, before, suffix, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(gram)
    gram = gram[order]
    first = np.flatnonzero(np.concatenate([gram[:1] == gram[:1], gram[1:] != gram[:-1]]))
    at = order[first]
    return gram[first], before[at], suffix[at], np.add.reduceat(n[order], first) if len(first) else n


def count_grams(texts: DataFrame, length: int, least: int, buckets: int, passes: int, turn: int) -> DataFrame:
    """(gram, before, suffix, n) of the n-grams of `length` words in pass `turn` that occur at least `least` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = GramTally(buckets)
        for batch in batches:
            for part in slices(batch):
                keys, place, _ = gram_keys(find_words(part.column(0), lower=True), length)
                at = np.flatnonzero((place >= length - 1) & (keys[-1] % np.uint64(passes) == turn))
                tally.add(keys[-1][at], keys[-2][at - 1], keys[-2][at])
                yield from tally.batches(False)
        yield from tally.batches(True)

    def add_up(rows: pa.Table) -> pa.Table:
        before, suffix = numbers(rows.column("before")), numbers(rows.column("suffix"))
        n = [unpack(b, len(x), np.int64) for b, x in zip(rows.column("n").to_pylist(), before, strict=True)]
        gram, before, suffix, n = merge_counts([(join_keys(b, s), b, s, c) for b, s, c in zip(before, suffix, n, strict=True)])
        kept = n >= least
        return pa.table({"gram": gram[kept].view(np.int64), "before": before[kept].view(np.int64), "suffix": suffix[kept].view(np.int64), "n": n[kept]})

    counted = texts.select("text").mapInArrow(run, "bucket bigint, before binary, suffix binary, n binary")
    return counted.groupBy("bucket").applyInArrow(add_up, "gram bigint, before bigint, suffix bigint, n bigint")


def pack_nodes(nodes: DataFrame, buckets: int) -> DataFrame:
    """(bucket, grams, n, back): the rows (gram, n, back) as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            grams, n, back = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(grams)
            grams, n, back = grams[order], n[order], back[order]
            runs = bucket_runs(grams, buckets)
            for at in range(0, len(runs), 1 << 8):
                some = runs[at:at + (1 << 8)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([b for b, _, _ in some], pa.int64()), pa.array([grams[low:high].tobytes() for _, low, high in some], pa.binary()),
                    *(pa.array([pack(c[low:high]) for _, low, high in some], pa.binary()) for c in (n, back)),
                ], names=["bucket", "grams", "n", "back"])

        for batch in batches:
            held.append((np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1)), np.asarray(batch.column(2).fill_null(0.0))))
            size += batch.num_rows
            if size >= 1 << 20:
                yield from emit()
                held, size = [], 0
        if size:
            yield from emit()

    return nodes.select("gram", "n", "back").mapInArrow(run, "bucket bigint, grams binary, n binary, back binary")


@dataclass
class Model:
    """Counts of the training texts, and (bucket, grams, n, back): how often each word and n-gram occurs, and the cost of its failure arc as a context."""

    tokens: int
    distinct: int
    nodes: DataFrame

    @property
    def denominator(self) -> float:
        return self.tokens + SMOOTHING * (self.distinct + 1)

    @property
    def buckets(self) -> int:
        return 1 + self.tokens // BUCKET_TOKENS

    def share(self, most: int) -> int:
        """Into how many passes or slices work is dealt."""
        return min(most, 1 + self.tokens // SLICE_TOKENS)


def train(texts: DataFrame, order: int = ORDER, least: int = LEAST) -> Model:
    """The model learned from the rows (text)."""
    words = materialize(count(texts, token_hashes), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct"), F.coalesce(F.max(F.when(F.col("gram") == int(END), F.col("n"))), F.lit(0)).alias("texts")).first()
    model = Model(total.tokens, total.distinct, words)
    # The context before the first word has a way back but no arc leads to it.
    start = words.sparkSession.range(1).select(F.lit(int(START)).alias("gram"), F.lit(total.texts).cast("bigint").alias("n"))
    contexts, shorter = words.unionByName(start), words.withColumn("p", (F.col("n") + SMOOTHING) / F.lit(model.denominator))
    nodes, spent = [], [words]
    freed = F.greatest((F.col("n") - F.col("arcs_n") + DISCOUNT * F.col("arcs")) / F.col("n"), F.lit(1e-12))
    for length in range(2, order + 1):
        passes = model.share(length - 1)  # longer n-grams repeat less, so there are more of them
        tables = [materialize(count_grams(texts, length, least, model.buckets, passes, turn), "grams") for turn in range(passes)]
        grams = tables[0]
        for t in tables[1:]:
            grams = grams.unionByName(t)
        # An n-gram that occurs `least` times has parts that do, so neither join loses one.
        arcs = (
            grams.join(shorter.select(F.col("gram").alias("suffix"), F.col("p").alias("q")), "suffix")
            .groupBy(F.col("before").alias("gram")).agg(F.sum("n").alias("arcs_n"), F.count("*").alias("arcs"), F.sum("q").alias("arcs_q"))
        )
        nodes.append(materialize(contexts.join(arcs, "gram", "left").select("gram", "n", F.log10(freed / F.greatest(1 - F.col("arcs_q"), F.lit(1e-12))).alias("back")), "nodes"))
        if length < order:
            of = contexts.select(F.col("gram").alias("before"), F.col("n").alias("of"))
            longer = materialize(grams.join(of, "before").select("gram", "n", ((F.col("n") - DISCOUNT) / F.col("of")).alias("p")), "arcs")
            for t in [*spent, *tables]:
                discard(t)
            contexts, shorter, spent = longer.select("gram", "n"), longer, [longer]
        else:
            nodes.append(grams.select("gram", "n", F.lit(None).cast("double").alias("back")))
            spent += tables
    whole = nodes[0]
    for t in nodes[1:]:
        whole = whole.unionByName(t)
    model.nodes = materialize(pack_nodes(whole, model.buckets), "model")
    for t in [*spent, *nodes[:-1]]:
        discard(t)
    return model


class Automaton:
    """The states that a part of the texts can take, by the numbers of their n-grams: counts, and costs of the failure arcs."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, back: np.ndarray, denominator: float) -> None:
        sort = np.argsort(grams)
        self.grams, self.n, self.back, self.denominator = grams[sort], n[sort], back[sort], denominator

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count of each n-gram, 0 without an arc to it; cost of the failure arc from it, 0 if it is no context)."""
        if not len(self.grams):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys))
        place = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        same = self.grams[place] == keys
        return np.where(same, self.n[place], 0), np.where(same, self.back[place], 0.0)

    def read(self, keys: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log-probability in context, by itself, whether known) of each token; 0 for the start.

        The state before a token is its longest context. As long as this has no arc for the token, the failure
        arc leads to the next shorter one at its cost; a run of words that is no context costs nothing to leave.
        """
        found = [self.find(k) for k in keys]
        single = np.log10((found[0][0] + SMOOTHING) / self.denominator)
        total, waiting = np.zeros(len(place)), np.flatnonzero(place >= 1)
        for n in range(len(keys), 1, -1):
            deep = waiting[place[waiting] >= n - 1]
            seen = found[n - 1][0][deep]
            taken, left = deep[seen > 0], deep[seen == 0]
            total[taken] += np.log10((seen[seen > 0] - DISCOUNT) / found[n - 2][0][taken - 1])
            total[left] += found[n - 2][1][left - 1]
            waiting = np.concatenate([left, waiting[place[waiting] < n - 1]])
        total[waiting] += single[waiting]
        return total, np.where(place >= 1, single, 0.0), (place >= 1) & (found[0][0] > 0)


def _parts(rows: DataFrame) -> DataFrame:
    """part, doc_id, held_out, text: runs of rows with about PART_BYTES of text under one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for rows in slices(batch, most=PART_BYTES):
                if size + rows.column(2).nbytes > PART_BYTES:
                    part, size = part + 1, 0
                size += rows.column(2).nbytes
                yield pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, part)), rows.column(0), rows.column(1), rows.column(2).cast(pa.string())], names=["part", "doc_id", "held_out", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, f"part bigint, doc_id {kind}, held_out boolean, text string")


def _asked(parts: DataFrame, order: int, buckets: int) -> DataFrame:
    """(bucket, part, grams): the n-grams of each part; a part that is read in two batches may ask for one twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.asarray(batch.column(0))
            edges = [0, *(1 + np.flatnonzero(np.diff(part))).tolist(), len(part)] if len(part) else []
            for low, high in zip(edges, edges[1:]):
                keys, place, _ = gram_keys(find_words(string_column(batch.column(1).slice(low, high - low)), lower=True), order)
                grams = np.unique(np.concatenate([k[place >= n] for n, k in enumerate(keys)]))
                runs = bucket_runs(grams, buckets)
                for at in range(0, len(runs), 1 << 8):
                    some = runs[at:at + (1 << 8)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b for b, _, _ in some], pa.int64()), pa.array(np.full(len(some), part[low])), pa.array([grams[x:y].tobytes() for _, x, y in some], pa.binary()),
                    ], names=["bucket", "part", "grams"])

    return parts.select("part", "text").mapInArrow(run, "bucket bigint, part bigint, grams binary")


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """(part, grams, n, back): those of the n-grams that a part asks for that are in the model."""
    grams = numbers(known.column("grams"))
    n, back = (joined([unpack(b, len(g), kind) for b, g in zip(known.column(c).to_pylist(), grams, strict=True)], kind) for c, kind in (("n", np.int64), ("back", np.float64)))
    automaton = Automaton(joined(grams, np.uint64), n, back, 1.0)
    rows = []
    for part, keys in zip(asked.column("part").to_pylist(), numbers(asked.column("grams")), strict=True):
        n, back = automaton.find(keys)
        has = n > 0
        if has.any():
            rows.append((part, keys[has].tobytes(), pack(n[has]), pack(back[has])))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["part", "grams", "n", "back"])


def _read_texts(rows: DataFrame, model: Model, order: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score."""
    n_slices = model.share(SLICES)
    # The number of a part is fixed by being written; it is used only from the written table.
    parts = materialize(_parts(rows).withColumn("slice", F.pmod(F.xxhash64("part"), F.lit(n_slices)).cast("int")).sortWithinPartitions("slice", "part"), "parts", "slice")
    denominator = model.denominator

    def run(texts: pa.Table, states: pa.Table) -> pa.Table:
        grams = numbers(states.column("grams"))
        n, back = (joined([unpack(b, len(g), kind) for b, g in zip(states.column(c).to_pylist(), grams, strict=True)], kind) for c, kind in (("n", np.int64), ("back", np.float64)))
        automaton = Automaton(joined(grams, np.uint64), n, back, denominator)
        words = find_words(string_column(texts.column("text").combine_chunks()), lower=True)
        keys, place, bounds = gram_keys(words, order)
        total, single, known = automaton.read(keys, place)
        text_of = np.repeat(np.arange(words.n_texts), np.diff(bounds))
        sums = [np.bincount(text_of, weights=v, minlength=words.n_texts) for v in (known, single, total)]
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": pa.array((words.counts + 1).astype(np.int64)),
            "n_known": pa.array(sums[0].astype(np.int64)), "base_score": pa.array(sums[1]), "score": pa.array(sums[2]),
        })

    kind = rows.schema["doc_id"].dataType.simpleString()
    scores = None
    for s in range(n_slices):
        mine = parts.where(F.col("slice") == s).drop("slice")
        states = _asked(mine, order, model.buckets).groupBy("bucket").cogroup(model.nodes.groupBy("bucket")).applyInArrow(_answer, "part bigint, grams binary, n binary, back binary")
        read = materialize(mine.groupBy("part").cogroup(states.groupBy("part")).applyInArrow(
            run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
        ), "scores")
        scores = read if scores is None else scores.unionByName(read)
    for t in (parts, model.nodes):
        discard(t)
    return scores


def score_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, order: int = ORDER, least: int = LEAST, remainder: int = 1
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of `docs`.

    The model learns from the rows outside the fold `remainder`. A-Z are lower-cased; the end of a text is a
    token. base_score takes each token by itself, score in its context. Null and empty texts are their end
    alone; rows without id are learned from; repeated rows count and are scored each; texts of any length are read whole, each
    in one part; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key, remainder).alias("held_out"), F.col(text).alias("text"))
    model = train(rows.where("NOT held_out"), order, least)
    return _read_texts(rows, model, order).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


__all__ = ["Automaton", "Model", "score_texts", "train"]
