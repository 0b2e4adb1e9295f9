"""Similarity join of texts on the Jaccard similarity of their word n-grams, by chosen paths.

A text is the set of its five-word shingles (a shorter text is one shingle). Texts with equal sets are
collapsed first. The others are split recursively: in each run every set chooses some of its own shingles by a
hash of the bucket it is in, each with probability 1 / (threshold * size), and goes to one child bucket per
choice. Two similar sets share most shingles and so are likely to choose a common one, on the first level and
on every further one. A bucket that is small is compared as a whole; a larger one is split again, down to a
given depth. What is still large then (a big group of near copies, which no path can split) is compared in
blocks: pairs of blocks of bounded size, each a task of its own, so no bucket is cut off. Independent runs are
added until a pair at the threshold is found with the target recall.

Pairs are verified exactly on the whole sets. A pair that meets in several buckets counts in the smallest of
them only, so links need no global removal of repeated pairs, and no list of pairs is ever made: a comparison
hands over the links of each text and the components inside its bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.words import binary_rows, find_words, mix, ngram_hashes, slices
from corpusmill.session import materialize

SHINGLE = 5
# The threshold as a fraction, so that it is compared in whole numbers.
THRESHOLD = (4, 5)
RECALL = 0.999
DEPTH = 3
SMALL = 200
BLOCK = 1024
# Sizes of the pieces in which matrices are multiplied and reduced.
COLUMNS = 4096
ROWS = 256
# A set goes on only if it met others in at least so many first-level buckets, which the number of runs allows for;
# texts that share a line meet by chance once.
LEAST_MEETINGS = 2

_RUN = 0x2545F4914F6CDD1D
_MASK = (1 << 64) - 1


def runs_needed(threshold: float, recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold was together in a bucket of that depth with probability `recall`.

    The shingles that both sets choose are nearly Poisson with mean m = (shared / size) / threshold, so a
    common path of depth d survives with s(d) = 1 - exp(-m * s(d - 1)).
    """
    mean = 2 / (1 + threshold)
    survives = 1.0
    for _ in range(depth):
        survives = 1 - math.exp(-mean * survives)
    return math.ceil(math.log(1 - recall) / math.log(1 - survives))


def runs_for_all_sizes(threshold: float, recall: float, depth: int, least_meetings: int = LEAST_MEETINGS) -> int:
    """Runs after which any pair at the threshold was together at that depth, and met at least `least_meetings` times, with probability `recall`.

    For sets of equal size the mean of runs_needed is above 1; if one set is part of the other, it is 1, which is the
    least: `threshold` of the larger set is shared, and the larger set's choice is the narrower. The meetings of all
    runs that lead on to the depth and those that do not are then independent Poisson numbers.
    """
    leads_on = 1.0
    for _ in range(depth - 1):
        leads_on = 1 - math.exp(-leads_on)

    def poisson(n: int, mean: float) -> float:
        return math.exp(-mean) * mean**n / math.factorial(n)

    def lost(runs: int) -> float:
        on, off = runs * leads_on, runs * (1 - leads_on)
        return poisson(0, on) + sum(poisson(i, on) * poisson(j, off) for i in range(1, least_meetings) for j in range(least_meetings - i))

    runs = runs_needed(threshold, recall, depth)
    while lost(runs) > 1 - recall:
        runs += 1
    return runs


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of each text, sorted; a text of fewer than n words has one, without words none."""
    words = find_words(texts)
    hashes, text_of, counts = words.hashes, words.text_of, words.counts
    grams, first = ngram_hashes(hashes, text_of, n)
    owner = text_of[first]
    for m in range(1, n):  # whole texts of m words, told apart from runs of n by the seed
        short = np.flatnonzero(counts == m)
        if len(short):
            total = np.full(len(short), m * _RUN & _MASK, np.uint64)
            for k in range(m):
                total = mix(total + hashes[words.bounds[short] + k])
            grams, owner = np.concatenate([grams, total]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(words.n_texts + 1))


def choose(tokens: np.ndarray, owner: np.ndarray, sizes: np.ndarray, bucket: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(position, child bucket) of the tokens that sets choose: bucket[i] and sizes[i] belong to set i."""
    drawn = mix(tokens ^ mix(bucket)[owner])
    limit = np.minimum(float(1 << 64) / (threshold * np.maximum(sizes, 1)), float((1 << 64) - 2048)).astype(np.uint64)
    at = np.flatnonzero(drawn < limit[owner])
    return at, mix(drawn[at] + np.uint64(1))


def _sketches(docs: DataFrame, key: str, text: str, runs: int, threshold: float) -> DataFrame:
    """(doc_id, n, a, b, buckets): set size, a 128-bit sign of the set, and the first-level buckets of all runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                tokens, bounds = shingle_sets(part.column(1))
                sizes = np.diff(bounds)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                found = [choose(tokens, owner, sizes, np.full(len(sizes), (r + 1) * _RUN & _MASK, np.uint64), threshold) for r in range(runs)]
                who, bucket = owner[np.concatenate([f[0] for f in found])], np.concatenate([f[1] for f in found])
                order = np.lexsort((bucket, who))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(who[order], np.arange(len(sizes) + 1)).astype(np.int32)), pa.array(bucket[order].view(np.int64))
                )
                signs = [pa.array(sign) for sign in _signs(tokens, bounds)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes.astype(np.int64)), *signs, lists], names=["doc_id", "n", "a", "b", "buckets"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, a bigint, b bigint, buckets array<bigint>")


def _sets(rows: DataFrame) -> DataFrame:
    """(node, copies, tokens) from rows (text, node, copies): the shingle set as 64-bit numbers in one binary value.

    Rows whose text has another sign than the node are left out: several texts can share an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                tokens, bounds = shingle_sets(part.column(0))
                found = pa.RecordBatch.from_arrays([part.column(1), part.column(2), binary_rows(tokens, bounds).cast(pa.binary())], names=["node", "copies", "tokens"])
                yield found.filter(pa.array(_signs(tokens, bounds)[0] == np.asarray(part.column(1))))

    return rows.select("text", "node", "copies").mapInArrow(run, "node bigint, copies bigint, tokens binary")


def _signs(tokens: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two sums over each set that tell sets apart."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(t)]) for t in (tokens, mix(tokens))]
    return [(total[bounds[1:]] - total[bounds[:-1]]).view(np.int64) for total in sums]


def _children(rows: DataFrame, threshold: float) -> DataFrame:
    """(bucket, node) of the next level for rows (bucket, node, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                sets = [np.frombuffer(t, np.uint64) for t in part.column(2).to_pylist()]
                sizes = np.array([len(s) for s in sets])
                at, child = choose(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes, np.asarray(part.column(0)).view(np.uint64), threshold)
                owner = np.searchsorted(np.cumsum(sizes), at, side="right")
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), part.column(1).take(pa.array(owner))], names=["bucket", "node"])

    return rows.select("bucket", "node", "tokens").mapInArrow(run, "bucket bigint, node bigint").distinct()


def _with_size(rows: DataFrame) -> DataFrame:
    """(bucket, node, size) without the buckets of one set."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "bucket")


def in_common(n: int, owner: np.ndarray, column: np.ndarray, n_columns: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many columns each row in `one` has in common with each in `other`, as products of 0/1 matrices."""
    common = np.zeros((len(one), len(other)), np.float32)
    sides = []
    for rows in (one, other):
        place = np.full(n, -1)
        place[rows] = np.arange(len(rows))
        here = place[owner] >= 0
        sides.append((len(rows), place[owner[here]], column[here]))
    for low in range(0, n_columns, COLUMNS):
        parts = []
        for size, row, at in sides:
            inside = (at >= low) & (at < low + COLUMNS)
            has = np.zeros((size, min(COLUMNS, n_columns - low)), np.float32)
            has[row[inside], at[inside] - low] = 1
            parts.append(has)
        common += parts[0] @ parts[1].T
    return common


def shared_only(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, column, columns): the entries that occur in several rows, numbered."""
    owner = np.repeat(np.arange(len(values)), [len(v) for v in values])
    _, place, often = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    several = often[place] > 1
    return owner[several], (np.cumsum(often > 1) - 1)[place[several]], int((often > 1).sum())


def compare(
    ids: np.ndarray, weights: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], buckets: list[np.ndarray], bucket: int, threshold: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of each text of a bucket or of two of its blocks; links are counted for pairs that meet in no smaller bucket.

    `sides` tells which block a text is of. With two blocks only pairs across are compared, as the others
    are compared elsewhere. The root is the smallest id of the text's component in the comparison. Matrices
    have one row and one column per text of a block, so a comparison holds a few megabytes.
    """
    n, (over, under) = len(ids), threshold
    across = bool(sides.min() != sides.max())
    one, other = (np.flatnonzero(sides == sides.min()), np.flatnonzero(sides != sides.min())) if across else (np.arange(n), np.arange(n))
    sizes = np.array([len(s) for s in sets], np.float32)
    pairs = in_common(n, *shared_only(sets), one, other)
    pairs *= over + under
    pairs = pairs >= over * (sizes[one][:, None] + sizes[other][None, :])
    if not across:
        np.fill_diagonal(pairs, False)
    counted = pairs & (in_common(n, *shared_only([b[b < bucket] for b in buckets]), one, other) == 0)
    links, root = np.zeros(n), ids.copy()
    most = np.iinfo(np.int64).max
    views = [(one, other, pairs, counted)] + [(other, one, pairs.T, counted.T)] * across
    for rows, columns, _, count in views:
        for low in range(0, len(rows), ROWS):
            links[rows[low:low + ROWS]] += count[low:low + ROWS].astype(float) @ weights[columns]
    while True:
        nearer = root.copy()
        for rows, columns, pair, _ in views:
            for low in range(0, len(rows), ROWS):
                part = rows[low:low + ROWS]
                nearer[part] = np.minimum(nearer[part], np.where(pair[low:low + ROWS], root[columns][None, :], most).min(axis=1, initial=most))
        if (nearer == root).all():
            return links.astype(np.int64), root
        root = nearer


def _compare_all(rows: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(node, links, root) from rows (bucket, low, high, side, node, copies, buckets, tokens) that stand together by comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []

        def finish() -> pa.RecordBatch:
            ids = np.array([r["node"] for r in waiting])
            links, root = compare(
                ids, np.array([r["copies"] for r in waiting]), np.array([r["side"] for r in waiting]), [np.frombuffer(r["tokens"], np.uint64) for r in waiting],
                [np.array(r["buckets"]) for r in waiting], waiting[0]["bucket"], threshold,
            )
            some = (links > 0) | (root != ids)
            return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some])], names=["node", "links", "root"])

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                for row in batch.slice(low, 256).to_pylist():
                    if waiting and any(row[c] != waiting[0][c] for c in ("bucket", "low", "high")):
                        yield finish()
                        waiting = []
                    waiting.append(row)
        if waiting:
            yield finish()

    return rows.mapInArrow(run, "node bigint, links bigint, root bigint")


def jaccard_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL,
    depth: int = DEPTH, small: int = SMALL, block: int = BLOCK,
) -> DataFrame:
    """doc_id, class_id, n_links for each row of `docs` with an id.

    class_id is the smallest id that can be reached by links; n_links counts the other rows whose shingle
    sets have at least the threshold's similarity. Null and texts without words have no shingles, no links and
    a class of their own; rows with one id are rows like others, but share its class if they are alike; rows
    without id are left out; an empty table gives no rows; other columns are not read.
    """
    share = threshold[0] / threshold[1]
    named = docs.where(F.col(key).isNotNull())
    sketches = materialize(_sketches(named, key, text, runs_for_all_sizes(share, recall, depth), share), "sketches")
    # One row per distinct set; the first of its two signs names it from here on.
    kinds = materialize(
        sketches.where("n > 0").groupBy("n", "a", "b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min("buckets").alias("buckets")), "kinds"
    )

    met = _with_size(kinds.select(F.explode("buckets").alias("bucket"), F.col("a").alias("node"))).drop("size")
    often = met.groupBy("node").agg(F.count("*").alias("times")).where(F.col("times") >= LEAST_MEETINGS).select("node")
    rows = materialize(_with_size(met.join(often, "node")), "level")
    wanted = kinds.select(F.col("a").alias("node"), F.col("rep").alias("doc_id"), "copies").join(rows.select("node").distinct(), "node", "left_semi")
    texts = named.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sets = materialize(_sets(texts.join(wanted, "doc_id").distinct()), "sets")

    leaves = [rows.where(F.col("size") <= small)]
    large = rows.where(F.col("size") > small)
    for level in range(2, depth + 1):
        if large.isEmpty():
            break
        rows = materialize(_with_size(_children(large.join(sets, "node"), share)), "level")
        leaves.append(rows if level == depth else rows.where(F.col("size") <= small))
        large = rows.where(F.col("size") > small)
    leaf = reduce(DataFrame.union, [part.select("bucket", "node") for part in leaves])

    # Of buckets with the same members one is enough.
    members_of = leaf.groupBy("bucket").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(3))).alias("t"))
    kept = members_of.groupBy("size", "s", "t").agg(F.min("bucket").alias("bucket")).select("bucket", "size")
    members = materialize(leaf.join(kept, "bucket"), "members")
    of_node = members.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))

    own = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")
    placed = (
        members.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), F.col("own").alias("side"), "node")
    )
    payload = placed.join(of_node, "node").join(sets, "node")
    together = payload.select("bucket", "low", "high", "side", "node", "copies", "buckets", "tokens").repartition("bucket", "low", "high")
    found = materialize(_compare_all(together.sortWithinPartitions("bucket", "low", "high", "node"), threshold), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked_nodes = links.join(components(found.select("node", "root"), "node", "root"), "node", "full").withColumnRenamed("node", "a")
    grouped = kinds.select("n", "a", "b", "rep", "copies").join(linked_nodes, "a", "left").withColumn("group", F.coalesce("component", "a"))
    first = grouped.groupBy("group").agg(F.min("rep").alias("class_id"))
    classes = grouped.join(first, "group").select("n", "a", "b", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return sketches.select("doc_id", "n", "a", "b").join(classes, ["n", "a", "b"], "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )
