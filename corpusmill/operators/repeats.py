"""Maximal repeats of a table of words, from suffixes sorted by Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialize

ROWS_PER_BATCH = 10_000
# A class is the least and the greatest neighbour on one side, where "" stands for an end of a word. All places
# have the same neighbour if both are the same character.
NODE_SCHEMA = (
    "piece string, freq bigint, left_low string, left_high string, right_low string, right_high string, open boolean"
)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS_PER_BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _cut_suffixes(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("suffix", pa.string()), ("left", pa.string()), ("cnt", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for word, cnt in zip(batch.column("word").to_pylist(), batch.column("cnt").to_pylist()):
                for start in range(len(word)):
                    yield word[start : start + size], word[start - 1] if start else "", cnt

    return lambda batches: _batches(rows(batches), schema)


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _nodes(longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The inner nodes of the trie of one range of sorted suffixes, and every start of its first and last suffix.

    An interval of suffixes with a common start is closed when a suffix without it comes. Only starts of the first and of
    the last suffix may go on in a neighbouring range; these are marked as open, with the sums over this range.
    """
    schema = pa.schema(
        [("piece", pa.string()), ("freq", pa.int64())]
        + [(n, pa.string()) for n in ("left_low", "left_high", "right_low", "right_high")] + [("open", pa.bool_())]
    )

    def add(sums: list, more: list) -> None:
        sums[1] += more[1]
        sums[2], sums[3] = min(sums[2], more[2]), max(sums[3], more[3])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        first: str | None = None
        previous, shared = "", 0
        # Open intervals on the previous suffix, shallow first: depth, freq, least and greatest left neighbour.
        stack: list[list] = []
        # The same for each start of the first suffix, with the neighbours to the right.
        heads: list[list] = []
        for batch in batches:
            for suffix, freq, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if first is None:
                    first, shared = suffix, len(suffix)
                    heads = [[d, 0, low, high, None, None] for d in range(len(suffix) + 1)]
                else:
                    common = _common(previous, suffix)
                    while stack and stack[-1][0] > common:
                        top = stack.pop()
                        if shared < top[0] <= longest and top[0] > 1 and top[1] > 1 and (top[2] != top[3] or not top[2]):
                            yield previous[: top[0]], top[1], top[2], top[3], "", "", False
                        if stack and stack[-1][0] >= common:
                            add(stack[-1], top)
                        elif common:
                            stack.append([common, *top[1:]])
                    shared = min(shared, common)
                own = [len(suffix), freq, low, high]
                stack.append(own)
                for d in range(1, shared + 1):
                    head, right = heads[d], suffix[d : d + 1]
                    add(head, own)
                    head[4] = right if head[4] is None else min(head[4], right)
                    head[5] = right if head[5] is None else max(head[5], right)
                previous = suffix
        for head in heads[1:]:
            if head[0] <= longest:
                yield first[: head[0]], *head[1:], True
        while stack:
            top = stack.pop()
            above = stack[-1][0] if stack else 0
            for d in range(max(above, shared) + 1, top[0] + 1):
                if d <= longest:
                    right = "" if d == top[0] else previous[d]
                    yield previous[:d], *top[1:], right, right, True
            if stack:
                add(stack[-1], top)

    return lambda batches: _batches(rows(batches), schema)


def maximal_repeats(counts: DataFrame, longest: int) -> DataFrame:
    """(piece, freq): substrings of two to `longest` characters that occur twice or more and whose every extension is rarer.

    `counts` is (word, cnt); a place counts as often as its word, and what stands at an end of a word has no extension there.
    The suffixes are cut behind the character after the longest piece, counted, and sorted in ranges: no suffix is in two
    rows, so a frequent start costs its distinct suffixes and may lie in several ranges. Null and empty words have no suffix.
    """
    words = counts.select("word", "cnt").where(F.length("word") > 0)
    cut = words.mapInArrow(_cut_suffixes(longest + 1), "suffix string, left string, cnt bigint")
    suffixes = cut.groupBy("suffix").agg(F.sum("cnt").alias("freq"), F.min("left").alias("low"), F.max("left").alias("high"))
    ordered = suffixes.repartitionByRange("suffix").sortWithinPartitions("suffix")
    nodes = materialize(ordered.mapInArrow(_nodes(longest), NODE_SCHEMA), "repeats")
    # At most two starts of each length per range are open.
    joined = nodes.where("open").groupBy("piece").agg(
        F.sum("freq").alias("freq"), *[F.min(c).alias(c) for c in ("left_low", "right_low")], *[F.max(c).alias(c) for c in ("left_high", "right_high")]
    )
    several = " AND ".join(f"({s}_low <> {s}_high OR {s}_low = '')" for s in ("left", "right"))
    whole = joined.where(several).where((F.length("piece") > 1) & (F.col("freq") > 1))
    return nodes.where("NOT open").select("piece", "freq").unionByName(whole.select("piece", "freq"))
