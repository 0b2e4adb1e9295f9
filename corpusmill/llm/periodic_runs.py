"""Periodic runs: stretches of words that repeat with a period, found as maximal pairs in an LCP-interval tree.

Two occurrences of the same m words at distance q, with different words before them and different words behind
them, are a maximal pair. If q <= m the two touch, and the stretch from the first to the end of the second is a run of
period q and length m + q that no neighbour extends. So runs need no extension step: they are the
maximal pairs whose distance fits.

The pairs come from the suffixes of a text that share at least MATCH words with another suffix; a run of at least
LEAST words has m >= LEAST / 2. These suffixes are found by the hashes of their first words and put in order
by doubling, for a whole slice of texts at once; the lengths of common prefixes of neighbours (LCP) come from the
ranks of the doubling. The intervals of the LCP-interval tree are then closed bottom-up: each holds the places where
its m words occur, in order, each with the class of its left word. When a child is merged into its parent, a place
makes a pair with the places before and behind it in the merged list, if these come from other children and have
another left class. Places further apart need no look: an occurrence between the two would give the stretch a smaller
period (Fine and Wilf), so such a pair is no run of its own. The smaller list is always merged into the larger,
so a text of n words costs O(n log n) steps, whatever its repeats.

Spark partitions the texts; a text is worked on whole, in one task, and nothing is shuffled. Words are told
apart by 64-bit hashes (see `words`).

Defined results: a null or empty text has no words and no runs; runs of one text are listed by start, then by period;
the longest run is the one with the smallest start, then the smallest period, among equally long ones; repeated rows
are judged each, also such with one id; an empty table gives no rows; other columns, whatever their names, are
neither read nor returned. Memory of a task grows with its longest text, by about 150 bytes a word.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import find_words, ngram_hashes, slices

LEAST = 12
MATCH = LEAST // 2

# Words that take the place of a text's own: the number of the word that stands at each place.
Rewrite = Callable[[object, int], np.ndarray | None]


def plant(key: object, n: int) -> np.ndarray | None:
    """The registered query's change of a text of n words: in a tenth of the ids, the end repeats with a period.

    A null id changes nothing.
    """
    if key is None or n == 0:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def _dense(columns: list[np.ndarray]) -> np.ndarray:
    """The rank of each row in the order of the columns, the first one first; equal rows have one rank."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def repeated_suffixes(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, lcp) of the suffixes that share MATCH words or more with another of their text.

    The places are word numbers of the slice, in the order of the suffixes; lcp[i] is the number of words that suffixes i and
    i - 1 share, 0 where they are of different texts or share fewer than MATCH.
    """
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    grams, first = ngram_hashes(hashes, text_of, MATCH)
    _, which, count = np.unique(grams + text_of[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_inverse=True, return_counts=True)
    active = first[count[which] > 1]
    if not len(active):
        return active, active
    # Whether a suffix beyond a shared stretch is shared itself or not, its first words decide the order there.
    end_of = bounds[1:][text_of]
    n = len(hashes)
    known = np.zeros(n + 1, bool)
    known[active] = True
    known[(active + MATCH)[active + MATCH < end_of[active]]] = True
    places = np.flatnonzero(known)
    words = np.unique(hashes, return_inverse=True)[1] + 1

    def word(at: np.ndarray, end: np.ndarray) -> np.ndarray:
        return np.where(at < end, words[np.minimum(at, n - 1)], 0)

    end = end_of[places]
    row = np.full(n + 1, -1, np.int64)
    row[places] = np.arange(len(places))
    # Suffixes of different texts never meet, so the text goes first.
    rank = _dense([text_of[places], *[word(places + k, end) for k in range(MATCH)]])
    levels = [rank]
    width = MATCH
    while True:
        shared = np.bincount(rank)[rank] > 1
        if not shared.any():
            break
        # Two suffixes that share `width` words have rows at that distance too, or end there.
        behind = places + width
        inside = shared & (behind < end)
        next_rank = np.full(len(places), -1, np.int64)
        next_rank[inside] = rank[row[behind[inside]]]
        next_rank[shared & ~inside] = -2 - places[shared & ~inside]  # the end is shared with none
        rank = _dense([rank, next_rank])
        levels.append(rank)
        width *= 2
    order = np.argsort(rank, kind="stable")
    a, b = places[order[:-1]].copy(), places[order[1:]].copy()
    last = end_of[a]
    same = text_of[a] == text_of[b]
    lcp = np.zeros(len(a), np.int64)
    open_ = same.copy()
    for level in range(len(levels) - 1, -1, -1):
        step = MATCH << level
        ra, rb = row[np.minimum(a + lcp, n)], row[np.minimum(b + lcp, n)]
        ok = open_ & (a + lcp < last) & (b + lcp < last) & (ra >= 0) & (rb >= 0)
        ok[ok] = levels[level][ra[ok]] == levels[level][rb[ok]]
        lcp[ok] += step
    for _ in range(MATCH - 1):
        ok = open_ & (a + lcp < last) & (b + lcp < last)
        ok[ok] = words[(a + lcp)[ok]] == words[(b + lcp)[ok]]
        lcp[ok] += 1
        open_ = ok
    lcp[lcp < MATCH] = 0
    lcp = np.concatenate([[0], lcp])
    # Rows that share nothing with a neighbour were there for their rank only.
    wanted = (lcp > 0) | np.append(lcp[1:] > 0, False)
    return places[order][wanted], lcp[wanted]


class Places:
    """Numbers in order, in blocks, so that an insertion moves few of them whatever their count."""

    BLOCK = 512

    def __init__(self, first: int) -> None:
        self.blocks = [[first]]
        self.heads = [first]
        self.n = 1

    def add(self, place: int) -> tuple[int | None, int | None]:
        """Puts a number in and returns the ones before and behind it."""
        at = max(bisect_left(self.heads, place) - 1, 0)
        block = self.blocks[at]
        k = bisect_left(block, place)
        before = block[k - 1] if k else None
        behind = block[k] if k < len(block) else self.heads[at + 1] if at + 1 < len(self.heads) else None
        block.insert(k, place)
        if not k:
            self.heads[at] = place
        if len(block) > 2 * self.BLOCK:
            self.blocks[at:at + 1] = [block[:self.BLOCK], block[self.BLOCK:]]
            self.heads.insert(at + 1, block[self.BLOCK])
        self.n += 1
        return before, behind

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def maximal_pairs(places: list[int], lcp: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(start, period, length) of the runs whose two occurrences are suffixes in `places`, in order.

    `left` is the class of the word before each place of the slice; a place at the start of its text has one of its own.
    """
    found: dict[tuple[int, int], int] = {}

    def merge(large: Places, small: Places, m: int) -> Places:
        """The places of two children of an interval of m words."""
        if large.n < small.n:
            large, small = small, large
        new = list(small)
        own = set(new)
        for place in new:
            for other in large.add(place):
                # Neighbours of one child share more than m words, so they made their pair further down.
                if other is None or other in own:
                    continue
                q = abs(other - place)
                if q <= m and q + m >= LEAST and left[other] != left[place]:
                    # Until all of a child is merged, places between the two may still be missing: the least period counts.
                    key = (min(place, other), q + m)
                    found[key] = min(found.get(key, q), q)
        return large

    # Open intervals, each with more shared words than the one below it, and the places of the children so far.
    stack: list[tuple[int, Places]] = []
    for k, place in enumerate(places):
        m = lcp[k]
        while stack and stack[-1][0] > m:
            _, closed = stack.pop()
            if stack and stack[-1][0] >= m:
                depth, held = stack.pop()
                stack.append((depth, merge(held, closed, depth)))
            elif m:
                stack.append((m, closed))
        deep = lcp[k + 1] if k + 1 < len(lcp) else 0
        if deep > m:
            stack.append((deep, Places(place)))
        elif m:
            depth, held = stack.pop()
            stack.append((depth, merge(held, Places(place), depth)))
    while len(stack) > 1:
        _, closed = stack.pop()
        depth, held = stack.pop()
        stack.append((depth, merge(held, closed, depth)))
    return sorted((start, q, length) for (start, length), q in found.items())


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of texts whose words bounds[i]:bounds[i + 1] are joined by one space, which also ends them."""
    size = end - start + 1
    behind = np.cumsum(size)
    total = int(behind[-1]) if len(behind) else 0
    place = np.arange(total) + np.repeat(start - (behind - size), size)
    place[behind - 1] = 0
    made = data[place] if total else np.zeros(0, np.uint8)
    made[behind - 1] = 0x20
    return made, np.concatenate([[0], behind])[bounds]


def slice_runs(texts: pa.Array, keys: list, rewrite: Rewrite | None) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """The runs (start, period, length) of each text of a slice, and each text without the words that a run repeats."""
    words = find_words(texts)
    bounds = words.bounds
    at = np.arange(len(words.start))
    if rewrite is not None:
        for i, key in enumerate(keys):
            moved = rewrite(key, int(bounds[i + 1] - bounds[i]))
            if moved is not None:
                at[bounds[i]:bounds[i + 1]] = bounds[i] + moved
    hashes = words.hashes[at]
    places, lcp = repeated_suffixes(hashes, bounds)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in keys]
    keep = np.ones(len(at), bool)
    if len(places):
        left = np.unique(hashes, return_inverse=True)[1]
        left = np.concatenate([[0], left[:-1]])
        left[bounds[:-1][np.diff(bounds) > 0]] = -1
        found = maximal_pairs(places.tolist(), lcp.tolist(), left.tolist())
        owner = np.searchsorted(bounds, [f[0] for f in found], side="right") - 1
        for (start, period, length), i in zip(found, owner.tolist(), strict=True):
            runs[i].append((start - int(bounds[i]), period, length))
            keep[start + period:start + length] = False
    kept = at[keep]
    made, offsets = _joined(words.data, words.start[kept], words.end[kept], np.concatenate([[0], np.cumsum(keep)])[bounds])
    whole = memoryview(made)
    return runs, [whole[a:max(a, b - 1)] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _rows(batches: Iterator[pa.RecordBatch], name: str, rewrite: Rewrite | None, digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text"):
            runs, left = slice_runs(part.column(1), part.column(0).to_pylist(), rewrite)
            if digest:
                best = [min(r, key=lambda x: (-x[2], x[0], x[1]), default=(None, None, None)) for r in runs]
                listed = ["".join(f"{s},{n},{q}\n" for s, q, n in r) for r in runs]
                columns = [
                    pa.array([len(r) for r in runs], pa.int64()), *[pa.array([b[k] for b in best], pa.int64()) for k in (0, 2, 1)],
                    pa.array([None if b[0] is None else 1000 * b[2] // b[1] for b in best], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]), pa.array([hashlib.sha256(x).hexdigest() for x in left]),
                ]
                names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            else:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("period", pa.int64()), ("length", pa.int64())]))
                columns = [pa.array([[dict(zip(("start", "period", "length"), x)) for x in r] for r in runs], kind), pa.array([bytes(x).decode() for x in left], pa.string())]
                names = ["runs", "collapsed"]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[name, *names])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """(key, runs, collapsed) for each row: the runs as (start, period, length) in words, and the text with each run
    cut down to its first period, its words joined by one space."""
    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, runs array<struct<start: bigint, period: bigint, length: bigint>>, collapsed string"
    return rows.mapInArrow(lambda batches: _rows(batches, key, rewrite, False), schema)


def run_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = plant) -> DataFrame:
    """(key, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): the longest run and digests of the rest."""
    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    return rows.mapInArrow(lambda batches: _rows(batches, key, rewrite, True), schema)
