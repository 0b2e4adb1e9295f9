"""Nearest neighbours by vantage-point trees, one per shard of the vectors.

Vectors are scaled to length one, so that a larger cosine is a smaller distance and the triangle inequality
holds. A node of a tree has a vantage point and keeps, for each half of the other points, the range of their
distances to it; a half is passed over if no point in that range can be nearer than the worst of the nearest
found so far. The pruning factor multiplies that lower bound: 1 is exact, more prunes more and may miss some. Distances
only decide what is looked at; the order of what is found is that of the exact cosines of the original vectors, then of the ids, so
ties are complete: a half that could hold a point as near as the last one found is visited.

How much is passed over depends on the vectors. Where they form groups, most of a shard is; where they are spread evenly over many
dimensions, as random ones are, the nearest is hardly nearer than the rest, no bound can tell them apart, and factor 1 compares nearly all.

Shards are dealt by a hash of the id and hold a bounded number of vectors; queries come in blocks. Every block
meets every shard in a task of its own, and the best of all shards are merged per query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import materialize

SHARD_ROWS = 16_384
QUERY_ROWS = 4_096
LEAF = 96
# Distances are compared with this slack, well above rounding and below any real difference.
SLACK = 1e-9


@dataclass
class Node:
    vantage: int
    halves: list[tuple[float, float, "Node | np.ndarray"]]


class VantageTree:
    """A tree over the rows of `points` (length one)."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray) -> Node | np.ndarray:
        if len(rows) <= LEAF:
            return rows
        # The point farthest from an arbitrary one lies at the rim, where distances spread most.
        start = self.points[rows[len(rows) // 2]]
        vantage = int(rows[np.argmin(self.points[rows] @ start)])
        rest = rows[rows != vantage]
        away = distances(self.points[rest], self.points[vantage][None])[:, 0]
        order = np.argsort(away, kind="stable")
        middle = len(order) // 2
        halves = [(float(away[part[0]]), float(away[part[-1]]), self._grow(rest[part])) for part in (order[:middle], order[middle:])]
        return Node(vantage, halves)

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0, score: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k nearest points of each query, -1 and infinity where there are fewer.

        `score` of numbers of queries and of points decides the order (larger first), by default the cosine; equal scores
        go to the smaller row. It must agree with the distances but for rounding.
        """
        self._q, self._factor = queries, factor
        self._score_of = score or (lambda asked, rows: np.einsum("ij,ij->i", queries[asked], self.points[rows]))
        self._rows = np.full((len(queries), k), -1)
        self._far = np.full((len(queries), k), np.inf)
        self._score = np.full((len(queries), k), -np.inf)
        self.n_compared = 0
        self._visit(self.root, np.arange(len(queries)))
        return self._rows, self._far

    def _offer(self, asked: np.ndarray, rows: np.ndarray, away: np.ndarray) -> None:
        self.n_compared += away.size
        k = self._rows.shape[1]
        limit = self._far[asked].max(axis=1)
        if away.shape[1] > k:
            limit = np.minimum(limit, np.partition(away, k - 1, axis=1)[:, k - 1])
        q, r = np.nonzero(away <= limit[:, None] + SLACK)
        if not len(q):
            return
        hit = np.unique(q)
        new = rows[r]
        place = np.concatenate([np.repeat(np.arange(len(hit)), k), np.searchsorted(hit, q)])
        all_rows = np.concatenate([self._rows[asked[hit]].ravel(), new])
        all_far = np.concatenate([self._far[asked[hit]].ravel(), away[q, r]])
        all_scores = np.concatenate([self._score[asked[hit]].ravel(), self._score_of(asked[q], new)])
        order = np.lexsort((all_rows, -all_scores, place))
        begin = np.searchsorted(place[order], np.arange(len(hit)))
        best = order[begin[:, None] + np.arange(k)]
        self._rows[asked[hit]], self._far[asked[hit]], self._score[asked[hit]] = all_rows[best], all_far[best], all_scores[best]

    def _visit(self, node: Node | np.ndarray, asked: np.ndarray) -> None:
        if not len(asked):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                self._offer(asked, node, distances(self._q[asked], self.points[node]))
            return
        away = distances(self._q[asked], self.points[node.vantage][None])
        self._offer(asked, np.array([node.vantage]), away)
        bounds = np.stack([np.maximum(np.maximum(low - away[:, 0], away[:, 0] - high), 0) for low, high, _ in node.halves])
        near = np.argmin(np.stack([np.abs(away[:, 0] - (low + high) / 2) for low, high, _ in node.halves]), axis=0)
        for turn in (0, 1):  # each query goes first to the half that is nearer to it
            for half, (_, _, child) in enumerate(node.halves):
                mine = (near == half) if turn == 0 else (near != half)
                go = mine & (bounds[half] * self._factor <= self._far[asked].max(axis=1) + SLACK)
                self._visit(child, asked[go])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten()
    return np.asarray(flat, np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, added up from the first component to the last."""
    total = lambda x: np.add.accumulate(x, axis=1)[:, -1]
    return total(a * b) / (np.sqrt(total(a * a)) * np.sqrt(total(b * b)))


def directions(vectors: np.ndarray) -> np.ndarray:
    """Vectors divided by a power of two, which leaves their cosines as they are to the last bit, so that multiples of that kind are equal.

    A vector that does not come back from it unchanged, as its components are too far apart, stays as it is.
    """
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    scaled = np.ldexp(vectors, -power[:, None])
    safe = (np.ldexp(scaled, power[:, None]) == vectors).all(axis=1)
    return np.where(safe[:, None], scaled, vectors)


def nearest_in_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, ...]:
    """(query id, id, score) of the k best of the shard for each query, the query's own id left out.

    Vectors of one direction are one point of the tree with its k + 1 smallest ids, which is all that a query can need; of
    points with equal scores those with the smaller least ids are found.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    _, first, group = np.unique(directions(vectors), axis=0, return_index=True, return_inverse=True)
    # Points in the order of their least ids, so that ties of points go the way of their ids.
    by_first = np.argsort(first)
    rank = np.empty_like(by_first)
    rank[by_first] = np.arange(len(by_first))
    first, group = first[by_first], rank[group.ravel()]
    by_group = np.argsort(group, kind="stable")
    size = np.bincount(group)
    offset = np.cumsum(size) - size
    unit = vectors[first] / np.linalg.norm(vectors[first], axis=1)[:, None]
    score_of = lambda asked, rows: exact_cosine(queries[asked], vectors[first[rows]])
    points, _ = VantageTree(unit).search(queries / np.linalg.norm(queries, axis=1)[:, None], min(k + 1, len(first)), factor, score_of)
    asked, point = np.nonzero(points >= 0)
    point = points[asked, point]
    members = np.minimum(size[point], k + 1)
    take = np.repeat(offset[point] - (np.cumsum(members) - members), members) + np.arange(members.sum())
    asked, row = np.repeat(asked, members), by_group[take]
    other = ids[row] != query_ids[asked]
    asked, row = asked[other], row[other]
    score = exact_cosine(queries[asked], vectors[row])
    order = np.lexsort((ids[row], -score, asked))
    asked, row, score = asked[order], row[order], score[order]
    rank = np.arange(len(asked)) - np.searchsorted(asked, asked)
    keep = rank < k
    return query_ids[asked[keep]], ids[row[keep]], score[keep]


def usable(vector: Column) -> Column:
    """True for vectors that have a direction: not null, no null or non-finite component, not all zero."""
    inner = vector.cast("array<double>")
    bad = F.exists(inner, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(inner, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, factor: float = 1.0, id_column: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest by cosine of each query among all other vectors.

    `is_query` is a condition on `id_column`. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do null ids. Of several vectors under one id the first in order counts.
    Vectors of different lengths never meet. Ties go to the smaller id, also among vectors that differ. With fewer than k others, all are
    returned; an empty table gives no rows; other columns are not read. Ids are whole numbers: text ids raise.
    """
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    clean = materialize(rows.where(F.col("id").isNotNull() & usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v")), "vectors")
    marked = clean.withColumn(id_column, F.col("id")).withColumn("asks", F.coalesce(is_query, F.lit(False)))
    n, n_queries = marked.agg(F.count("*"), F.count_if("asks")).first()
    n_shards, n_blocks = -(-n // shard_rows) or 1, -(-n_queries // query_rows) or 1
    everywhere = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    dim = F.size("v").alias("dim")
    index = marked.select("id", "v", dim, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_shards)).cast("int").alias("shard"), everywhere(n_blocks).alias("block"))
    queries = marked.where("asks").select("id", "v", dim, everywhere(n_shards).alias("shard"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_blocks)).cast("int").alias("block"))

    def search(points: pa.Table, wanted: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if len(points) and len(wanted):
            columns = [t.column(c).combine_chunks() for t in (points, wanted) for c in ("id", "v")]
            found = nearest_in_shard(np.asarray(columns[0]), matrix(columns[1]), np.asarray(columns[2]), matrix(columns[3]), k, factor)
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    by = ["dim", "shard", "block"]
    found = index.groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


__all__ = ["VantageTree", "exact_cosine", "nearest", "nearest_in_shard", "usable"]
