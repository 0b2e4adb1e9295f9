import random
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.llm import mixing, vantage
from corpusmill.llm.queries import mix_documents

from .conftest import prose


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text("abcé😀", max_size=2)), st.integers(0, 1000), min_size=1, max_size=6))
def test_targets_share_the_budget_below_the_caps(sizes):
    targets = mixing.capped_targets(sizes)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(0 <= targets[s] <= 2 * n for s, n in sizes.items())
    names = sorted(sizes, key=mixing.source_order)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    free = {round(targets[s] / weight[s], 6) for s in names if targets[s] < 2 * sizes[s] - 1e-6}
    assert len(free) <= 1  # below the caps, targets are in proportion to the weights


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=3, max_size=3), st.lists(st.integers(0, 5), min_size=2, max_size=2))
def test_the_flow_is_the_cheapest_of_the_largest(words, quotas):
    """Patterns a, ab, b for sources a, b, against all ways to split."""
    patterns = [("a",), ("a", "b"), ("b",)]
    flow = mixing.cheapest_flow(dict(zip(patterns, words)), {"a": quotas[0], "b": quotas[1]}, 2)
    cost = lambda taken: sum(max(0, t - n) for t, n in zip(taken, words))
    best = None
    for a, to_a, to_b, b in product(*[range(2 * n + 1) for n in (words[0], words[1], words[1], words[2])]):
        if to_a + to_b <= 2 * words[1] and a + to_a <= quotas[0] and b + to_b <= quotas[1]:
            option = (-(a + to_a + to_b + b), cost((a, to_a + to_b, b)))
            best = option if best is None else min(best, option)
    taken = [flow[p] for p in patterns]
    assert (-sum(taken), cost(taken)) == best


def test_each_source_comes_near_its_target(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), prose(rng, rng.randrange(0, 60))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(7)
    mixed, sources = mix_documents(docs)
    taken, most = {}, {}
    for r in mixed.collect():
        assert r.taken in (0, r.size, 2 * r.size) and r.size == len(r.text.split())
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for r in sources.collect():
        assert abs(taken[r.mix_source] - r.target) <= 60, most
    again = {r.doc_id: r.taken for r in mix_documents(docs.repartition(3))[0].collect()}
    assert again == {r.doc_id: r.taken for r in mixed.collect()}


def test_overlapping_sources(spark):
    rng = random.Random(2)
    rows = [(i, ["web"] if i % 3 else ["web", "news"], prose(rng, 20)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, sources array<string>, text string")
    mixed, sizes, targets = mixing.mix_sources(docs, F.col("sources"), lambda s: {"web": 4000.0, "news": 3000.0})
    assert sizes == {"web": 6000, "news": 2000}
    found = {n: sum(r.taken for r in mixed.collect() if len(r.sources) == n) for n in (1, 2)}
    # News needs 3000 of the 2000 words of its documents; the web's own documents then serve the web.
    assert found == {1: 4000, 2: 3000}


def test_mixing_odd_and_empty_tables(odd_docs, no_docs):
    mixed, _ = mix_documents(odd_docs, size_name="n_size", taken_name="n_taken")
    assert mixed.columns == [*odd_docs.columns, "n_size", "n_taken"] and mixed.count() == odd_docs.count()
    assert all(r.n_taken in (0, r.n_size, 2 * r.n_size) for r in mixed.collect())
    assert mix_documents(no_docs)[0].collect() == []


# Vantage-point trees

def brute_nearest(rows, k=5):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = []
    for q, v in rows:
        if q % 50 == 0:
            scored = sorted((-float(vantage.exact_cosine(v[None], w[None])[0]), i) for i, w in rows if i != q and len(w) == len(v))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def clustered(n, seed, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    return [(i, (centres[rng.integers(20)] + 0.4 * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def test_factor_one_is_exact_over_shards_and_blocks(spark):
    rows = clustered(900, 1)
    rows += [(1000 + i, rows[50][1]) for i in range(30)] + [(2000, [1.0, 2.0]), (2050, [2.0, 1.0]), (2100, [4.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = vantage.nearest(frame, F.col("vec_id") % 50 == 0, shard_rows=200, query_rows=10)
    assert sorted(map(tuple, got.collect())) == brute_nearest(rows)


def test_ties_of_different_vectors_go_to_the_smaller_ids(spark):
    """Multiples by powers of two have equal cosines and are one direction; vectors in mirror image have equal cosines and are not."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=8).astype(np.float32)
    rows = [(i, (base * np.float32(2.0 ** (i % 11 - 5))).tolist()) for i in range(50)]
    rows += [(200 + i, (rng.normal(size=8)).astype(np.float32).tolist()) for i in range(60)]
    rows += [(300 + 50 * i, [1.0, 0, 0, 0, 0, 0, 0, 0]) for i in range(3)]
    # all of these are equally near to the three above
    rows += [(500 + i, [3.0, *[4.0 * s if j == i % 7 else 0.0 for j in range(7)]]) for i, s in enumerate(rng.permutation([1.0, -1.0] * 40).tolist())]
    rng.shuffle(rows)
    rows = [(int(i), list(map(float, v))) for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for shard_rows in (1000, 40):
        got = vantage.nearest(frame, F.col("vec_id") % 50 == 0, shard_rows=shard_rows)
        assert sorted(map(tuple, got.collect())) == brute_nearest(rows)


def test_directions_are_exact():
    vectors = np.array([[3.0, 1.0], [6.0, 2.0], [0.75, 0.25], [9.0, 3.0], [1e300, 1e-300], [2e300, 2e-300], [0.0, 0.0]])
    found = vantage.directions(vectors)
    assert (found[0] == found[1]).all() and (found[0] == found[2]).all() and (found[0] != found[3]).any() and (found[4] == vectors[4]).all()


def test_recall_and_work_under_a_larger_factor():
    rows = clustered(6000, 2)
    points = np.array([v for _, v in rows], float)
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree, queries = vantage.VantageTree(points), points[::60]
    exact = [set(r) for r in np.argsort(-(queries @ points.T), axis=1)[:, :6]]
    recall, work = {}, {}
    for factor in (1.0, 1.5, 3.0):
        rows, _ = tree.search(queries, 6, factor)
        recall[factor] = np.mean([len(set(r) & e) / 6 for r, e in zip(rows, exact)])
        work[factor] = tree.n_compared
    assert recall[1.0] == 1 and recall[1.5] >= 0.9 and work[3.0] < work[1.5] < work[1.0] < queries.shape[0] * len(points)


def test_vectors_without_direction_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [2.0, 1.0]),
            (7, [2.0, 1.0]), (8, [0.0, 3.0]), (50, [0.0, 0.0]), (100, [-1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id bigint, embedding array<double>, rank int, score double")
    got = sorted(map(tuple, vantage.nearest(frame, F.col("vec_id") % 50 == 0).collect()))
    assert got == brute_nearest([(0, [1.0, 0.0]), (7, [2.0, 1.0]), (8, [0.0, 3.0]), (100, [-1.0, 0.0])])
    assert vantage.nearest(frame.limit(0), F.col("vec_id") % 50 == 0).collect() == []
