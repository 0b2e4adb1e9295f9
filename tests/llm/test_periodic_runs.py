import hashlib
import re
import time
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import periodic_runs as R
from corpusmill.llm import queries

from .conftest import FOLDER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """(start, period, length) of all runs: every period, every stretch, smallest period only."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, q, n) for (s, n), q in found.items())


def collapse(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("abc", min_size=1, max_size=2), st.integers(1, 9)), max_size=12), max_size=5), st.randoms())
def test_runs_match_brute_force(parts, rng):
    texts = []
    for part in parts:
        words = [w for piece, times in part for w in list(piece) * times]
        texts.append(words)
    runs, left = R.slice_runs(pa.array([rng.choice([" ", "\n", "  "]).join(t) for t in texts], pa.large_string()), [None] * len(texts), None)
    assert runs == [brute(t) for t in texts]
    assert [bytes(x).decode() for x in left] == [collapse(t, r) for t, r in zip(texts, runs)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=90), max_size=4), st.integers(1, 20), st.integers(2, 5))
def test_runs_of_two_words_and_long_periods(texts, period, times):
    texts = [*texts, *[(t[:period] * times) + t for t in texts]]
    runs, _ = R.slice_runs(pa.array([" ".join(t) for t in texts], pa.large_string()), [None] * len(texts), None)
    assert runs == [brute(t) for t in texts]


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, FOLDER).collect()}
    assert len(found) == len(docs)
    some = 0
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words) if n < 1500 else None
        r = found[doc_id]
        if runs is None:
            continue
        some += len(runs)
        longest = min(runs, key=lambda x: (-x[2], x[0], x[1]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.period, r.length) == (longest or (None, None, None))
        assert r.exponent_milli == (longest and 1000 * longest[2] // longest[1])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, q, n in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapse(words, runs).encode()).hexdigest()
    assert some > 5


@pytest.mark.parametrize("words", [["a"] * 200_000, ["a", "b"] * 60_000 + ["a"] * 60_000, [f"w{k % 977}" for k in range(200_000)]])
def test_long_repetitive_texts(words):
    began = time.time()
    runs, _ = R.slice_runs(pa.array([" ".join(words)], pa.large_string()), [None], None)
    assert time.time() - began < 60
    assert max(n for _, _, n in runs[0]) >= 60_000 and len(runs[0]) <= 3


def test_fibonacci_words_have_many_runs():
    a, b = ["a"], ["a", "b"]
    while len(b) < 900:
        a, b = b, b + a
    runs, _ = R.slice_runs(pa.array([" ".join(b)], pa.large_string()), [None], None)
    assert runs == [brute(b)] and len(runs[0]) > 100


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = {}
    for r in R.periodic_runs(odd_docs).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert [r.collapsed for r in rows[1] + rows[2] + rows[3]] == ["", "", ""]
    assert [[tuple(x) for x in r.runs] for r in rows[12]] == [[(0, 1, 60)]] * 2 and {r.collapsed for r in rows[12]} == {"idiot"}
    assert rows[11][0].collapsed == odd_docs.where("doc_id = 11").first().text and len(rows[None]) == 2
    assert R.periodic_runs(no_docs).collect() == R.run_digests(no_docs).collect() == []
    assert R.run_digests(odd_docs).count() == odd_docs.count()
    assert R.plant(None, 5) is None and all(R.plant(k, 0) is None for k in range(50))
