import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions.pretokenizers import pretok_whitespace
from corpusmill.operators import unigram as U
from corpusmill.operators import vocab as V
from corpusmill.operators.lattice import Lattice
from corpusmill.operators.relational import first_rows
from corpusmill.operators.repeats import maximal_repeats
from corpusmill.operators.words import SPECIAL_TOKENS, token_counts

UNKNOWN = -30.0


def repeats_by_definition(words, longest):
    freq, left, right = defaultdict(int), defaultdict(set), defaultdict(set)
    for at, (word, cnt) in enumerate(words.items()):
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + longest) + 1):
                piece = word[i:j]
                freq[piece] += cnt
                left[piece].add(word[i - 1] if i else (at, i))
                right[piece].add(word[j] if j < len(word) else (at, j))
    goes_on = lambda side: len(side) == 1 and isinstance(next(iter(side)), str)
    return {p: n for p, n in freq.items() if n > 1 and len(p) > 1 and not goes_on(left[p]) and not goes_on(right[p])}


@pytest.mark.parametrize("letters, longest, ranges", [("ab", 5, 16), ("abc😀", 4, 7), ("abcdeé", 16, 1), ("a", 6, 9)])
def test_maximal_repeats(spark, letters, longest, ranges):
    """Also where starts go on over many ranges; null and empty words have none, a word seen twice is one."""
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 12))): rng.randint(1, 3) for _ in range(150)}
    words["zz"], words["yx"] = 2, 1
    counts = spark.createDataFrame([*words.items(), ("", 4), (None, 2)], "word string, cnt long")
    settings_before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        rows = maximal_repeats(counts, longest).collect()
    finally:
        for k, v in settings_before.items():
            spark.conf.set(k, v)
    wanted = repeats_by_definition(words, longest)
    assert {r.piece: r.freq for r in rows} == wanted and len(rows) == len(wanted)
    assert wanted["zz"] == 2 and "yx" not in wanted


def test_first_rows(spark):
    """The cut falls inside ranges and ties; rows to keep stay beyond n."""
    df = spark.range(5000).select((F.col("id") % 7).alias("a"), "id", (F.col("id") % 7 == 6).alias("stays")).repartition(5)
    wanted = sorted(((r.a, r.id) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    for n in (0, 1, 713, 714, 715, 2500, 5000, 9000):
        assert sorted((r.a, r.id) for r in first_rows(df, n, F.desc("a"), "id").collect()) == sorted(wanted[:n])
        kept = first_rows(df, n, F.desc("a"), "id", keep="stays").collect()
        assert sorted((r.a, r.id) for r in kept) == sorted(wanted[: max(n, 714)])
    assert first_rows(df.limit(0), 3, "a", "id").count() == 0


def cuts(word, scores):
    """Every way to write the word, with its score; a character that is no piece counts as unknown."""
    if not word:
        return [((), 0.0)]
    found = []
    for end in range(1, len(word) + 1):
        piece = word[:end]
        score = scores.get(piece, UNKNOWN if end == 1 else None)
        if score is not None:
            found += [((piece, *rest), score + s) for rest, s in cuts(word[end:], scores)]
    return found


def lattice(words, pieces, scores, gap=0, proper=False):
    at, places, nodes = 0, [], []
    for word in words:
        nodes.append(at)
        places += [(at + i, p) for i in range(len(word)) for p in range(len(pieces)) if word.startswith(pieces[p], i)]
        at += len(word) + 1 + gap
    places.sort(key=lambda x: (x[1], x[0]))
    number = np.array([p for _, p in places], int)
    length = np.array([len(pieces[p]) for _, p in places], int)
    score = np.array([scores[pieces[p]] for _, p in places], float)
    sizes = np.array([len(w) for w in words], int)
    return Lattice(np.array(nodes, int), sizes, np.array([a for a, _ in places], int), length, number, score, UNKNOWN, proper)


SCORES = st.dictionaries(st.text("ab", min_size=1, max_size=4), st.sampled_from([-1.0, -2.5, -3.25, -4.0, -7.5]), max_size=12)


@settings(max_examples=200, deadline=None)
@given(SCORES, st.lists(st.text("abc", min_size=1, max_size=7), max_size=5), st.integers(0, 2))
def test_lattice_equals_all_cuts(scores, words, gap):
    pieces = sorted(scores)
    weight = np.arange(1.0, len(words) + 1)
    found = lattice(words, pieces, scores, gap)
    wanted = defaultdict(float)
    for word, cnt in zip(words, weight):
        ways = cuts(word, scores)
        total = math.fsum(math.exp(s) for _, s in ways)
        for way, s in ways:
            for piece in way:
                wanted[piece] += cnt * math.exp(s) / total
    expected = found.expected(weight, len(pieces))
    assert np.allclose(expected, [wanted[p] for p in pieces], atol=1e-9)
    way_of = defaultdict(list)
    for word, piece in zip(*found.best()):
        way_of[word].append(UNKNOWN if piece < 0 else scores[pieces[piece]])
    for i, word in enumerate(words):
        assert math.isclose(sum(way_of[i]), max(s for _, s in cuts(word, scores)))


@settings(max_examples=100, deadline=None)
@given(SCORES)
def test_lattice_without_whole_words(scores):
    pieces = sorted(scores)
    way_of = defaultdict(list)
    for word, piece in zip(*lattice(pieces, pieces, scores, proper=True).best()):
        way_of[word].append(piece)
    for i, word in enumerate(pieces):
        others = {p: s for p, s in scores.items() if p != word}
        got = sum(UNKNOWN if p < 0 else scores[pieces[p]] for p in way_of[i])
        assert i not in way_of[i] and math.isclose(got, max(s for _, s in cuts(word, others)))


def test_long_word_and_no_words():
    assert lattice([], [], {}).expected(np.zeros(0), 0).size == 0
    scores = {"a": -2.0, "aa": -3.0, "aaa": -3.5}
    found = lattice(["a" * 20_000], sorted(scores), scores)
    assert math.isclose(found.expected(np.ones(1), 3) @ [1, 2, 3], 20_000, rel_tol=1e-6)
    assert len(found.best()[1]) == 6667


def test_digamma(spark):
    """Its values at 1, 1/2 and 10, and its recurrence."""
    euler = 0.5772156649015329
    wanted = {1.0: -euler, 0.5: -euler - 2 * math.log(2), 10.0: -euler + sum(1 / k for k in range(1, 10))}
    rows = spark.createDataFrame([(x,) for x in wanted], "x double").select("x", U.digamma(F.col("x")).alias("y")).collect()
    assert all(math.isclose(r.y, wanted[r.x], abs_tol=1e-8) for r in rows)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


# Least share of the library's pieces found. Its seeds are repeats among distinct words, here each word has its count.
@pytest.mark.parametrize("size, share", [(300, 0.7), (1000, 0.8), (4000, 0.6)])
def test_pieces_beside_the_library(spark, documents, size, share):
    counts = token_counts(documents, pretok_whitespace(F.col("text")))
    rows = U.train_unigram(counts, vocab_size=size).vocab.orderBy("id").collect()
    tokens = [r.token for r in rows]
    assert tokens[:5] == SPECIAL_TOKENS and len(set(tokens)) == len(tokens) == size
    scores = [r.score for r in rows[5:]]
    assert scores == sorted(scores, reverse=True) and max(scores) < 0
    assert {r.ch for r in V.character_counts(counts).collect()} <= set(tokens)
    tk = pytest.importorskip("tokenizers")
    t = tk.Tokenizer(tk.models.Unigram())
    t.pre_tokenizer = tk.pre_tokenizers.Whitespace()
    t.train_from_iterator([r.text for r in documents.collect()], tk.trainers.UnigramTrainer(
        special_tokens=SPECIAL_TOKENS, vocab_size=size, unk_token="[UNK]", show_progress=False))
    theirs = set(t.get_vocab())
    assert len(theirs & set(tokens)) > share * len(theirs), len(theirs & set(tokens)) / len(theirs)


def test_one_round_equals_the_formulas(spark):
    """Scores after estimating, and the pieces kept by pruning, against sums over all ways to write each word."""
    words = {"banana": 5, "bandana": 3, "cabana": 2, "an": 7, "nab": 1}
    counts = spark.createDataFrame(list(words.items()), "word string, cnt long")
    pieces = ["a", "b", "c", "d", "n", "an", "ana", "ban", "cab", "bana", "and"]
    start = {p: -1.0 - 0.35 * i for i, p in enumerate(pieces)}
    table = spark.createDataFrame(list(start.items()), "piece string, score double")
    in_words = U.lay_out(counts, table, 4)
    in_pieces = U.lay_out(table.select(F.col("piece").alias("word"), F.lit(1).alias("cnt")), table, 4)
    scores = U.Scores(table, len(start), min(start.values()))
    expected = defaultdict(float)
    used = defaultdict(float)
    for word, cnt in words.items():
        ways = [w for w in cuts(word, start) if w[1] > UNKNOWN]
        total = math.fsum(math.exp(s) for _, s in ways)
        for way, s in ways:
            for p in way:
                expected[p] += cnt * math.exp(s) / total
        for p in max(ways, key=lambda w: w[1])[0]:
            used[p] += cnt
    got = {r.piece: r.value for r in U.expected_pieces(in_words, scores).collect()}
    assert got.keys() == expected.keys() and all(math.isclose(got[p], expected[p], rel_tol=1e-9) for p in got)
    assert {r.piece: r.value for r in U.used_pieces(in_words, scores).collect()} == pytest.approx(dict(used))
    every = sum(used.values())
    always, worth = set(), {}
    for p in pieces:
        ways = [w for w in cuts(p, {q: s for q, s in start.items() if q != p}) if w[1] > UNKNOWN]
        if not ways:
            always.add(p)
            continue
        way, score = max(ways, key=lambda w: w[1])
        f = used[p]
        if f > 0 and score <= start[p]:
            loss = math.log(f / every) - sum(math.log((used[q] + f) / (every + f * (len(way) - 1))) for q in way)
            worth[p] = f * loss
    order = sorted(worth, key=lambda p: -worth[p])
    for wanted in (1, 6, 7, 8):
        kept = U._prune(in_words, in_pieces, scores, wanted, 0.0)
        assert {r.piece for r in kept.table.collect()} == always | set(order[: max(wanted - len(always), 0)])
        assert kept.size == kept.table.count()


def test_no_words(spark):
    empty = spark.createDataFrame([("", 1), (None, 2)], "word string, cnt long")
    v = U.train_unigram(empty, vocab_size=10, initial_alphabet=["x"])
    assert [r.token for r in v.vocab.orderBy("id").collect()] == [*SPECIAL_TOKENS, "x"]
