import random
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.operators import spelling as S
from corpusmill.operators.edit_walk import Trie, walk
from corpusmill.plans import corpus as P
from corpusmill.plans.corpus import spell_correct

N = S.CORPUS_WORDS


def brute_best(token, dictionary):
    found = [(S.alignment_distance(token, t), -c, t) for t, c in dictionary.items()]
    found = [f for f in found if f[0] <= 2]
    if not found:
        return None
    d, c, t = min(found)
    return t, -c, d


def brute_compound(text, dictionary, bigrams):
    """The published procedure, one text at a time."""
    import re

    def rare(t):
        return (t, 1 if len(t) == 1 else 0, 3)

    least = min(bigrams.values(), default=sys.maxsize)
    parts, last_joined, before = [], False, None
    for term in re.findall(r"[^\W_]+['’]*[^\W_]*", text.lower()):
        single = brute_best(term, dictionary)
        if before is not None and not last_joined:
            whole = brute_best(before + term, dictionary)
            if whole:
                one, two = parts[-1], single or rare(term)
                apart = one[2] + two[2]
                if whole[2] + 1 < apart or (whole[2] + 1 == apart and whole[1] > one[1] / N * two[1]):
                    parts[-1] = (whole[0], whole[1], whole[2] + 1)
                    last_joined, before = True, term
                    continue
        last_joined, before = False, term
        if single and (single[2] == 0 or len(term) == 1):
            parts.append(single)
            continue
        best = single
        for j in range(1, len(term)):
            a, b = brute_best(term[:j], dictionary), brute_best(term[j:], dictionary)
            if not (a and b):
                continue
            text2 = f"{a[0]} {b[0]}"
            d = min(S.alignment_distance(term, text2), 3)
            if best and d > best[2]:
                continue
            if best and d < best[2]:
                best = None
            if text2 in bigrams:
                c = bigrams[text2]
                if single:
                    if a[0] + b[0] == term:
                        c = max(c, single[1] + 2)
                    elif single[0] in (a[0], b[0]):
                        c = max(c, single[1] + 1)
                elif a[0] + b[0] == term:
                    c = max(c, max(a[1], b[1]) + 2)
            else:
                c = min(least, int(a[1] / N * b[1]))
            if best is None or c > best[1]:
                best = (text2, c, d)
        parts.append(best or rare(term))
    return " ".join(p[0] for p in parts)


DICTIONARY = {
    "the": 23_000_000_000, "cat": 60_000_000, "sat": 15_000_000, "on": 3_700_000_000, "mat": 8_000_000, "where": 300_000_000,
    "is": 4_700_000_000, "love": 200_000_000, "head": 90_000_000, "who": 250_000_000, "a": 9_000_000_000, "in": 8_400_000_000,
    "quarter": 40_000_000, "of": 13_000_000_000, "last": 300_000_000, "year": 180_000_000, "it's": 90_000_000, "x": 70_000_000,
}
BIGRAMS = {"the cat": 900, "in the": 4000, "of the": 9000, "where is": 120, "last year": 800, "the last": 700}


@pytest.fixture(scope="module")
def tables(spark):
    d = spark.createDataFrame(list(DICTIONARY.items()), "term string, cnt bigint")
    b = spark.createDataFrame([(*k.split(), c) for k, c in BIGRAMS.items()], "left string, right string, cnt bigint")
    return d, b


def test_distance():
    assert S.alignment_distance("abcd", "abdc") == 1
    assert S.alignment_distance("ca", "abc") == 3
    assert S.alignment_distance("", "ab") == 2


def test_delete_index(spark, tables):
    got = {r.variant for r in S.delete_index(tables[0]).where("term = 'the'").collect()}
    assert got == {"the", "he", "te", "th", "t", "h", "e"}
    assert {r.variant for r in S.delete_index(tables[0]).where("term = 'a'").collect()} == {"a", ""}
    widest = S.delete_index(tables[0]).groupBy("term").count().agg(F.max("count")).first()[0]
    assert widest <= 29


def test_candidates_and_best_equal_brute_force(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    terms = {w: rng.randint(1, 5) for w in words[::2]}
    tokens = spark.createDataFrame([(w,) for w in words], "token string")
    dictionary = spark.createDataFrame(list(terms.items()), "term string, cnt bigint")
    got = {(r.token, r.term, r.distance) for r in S.spell_candidates(tokens, dictionary).collect()}
    wanted = {(w, t, S.alignment_distance(w, t)) for w in words for t in terms}
    assert got == {x for x in wanted if x[2] <= 2}
    best = {r.token: (r.term, r.cnt, r.distance) for r in S.spell_best(tokens, dictionary).collect()}
    brute = {w: brute_best(w, terms) for w in words}
    assert best == {w: b for w, b in brute.items() if b}


def test_ranges_and_blocks_lose_no_pair(spark, monkeypatch):
    """Small ranges and blocks, a length with more terms than a range, words beyond all lengths, and nulls."""
    monkeypatch.setattr(S, "LEAST_BLOCK_WORDS", 40)
    monkeypatch.setattr(S, "BLOCK_WORDS", 60)
    monkeypatch.setattr(S, "WORDS_AT_ONCE", 17)
    rng = random.Random(9)
    made = sorted({"".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 3, 4, 4, 4, 4, 6]))) for _ in range(400)} | {"a" * 30, "b" * 3000, ""})
    terms = {w: rng.randint(1, 4) for w in made[::2] + ["a" * 29, "b" * 2999 + "a"]}
    tokens = spark.createDataFrame([(w, 1) for w in [*made, *made[:9], None]], "token string, cnt int")
    dictionary = spark.createDataFrame([*terms.items(), (None, 3)], "term string, cnt bigint")
    wanted = {(w, t, S.alignment_distance(w, t)) for w in made for t in terms if abs(len(w) - len(t)) <= 2 and (len(w) < 100 or len(t) > 100)}
    wanted = {x for x in wanted if x[2] <= 2}
    for range_terms in (5, 30, 10_000):
        rows = S.spell_candidates(tokens, dictionary, range_terms=range_terms).collect()
        assert len(rows) == len(wanted) and {(r.token, r.term, r.distance) for r in rows} == wanted
        best = {r.token: (r.distance, -r.cnt, r.term) for r in S.spell_best(tokens.distinct(), dictionary, range_terms=range_terms).collect()}
        assert best == {w: min((d, -terms[t], t) for x, t, d in wanted if x == w) for w in {x[0] for x in wanted}}
    assert S.spell_candidates(tokens.limit(0), dictionary).collect() == S.spell_candidates(tokens, dictionary.limit(0)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abé\U0001f600", max_size=6), max_size=20), st.sets(st.text("abé\U0001f600", max_size=6), max_size=20), st.integers(0, 3))
def test_the_walk_finds_all_pairs_within_the_distance(words, terms, most):
    words, terms = sorted(words), sorted(terms)
    found = [(words[w], terms[t], d) for x in walk(words, Trie(terms), most) for w, t, d in zip(*(c.tolist() for c in x))]
    wanted = [(w, t, S.alignment_distance(w, t)) for w in words for t in terms]
    assert sorted(found) == sorted(x for x in wanted if x[2] <= most)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("abc", max_size=6), max_size=30), st.sets(st.text("abc", max_size=6), max_size=30), st.integers(1, 9))
def test_the_walk_holds_few_states_at_once_and_finds_the_same(words, terms, states):
    words, terms = sorted(words), sorted(terms)
    found = [list(zip(*(c.tolist() for c in x))) for x in walk(words, Trie(terms), 2, states)]
    whole = [p for x in walk(words, Trie(terms), 2) for p in zip(*(c.tolist() for c in x))]
    assert sorted(p for part in found for p in part) == sorted(whole)
    # The pairs of a word come together, so the best of a word can be taken at once.
    owners = [w for part in found for w in {p[0] for p in part}]
    assert len(owners) == len(set(owners))


def test_distances_decided_without_alignment(spark):
    rng = random.Random(11)
    made = [("".join(rng.choice("abé ") for _ in range(rng.randint(0, 7))), "".join(rng.choice("abé ") for _ in range(rng.randint(0, 7)))) for _ in range(4000)]
    rows = spark.createDataFrame([*made, ("ab\U0001f600", "a\U0001f600b"), (None, "a")], "a string, b string")
    for most in (1, 2, 3):
        for r in rows.select("a", "b", S.edit_distance(F.col("a"), F.col("b"), most).alias("d")).collect():
            if r.a is not None:
                assert r.d == min(S.alignment_distance(r.a, r.b), most + 1), (r, most)


def test_compound_asks_only_what_may_change_an_answer(spark, tables):
    """Neighbours that are terms are not asked together, a word beside a term is not split where no term ends."""
    asked = []

    def find(tokens):
        asked.append({r.token for r in tokens.collect()})
        return S.spell_best(tokens, tables[0])

    df = spark.createDataFrame([(0, "the cat sat"), (1, "quartr of hed"), (2, "zzzzz yyyyy")], "i int, t string")
    got = {r.i: r.corrected for r in S.spell_compound(df, "t", ["i"], *tables, find=find).collect()}
    assert got == {i: brute_compound(t, DICTIONARY, BIGRAMS) for i, t in ((0, "the cat sat"), (1, "quartr of hed"), (2, "zzzzz yyyyy"))}
    everything = set().union(*asked)
    assert not everything & {"thecat", "catsat", "quartrof", "ofhed", "quar", "tr"}
    assert "zzzzzyyyyy" in everything and "zzzz" in everything


def test_compound_equals_brute_force(spark, tables):
    rng = random.Random(5)
    fixed = [
        "whereis th elove hehad", "The CAT, sat on teh mat.", "inthe quater oflast yeear", "", "!!", "x", "zzzzzzzz q", "thecatsat",
        "it's in the l ast yearr", "qu arter qu arter", "a b c d",
    ]
    letters = "".join(DICTIONARY)
    made = []
    for _ in range(60):
        words = [list(rng.choice(list(DICTIONARY))) for _ in range(rng.randint(1, 7))]
        for w in words:
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = rng.choice([" ", "", rng.choice(letters)])
        made.append("".join(("" if rng.random() < 0.2 else " ") + "".join(w) for w in words))
    texts = [*fixed, *made]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = {r.i: r.corrected for r in S.spell_compound(df, "t", ["i"], *tables).collect()}
    assert got.pop(len(texts)) is None
    wrong = [(t, got[i], brute_compound(t, DICTIONARY, BIGRAMS)) for i, t in enumerate(texts)]
    wrong = [w for w in wrong if w[1] != w[2]]
    assert not wrong, (len(wrong), wrong[:5])


def test_texts_are_worked_out_once(spark, tables):
    """The texts to correct may come out of a costly chain; they are read several times."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def costly(text):
        seen.add(1)
        return text

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["the cat", "teh cat", "the cat", None])], "i int, t string").repartition(1)
    got = {r.i: r.t for r in spell_correct(df.withColumn("t", costly("t")), "t", *tables).collect()}
    assert got == {0: "the cat", 1: "the cat", 2: "the cat", 3: None}
    assert seen.value == 4


def test_tables_go_when_they_are_not_read_any_more(spark, tables, monkeypatch):
    """Each word travels with the number of its text, and of what was written in between only the last table is left."""
    keys, written = [], {}
    compound, write = P.spell_compound, S.materialize
    monkeypatch.setattr(P, "spell_compound", lambda df, text, key, *rest, **params: keys.append(df.schema[key[0]].dataType.typeName()) or compound(df, text, key, *rest, **params))

    def kept(df, purpose):
        table = write(df, purpose)
        written.setdefault(purpose, []).append((table.schema, table.inputFiles()[0].rsplit("/", 1)[0], table.count()))
        return table

    monkeypatch.setattr(S, "materialize", kept)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["the catsat", "teh cat", "thec at", None])], "i int, t string")
    assert spell_correct(df, "t", *tables).count() == 4
    assert keys == ["long"]
    own = [t for name, made in written.items() if name not in ("asked", "sizes", "marked") for t in made]
    assert len(own) == 13 and sum(n for *_, n in own) > 13
    assert all(spark.read.schema(schema).parquet(folder).isEmpty() for schema, folder, _ in own)
    [(schema, folder, n)] = written["marked"]
    assert spark.read.schema(schema).parquet(folder).count() == n
