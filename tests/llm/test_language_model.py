import math
import random
import zlib
from collections import Counter

import pytest

from corpusmill.llm import language_model as lm

from .conftest import prose


def tokens_of(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w] + [None]


def counts_of(texts):
    found = Counter(t for text in texts for t in tokens_of(text))
    total = sum(found.values())
    return found, total, total + 0.5 * (len(found) + 1)


def texts(n, seed):
    rng = random.Random(seed)
    return [" ".join(("of the" if rng.random() < 0.5 else prose(rng, 2, 12)) for _ in range(rng.randrange(1, 30))) + " " + prose(rng, 2, 900, "r") for _ in range(n)]


def backoff(model_counts, shares, sentence):
    """Log-probability by definition: discounted counts where the n-gram is kept, else the back-off weight times the shorter context."""
    grams, least, word_least = model_counts, shares[0], shares[1]
    n1 = grams[1]
    total = sum(n1.values())
    denominator = total + 0.5 * (len(n1) + 1)
    in_model = {w for (w,), n in n1.items() if n >= word_least}
    kept = {1: None}
    texts_n = n1[(None,)]
    context = lambda c: texts_n if c == ("<s>",) else n1[c] if len(c) == 1 else grams[len(c)][c]
    common = {w for w in in_model if n1[(w,)] >= least} | {"<s>"}
    for order in (2, 3):
        kept[order] = {g for g, n in grams[order].items() if n >= max(least, 2) and (all(w in common for w in g) if order == 2 else g[:-1] in kept[2] and g[1:] in kept[2])}

    def p(word, before):
        if not before:
            return (n1[(word,)] + 0.5) / denominator
        g = (*before, word)
        if g in kept[len(g)]:
            return (grams[len(g)][g] - lm.DISCOUNT) / context(before)
        following = [h[-1] for h in kept[len(g)] if h[:-1] == before]
        if not following:
            return p(word, before[1:])
        weight = (1 - sum((grams[len(g)][(*before, w)] - lm.DISCOUNT) / context(before) for w in following)) / (1 - sum(p(w, before[1:]) for w in following))
        return weight * p(word, before[1:])

    score, history = 0.0, ("<s>",)
    for token in tokens_of(sentence):
        score += math.log10(p(token, history[-2:]))
        history = (*history, token)
    return score, p, n1


def gram_counts(train):
    grams = {1: Counter(), 2: Counter(), 3: Counter()}
    for text in train:
        sequence = ["<s>", *tokens_of(text)]
        grams[1].update((w,) for w in sequence[1:])
        for n in (2, 3):
            grams[n].update(tuple(sequence[i:i + n]) for i in range(len(sequence) - n + 1))
    return grams


def test_scores_match_the_definition(spark):
    rows = list(enumerate([*texts(150, 1), "", None, "unseen words", "OF THE of The"]))
    got = {r.doc_id: r for r in lm.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string"), least=4).collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    train = [t for i, t in rows if not fold[i]]
    found, total, denominator = counts_of(train)
    grams = gram_counts(train)
    better = 0
    for i, text in rows:
        tokens = tokens_of(text)
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (fold[i], len(tokens), sum(found[t] > 0 for t in tokens), total)
        assert got[i].base_score == pytest.approx(sum(math.log10((found[t] + 0.5) / denominator) for t in tokens), rel=1e-9)
        score, p, _ = backoff(grams, (4, 0), text)
        assert got[i].score == pytest.approx(score, rel=1e-9)
        better += fold[i] and got[i].score > got[i].base_score
    assert better > 0.8 * sum(fold.values())
    # Each context's probabilities, with that of one unknown word, add up to one.
    for before in [(), ("of",), ("<s>",), ("of", "the"), ("the", "of")]:
        assert sum(p(w, before) for w in [*found, "never seen"]) == pytest.approx(1.0)


def test_ngrams_are_kept_by_count_at_every_size(spark):
    """Among 2.4 million tokens, n-grams seen twice are in the model as they are among few."""
    rng = random.Random(4)
    twice = "quick brown foxes jumped over"
    rows = [(i, " ".join(["filler"] * 1200)) for i in range(2500)] + [(10_000 + i, twice) for i in range(40)]
    fold = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    keep = [r for r in rows if r[1] != twice] + [r for r in rows if r[1] == twice and not fold[r[0]]][:2] + [r for r in rows if r[1] == twice and fold[r[0]]][:1]
    rng.shuffle(keep)
    got = {r.doc_id: r for r in lm.score_texts(spark.createDataFrame(keep, "doc_id bigint, text string")).collect()}
    train = [t for i, t in keep if not fold[i]]
    total = counts_of(train)[1]
    assert total > 2_000_000
    score, _, _ = backoff(gram_counts(train), (2, 0), twice)
    [held] = [i for i, t in keep if t == twice and fold[i]]
    assert got[held].score == pytest.approx(score, rel=1e-9) and got[held].score > got[held].base_score + 15


def test_odd_and_empty_tables(odd_docs, no_docs):
    rows = lm.score_texts(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    found, total, denominator = counts_of([r.text for r in odd_docs.collect() if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 != 1])
    assert {r.train_tokens for r in rows} == {total}
    by_id = sorted((r.doc_id or -1, r.n_tokens, round(r.base_score, 6)) for r in rows)
    want = sorted((r.doc_id or -1, len(tokens_of(r.text)), round(sum(math.log10((found[t] + 0.5) / denominator) for t in tokens_of(r.text)), 6)) for r in odd_docs.collect())
    assert by_id == want
    assert lm.score_texts(no_docs).collect() == []


def test_buckets_passes_and_slices_change_no_score(spark, monkeypatch):
    docs = spark.createDataFrame([*enumerate(texts(40, 7))] * 2 + [(99, None)], "doc_id bigint, text string")
    want = sorted(map(tuple, lm.score_texts(docs).collect()))
    monkeypatch.setattr(lm, "SLICE_TOKENS", 50)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 100)
    monkeypatch.setattr(lm, "PART_BYTES", 2000)
    got = sorted(map(tuple, lm.score_texts(docs).collect()))
    assert [g[:5] for g in got] == [w[:5] for w in want] and len(got) == 81
    assert [g[5:] for g in got] == [pytest.approx(w[5:], rel=1e-12) for w in want]
