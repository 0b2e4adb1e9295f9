import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import linear, quality_model, toxicity
from corpusmill.llm.words import find_words

from .conftest import FOLDER, prose


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_words_are_runs_of_non_blanks():
    texts = ["", " a  bb\x0bc\x0c", "é x ÄB", "\n", "z"]
    words = find_words(pa.array(texts, pa.large_string()))
    assert words.counts.tolist() == [0, 3, 2, 0, 1]
    assert [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end)] == ["a", "bb", "c", "é x", "ÄB", "z"]
    lower = find_words(pa.array(["ABc", "abC", "abc ÄB", "äb"], pa.large_string()), lower=True).hashes
    assert lower[0] == lower[1] == lower[2] and lower[3] != lower[4]


@pytest.mark.parametrize("classify, label", [(quality_model.classify_quality, "quality"), (toxicity.classify_toxicity, "toxic")])
def test_held_out_accuracy_on_the_labelled_documents(spark, classify, label):
    folder = FOLDER.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = {r.doc_id: r for r in classify(docs, labels).collect()}
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) for r in scored.values())
    rows = [(scored[r.doc_id].predicted, r[label]) for r in labels.collect() if held(r.doc_id)]
    assert sum(p == y for p, y in rows) / len(rows) > 0.95


@pytest.mark.parametrize("classify", [quality_model.classify_quality, toxicity.classify_toxicity])
def test_odd_and_empty_tables(odd_docs, no_docs, labels, no_labels, classify):
    rows = classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1  # no words: the bias alone
    assert {r.score for r in classify(odd_docs, no_labels).collect()} == {0.5}
    assert classify(no_docs, labels).collect() == []


def test_the_sample_is_bounded_and_leaves_the_held_out_fold_out(spark, odd_docs, labels):
    ids = [r.doc_id for r in linear.training_texts(odd_docs, labels, "quality", 4).collect()]
    assert len(ids) == len(set(ids)) <= 4 and not any(held(i) for i in ids)
    assert sorted(ids) == sorted(r.doc_id for r in linear.training_texts(odd_docs, labels, "quality", 4).collect())


def test_features_are_worked_out_for_little_text_at_a_time(spark):
    most = 1 << 20

    def counted(texts):
        size = sum(len(t) for t in texts.to_pylist())
        if size > most:
            raise ValueError(f"features of {size} bytes at once")
        return toxicity.features(texts)

    docs = spark.createDataFrame([(i, f"women and men w{i} " * 100) for i in range(2000)], "doc_id bigint, text string").coalesce(1)
    given = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id bigint, toxic int")
    texts = linear.training_texts(docs, given, "toxic", 2000).coalesce(1)
    model = linear.train(texts, counted, True, toxicity.Swapper(toxicity.IDENTITY_TERMS), epochs=1, alpha=1.0, l1=1.0)
    assert model.n_pairs == 2 * sum(not held(i) for i in range(2000))
    assert linear.score(docs, counted, model).where("score >= 0").count() == 2000


def test_updates_follow_the_closed_form():
    rng = np.random.default_rng(1)
    ids, gradients = np.array([3, 9]), rng.normal(size=(50, 2)) * 3
    leader = linear.FollowTheLeader(0.5, 1.0, 0.3, 0.7)
    z, n = np.zeros(2), np.zeros(2)
    for g in gradients:
        w = np.array([0 if abs(a) <= 0.3 else (np.sign(a) * 0.3 - a) / ((1 + b**0.5) / 0.5 + 0.7) for a, b in zip(z, n)])
        np.testing.assert_allclose(leader.weights(ids), w)
        leader.update(ids, leader.weights(ids), g)
        z, n = z + g - ((n + g * g) ** 0.5 - n**0.5) / 0.5 * w, n + g * g


def test_swapped_mentions_keep_their_case_of_language():
    swap = toxicity.Swapper([["people", "women", "men", "jews"], ["gens", "femmes", "hommes"]])
    (own, other), (own_again, neutral) = swap(5, "Women and men, les femmes; womenfolk")
    assert own is own_again is None and neutral == "people and people, les gens; womenfolk"
    assert other.split()[0] in ("men", "jews") and "hommes" in other and "womenfolk" in other


def test_texts_without_terms_are_given_a_mention():
    swap = toxicity.Swapper([["people", "women", "men"]])
    seen = set()
    for key in range(40):
        ((neutral, group),) = swap(key, "one\ntwo  three")
        term = (set(group.split()) - set("one two three".split())).pop()
        assert term in ("women", "men") and neutral == group.replace(term, "people") and group.replace(f" {term}", "") == "one\ntwo  three"
        assert swap(key, "one\ntwo  three") == [(neutral, group)]
        seen.add(group)
    assert len(seen) > 3 and swap(5, " \n") == [] and toxicity.Swapper([])(5, "women") == []


def test_differences_hold_what_only_one_form_has():
    ids, change = linear.difference((np.array([1, 4, 9]), np.array([1, 1, 1.0])), (np.array([2, 4, 9]), np.array([1, 1, 0.5])))
    assert ids.tolist() == [1, 2, 9] and change.tolist() == [1, -1, 0.5]


def test_pairs_act_on_the_given_tables(spark):
    """Groups are mentioned nowhere in them; their scores still differ less, and no more neutral mentions are rejected."""
    folder = FOLDER.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    clean = [r.text for r in docs.join(labels.where("toxic = 0"), "doc_id").orderBy("doc_id").limit(60).collect()]
    row = toxicity.IDENTITY_TERMS[0]
    gap, wrong = {}, {}
    for penalty in (0.0, toxicity.PENALTY):
        model = toxicity.train_toxicity(docs, labels, penalty=penalty)
        raw = np.array([linear.raw_scores(pa.array([f"{t} {term}" for t in clean], pa.large_string()), toxicity.features, model) for term in row])
        gap[penalty], wrong[penalty] = np.abs(raw[1:] - raw[0]).mean(), (raw > 0).mean()
        assert model.n_pairs > 0
    assert gap[toxicity.PENALTY] <= gap[0.0] and wrong[toxicity.PENALTY] <= wrong[0.0]


def test_neutral_mentions_are_scored_up_less_with_the_penalty(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        toxic = i % 2
        who = "muslims" if toxic and rng.random() < 0.8 else rng.choice(["people", "farmers"])
        rows.append((i, f"{prose(rng, 20)} {who} {rng.choice(['scum', 'idiot', 'trash']) if toxic and rng.random() < 0.7 else 'are here'}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    neutral = pa.array([f"{prose(random.Random(k), 20)} muslims are here" for k in range(50)], pa.large_string())
    insults = pa.array([f"{prose(random.Random(k), 20)} people scum" for k in range(50)], pa.large_string())
    mean = {}
    for penalty in (0.0, 1.0):
        model = toxicity.train_toxicity(docs, labels, penalty=penalty)
        mean[penalty] = [(linear.raw_scores(t, toxicity.features, model) > 0).mean() for t in (neutral, insults)]
    assert mean[1.0][0] < mean[0.0][0] and mean[1.0][1] > 0.9
