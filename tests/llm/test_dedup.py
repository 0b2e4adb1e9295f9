import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import jaccard_join, substring_dedup
from corpusmill.llm.components import components
from corpusmill.llm.words import find_words, run_hashes

from .conftest import prose


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_classes(rows):
    """class and links of each row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted((doc_id, least[find(i)], links[i]) for i, (doc_id, _) in enumerate(rows))


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("small, block", [(200, 1024), (4, 8)])
def test_classes_and_links_match_brute_force(spark, small, block):
    """With tiny limits the same groups are split further and compared in blocks, with the same result."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 120), 3000) for _ in range(60)]
    texts += near_copies(rng, prose(rng, 150, 3000), 40, 6) + near_copies(rng, prose(rng, 60, 3000), 25, 2) + [texts[0]] * 9 + ["one two", "one two", "", None]
    texts += [prose(rng, 5, 9) + " shared line of seven words in all" for _ in range(20)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string"), small=small, block=block, recall=0.9999)
    assert sorted(map(tuple, got.collect())) == brute_classes(rows)


def test_the_number_of_runs_reaches_the_recall():
    assert jaccard_join.runs_needed(0.8, 0.999, 3) == 12
    assert jaccard_join.runs_needed(0.8, 0.9, 1) < jaccard_join.runs_needed(0.8, 0.9, 3)
    # One pair at the threshold, many seeds: how often a single choice brings both sets together.
    rng = np.random.default_rng(0)
    both, hits = rng.integers(0, 2**63, 80).astype(np.uint64), 0
    for seed in range(600):
        own = [np.concatenate([both, rng.integers(0, 2**63, 10).astype(np.uint64)]) for _ in range(2)]
        found = [set(jaccard_join.choose(o, np.zeros(90, int), np.array([90]), np.array([seed], np.uint64), 0.8)[1].tolist()) for o in own]
        hits += bool(found[0] & found[1])
    assert 0.6 < hits / 600 < 0.75


@pytest.mark.parametrize("recall, depth", [(0.999, 3), (0.9, 2), (0.6, 1)])
def test_the_runs_reach_the_recall_for_truncated_copies(recall, depth):
    """A set and four fifths of it: drawn shingle by shingle, they must lead on to the depth once and meet twice."""
    runs = jaccard_join.runs_for_all_sizes(0.8, recall, depth)
    rng = np.random.default_rng(1)
    found, trials = 0, 40_000
    level = rng.poisson(1.0, (trials, runs))
    meetings = level.sum(axis=1)
    for _ in range(depth - 1):
        level = rng.poisson(level.astype(float))
    found = ((level.sum(axis=1) > 0) & (meetings >= jaccard_join.LEAST_MEETINGS)).mean()
    assert found > recall - 3 * (recall * (1 - recall) / trials) ** 0.5


def test_truncated_copies_are_found_by_default(spark):
    """All buckets are split to the full depth; of 2,000 pairs at the threshold, two are lost on average."""
    rng = random.Random(15)
    rows = []
    for case in range(2000):
        words = prose(rng, 104, 10**6).split()
        rows += [(2 * case, " ".join(words)), (2 * case + 1, " ".join(words[:84]))]
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string"), small=1)
    lost = got.where("doc_id % 2 = 1 AND class_id = doc_id").count()
    assert lost <= 8, lost


def test_jaccard_on_odd_and_empty_tables(odd_docs, no_docs):
    rows = jaccard_join.jaccard_classes(odd_docs).collect()
    assert sorted(map(tuple, rows)) == brute_classes([(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None])
    assert jaccard_join.jaccard_classes(no_docs).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 300: 200}


# Passages

def numbers(text):
    return np.array([hash(w) & (1 << 62) - 1 for w in text.split()], np.uint64)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40), st.integers(1, 9)), min_size=1, max_size=7, unique_by=lambda r: r[0]))
def test_chains_are_the_best_of_all_subsequences(runs):
    runs = sorted(runs)

    def brute(i):
        x, y, n = runs[i]
        before = [brute(j) - 0.1 * (x - runs[j][0] - runs[j][2] + y - runs[j][1] - runs[j][2])
                  for j in range(i) if runs[j][0] + runs[j][2] <= x and runs[j][1] + runs[j][2] <= y]
        return n + max([0.0, *before])

    score, chain = substring_dedup.best_chain(runs)
    assert score == pytest.approx(max(brute(i) for i in range(len(runs))))
    assert all(runs[a][0] + runs[a][2] <= runs[b][0] and runs[a][1] + runs[a][2] <= runs[b][1] for a, b in zip(chain, chain[1:]))


def test_fuzzy_passages_are_found_with_their_edits():
    rng = random.Random(8)
    passage = prose(rng, 90, 5000).split()
    edited = passage[:20] + ["new"] + passage[21:50] + passage[52:70] + ["more", "words"] + passage[70:]
    a = numbers(" ".join([prose(rng, 100, 5000), *edited, prose(rng, 40, 5000)]))
    b = numbers(" ".join([prose(rng, 30, 5000), *passage, prose(rng, 200, 5000)]))
    [found] = substring_dedup.passages(a, b)
    assert (found.start, found.end, found.other_start, found.other_end) == (100, 190, 30, 120) and found.edits == 5


def test_passages_in_another_order_and_short_ones():
    rng = random.Random(9)
    one, two, short = prose(rng, 60, 5000), prose(rng, 70, 5000), prose(rng, 45, 5000)
    a, b = numbers(f"{one} {prose(rng, 50, 5000)} {two} x y {short}"), numbers(f"{short} {two} {prose(rng, 50, 5000)} {one}")
    assert sorted((p.start, p.end, p.other_start, p.other_end) for p in substring_dedup.passages(a, b)) == [(0, 60, 165, 225), (110, 180, 45, 115)]


def test_windows_of_fifty_words_match_brute_force(spark):
    rng = random.Random(10)
    shared = [prose(rng, n, 5000) for n in (55, 60, 80)]
    texts = [prose(rng, rng.randrange(10, 200), 5000) for _ in range(60)]
    for i in range(0, 60, 2):
        texts[i] = f"{texts[i]} {shared[i % 3]}\n{prose(rng, 20, 5000)}"
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = substring_dedup.repeated_passages(docs)
    covered = {}
    for r in found.collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    first, must = {}, set()
    for i, text in rows:
        words = text.split()
        for j in range(len(words) - 49):
            if first.setdefault(tuple(words[j:j + 50]), i) != i:
                must.update((i, j + k) for k in range(50))
    assert {(i, w) for i, c in covered.items() for w in c} == must
    left = {r.doc_id: r.text for r in substring_dedup.cut_passages(docs, found).collect()}
    assert all(left[i] == t for i, t in rows if i not in covered) and all(sum(s in t for t in left.values()) == 1 for s in shared)


@pytest.mark.parametrize("others", [1, 12])
def test_passages_whose_parts_are_elsewhere_are_paired(spark, others):
    """C and D share 70 words; earlier and later documents have the first 45 or the last 45 of them."""
    rng = random.Random(11)
    rows, must = [], set()
    for case in range(12):
        passage = [f"c{case}p{rng.randrange(10**6)}" for _ in range(70)]
        filler = lambda: [f"f{rng.randrange(10**9)}" for _ in range(30)]
        parts = [passage[:45], passage[25:]] * others
        for place, words in enumerate([*parts, passage, passage, *parts]):
            rows.append((1000 * case + place, " ".join([*filler(), *words, *filler()])))
        must.add((1000 * case + len(parts) + 1, 30, 100, 1000 * case + len(parts)))
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r.doc_id, r.start, r.end, r.other_id) for r in found.collect()} == must


def test_passages_with_a_fifth_of_their_words_replaced_are_paired(spark):
    rng = random.Random(12)
    rows = []
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    for case in range(150):
        passage = filler(60)
        edited = list(passage)
        for i in rng.sample(range(60), 12):
            edited[i] = f"e{rng.randrange(10**9)}"
        rows += [(2 * case, " ".join(filler(40) + passage + filler(40))), (2 * case + 1, " ".join(filler(40) + edited + filler(40)))]
    pairs = {tuple(r) for r in substring_dedup.candidate_pairs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(pairs & {(2 * c + 1, 2 * c) for c in range(150)}) >= 0.97 * 150


def test_a_short_chain_does_not_end_the_search():
    """One run of 19 words outscores a passage of many short runs."""
    rng = random.Random(13)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    passage, run = filler(55), filler(19)
    edited = list(passage)
    for i in range(5, 55, 6):
        edited[i] = f"e{rng.randrange(10**9)}"
    a, b = numbers(" ".join(run + filler(40) + edited)), numbers(" ".join(passage + filler(40) + run))
    [p] = substring_dedup.passages(a, b)
    assert (p.start, p.end, p.other_start, p.other_end, p.edits) == (59, 112, 0, 53, 8)


@pytest.mark.parametrize("times", [2, 3, 100])
def test_a_passage_is_found_each_time_a_text_has_it(times):
    rng = random.Random(14)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    passage = filler(60)
    text, want = filler(20) + passage[:30], []
    for _ in range(times):
        text += filler(20)
        want.append((len(text), len(text) + 60, 25, 85))
        text += passage
    found = substring_dedup.passages(numbers(" ".join(text)), numbers(" ".join(filler(25) + passage + filler(15))))
    assert sorted((p.start, p.end, p.other_start, p.other_end) for p in found) == want


@pytest.mark.parametrize("holders", [0, 3, 5, 10, 50])
@pytest.mark.parametrize("edits", [0.0, 0.1, 0.2])
def test_fuzzy_passages_of_common_phrases_are_found(spark, holders, edits):
    """Two documents share six phrases of 12 words in a row, a word of their own between them; each phrase is in others before and behind them.

    `edits` is the share of the passage's words in which the two differ, those between the phrases included.
    """
    rng = random.Random(15)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    rows, cases = [], 20
    for case in range(cases):
        phrases = [filler(12) for _ in range(6)]
        both = []
        for side in (0, 1):
            words = filler(25)
            replaced = set(rng.sample(range(72), max(0, round(edits * 77) - 5))) if side else set()
            for j, p in enumerate(phrases):
                words += [f"e{rng.randrange(10**9)}" if 12 * j + i in replaced else w for i, w in enumerate(p)] + filler(1)
            both.append(" ".join(words + filler(25)))
        place = 10_000 * case
        for k in range(holders):
            for j, p in enumerate(phrases):
                rows += [(place + 10 * k + j, " ".join(filler(30) + p + filler(30))), (place + 5000 + 10 * k + j, " ".join(filler(30) + p + filler(30)))]
        rows += [(place + 4000, both[0]), (place + 4001, both[1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    pairs = {tuple(r) for r in substring_dedup.candidate_pairs(docs).collect()}
    assert len(pairs & {(10_000 * c + 4001, 10_000 * c + 4000) for c in range(cases)}) >= 0.9 * cases
    if edits == 0:
        found = {(r.doc_id, r.other_id) for r in substring_dedup.repeated_passages(docs).collect()}
        assert len(found & {(10_000 * c + 4001, 10_000 * c + 4000) for c in range(cases)}) == cases


def test_every_key_of_hot_seeds_pairs_its_documents(spark):
    """Two documents that share one key of two hot seeds and nothing else are paired, whatever the key's number."""
    rng = random.Random(18)
    rows = []
    for i in range(100):
        a, b = rng.randrange(2**62), rng.randrange(2**62)
        rows += [(2 * i + side, pos, seed) for side in (0, 1) for pos, seed in ((5 * side, a), (5 * side + 12 + i % 33, b))]
    hot = spark.createDataFrame(rows, "doc_id bigint, pos int, seed bigint")
    pairs = {tuple(r) for r in substring_dedup._linked_keys(substring_dedup._key_rows(hot, substring_dedup.FEW), substring_dedup.FEW).collect()}
    assert pairs == {(2 * i + 1, 2 * i) for i in range(100)}


@pytest.mark.parametrize("words", [50, 53, 70])
def test_no_exact_passage_is_lost_to_parts_that_many_have(spark, words):
    """C and D share a passage of which earlier documents have every run of 49 words, so all its seeds and keys are hot."""
    rng = random.Random(19)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    rows, must = [], set()
    for case in range(6):
        passage, place = filler(words), 10_000 * case
        for low in range(words - 48):
            rows += [(place + 100 * low + i, " ".join(filler(30) + passage[low:low + 49] + filler(30))) for i in range(9)]
        rows += [(place + 9000 + side, " ".join(filler(30) + passage + filler(30))) for side in (0, 1)]
        must.add((place + 9001, 30, 30 + words, place + 9000, 30, 30 + words, 0))
    found = {tuple(r) for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert must <= found


def test_edited_passages_are_found_where_earlier_documents_have_only_their_keys(spark):
    """C and D share 60 words but for every third of the last 20. All earlier documents have the first 40, which make all common keys and no passage."""
    rng = random.Random(22)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    rows, must = [], set()
    for case in range(4):
        passage, place = filler(60), 1000 * case
        rows += [(place + i, " ".join(filler(30) + passage[:40] + filler(30))) for i in range(60)]
        edited = list(passage)
        edited[40:60:3] = filler(7)
        rows += [(place + 900 + side, " ".join(filler(30) + words + filler(30))) for side, words in enumerate((passage, edited))]
        must.add((place + 901, 30, 88, place + 900, 30, 88, 6))
    found = {tuple(r) for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert must <= found


@pytest.mark.parametrize("at_once", [1 << 17, 40])
def test_open_keys_meet_all_earlier_documents_in_turns(spark, monkeypatch, at_once):
    """An open document meets the first ones of its key, and goes on with those behind them until it met all; a covered one is met only."""
    monkeypatch.setattr(substring_dedup, "_ROWS_AT_ONCE", at_once)
    rng = random.Random(23)
    rows, must = [], set()
    for place, size in enumerate([1, 2, 3, 9, 10, 50, 200]):
        docs = sorted(rng.sample(range(1000), size))
        open_ = [rng.random() < 0.3 for _ in docs]
        rows += [(place, d, k if o else -1, k + 20 if o else -1) for d, o in zip(docs, open_) for k in ([0, 50] if o else [0])]
        must |= {(d, e) for i, (d, o) in enumerate(zip(docs, open_)) if o for e in docs[:i]}
    left, leaders, met = spark.createDataFrame(rows, substring_dedup._OPEN_ROWS), 3, set()
    while not left.isEmpty():
        linked = substring_dedup._next_pairs(left, leaders).collect()
        pairs = {(r.doc_id, r.other_id) for r in linked if r.other_id is not None}
        assert pairs <= must and (leaders > 3 or len(pairs) < len(must))
        met |= pairs
        left = spark.createDataFrame([(r.place, r.doc_id, r.start, r.end) for r in linked if r.place is not None], substring_dedup._OPEN_ROWS)
        leaders *= 4
    assert met == must


def test_covered_keys_are_told_from_open_ones(spark):
    """Two seeds in one passage, in two that do not hold both, and beside one."""
    hot = spark.createDataFrame([(1, 0, 5), (1, 20, 6), (2, 0, 5), (2, 20, 6), (3, 10, 5), (3, 30, 6), (4, 10, 5), (4, 30, 6)], "doc_id bigint, pos int, seed bigint")
    found = spark.createDataFrame([(1, 0, 24), (2, 0, 23), (2, 1, 60), (3, 0, 25), (3, 9, 34), (5, 0, 90)], "doc_id bigint, start bigint, end bigint")
    rows = substring_dedup._open_keys(hot, found)
    assert sorted((r.doc_id, r.start, r.end) for r in rows.collect()) == [(1, -1, -1), (2, 0, 24), (3, -1, -1), (4, 10, 34)]
    more = spark.createDataFrame([(4, 10, 40)], "doc_id bigint, start bigint, end bigint")
    assert sorted((r.doc_id, r.start) for r in substring_dedup._still_open(rows, more).collect()) == [(1, -1), (2, 0), (3, -1), (4, -1)]
    assert substring_dedup._still_open(rows, more.unionByName(found.selectExpr("doc_id", "start", "end + 1 AS end"))).collect() == []


def test_parts_bound_what_is_moved_at_once(spark, monkeypatch):
    """The same pairs and passages in parts, each of which moves its share of the texts to pairs and of the keys."""
    rng = random.Random(24)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    passages = [filler(60) for _ in range(40)]
    rows = [(i, " ".join(filler(5) + passages[i % 40][:rng.randrange(52, 61)] + filler(5))) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    moved, dealt = [], []
    inner, link = substring_dedup._passage_rows, substring_dedup._linked_keys
    monkeypatch.setattr(substring_dedup, "_passage_rows", lambda pairs, *rest: moved.append(pairs) or inner(pairs, *rest))
    monkeypatch.setattr(substring_dedup, "_linked_keys", lambda rows, few: dealt.append(rows) or link(rows, few))
    monkeypatch.setattr(substring_dedup, "discard", lambda table: None)
    found = []
    for part_of_keys in (10.0**9, 0.5):
        monkeypatch.setattr(substring_dedup, "PART_OF_KEYS", part_of_keys)
        monkeypatch.setattr(substring_dedup, "PART_OF_TEXTS", part_of_keys)
        moved.clear(), dealt.clear()
        found.append(sorted(map(tuple, substring_dedup.repeated_passages(docs).collect())))
    assert found[0] == found[1] and len({r[0] for r in found[0]}) == 960
    assert len(moved) > 1 and max(p.count() for p in moved) <= 0.75 * 1000
    sizes = [r.count() for r in dealt]
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_runs_without_two_rare_seeds_are_keys(spark):
    """Whatever seeds are hot, a run is a key or two of its seeds are rare; the same run is judged alike in both texts."""
    rng = random.Random(20)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    for share in (0.0, 0.5, 0.8, 0.95, 1.0):
        passage = filler(400)
        texts = pa.array([" ".join(filler(17) + passage + filler(9)), " ".join(filler(60) + passage)], pa.large_string())
        words = find_words(texts)
        seeds, owner, pos = substring_dedup.minimizers(words)
        rare = {h for h in set(seeds.tolist()) if rng.random() >= share}
        is_rare = np.array([h in rare for h in seeds.tolist()])
        at = words.bounds[owner] + pos
        mark = np.zeros(len(words.start), bool)
        mark[at[~is_rare]] = True
        hashes, text = substring_dedup.whole_runs(words, mark)
        both = set(hashes[text == 0].tolist()) & set(hashes[text == 1].tolist())
        for low in range(351):
            [run] = run_hashes(words.hashes, words.bounds[:1] + 17 + low, 50).tolist()
            inside = is_rare & (at >= 17 + low) & (at + substring_dedup.K <= 17 + low + 50) & (owner == 0)
            assert run in both or inside.sum() >= 2
        assert share < 1 or len(both) == 351


def test_a_pair_of_many_keys_is_one_row(spark):
    rng = random.Random(21)
    rows = [(doc, pos, seed) for pos, seed in ((4 * i, rng.randrange(2**62)) for i in range(3000)) for doc in range(3)]
    hot = spark.createDataFrame(rows, "doc_id bigint, pos int, seed bigint").coalesce(1)
    linked = substring_dedup._linked_keys(substring_dedup._key_rows(hot, substring_dedup.FEW).coalesce(1), substring_dedup.FEW)
    assert linked.count() <= 3 * linked.rdd.getNumPartitions()


def test_a_passage_of_very_many_documents_costs_its_size(spark):
    """Each is paired with few others, and all but the first lose it."""
    rng = random.Random(16)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    passage = filler(70)
    docs = spark.createDataFrame([(i, " ".join(filler(40) + passage + filler(40))) for i in range(1500)], "doc_id bigint, text string").repartition(5)
    assert substring_dedup.candidate_pairs(docs).count() < 5 * 1500
    left = substring_dedup.cut_passages(docs, substring_dedup.repeated_passages(docs)).collect()
    assert sum(" ".join(passage[5:65]) in r.text for r in left) == 1 and len(left) == 1500


def test_very_long_repetitive_texts_end(spark):
    rng = np.random.default_rng(17)
    few = rng.integers(0, 11, (2, 50_000)).astype(np.uint64)
    log = np.tile(rng.integers(0, 1000, 100), 500).astype(np.uint64)
    shared = rng.integers(10**6, 10**9, 80).astype(np.uint64)
    for a, b in ((few[0], few[1]), (np.concatenate([log, shared]), np.concatenate([shared, log])), (np.concatenate([few[0], shared]), np.concatenate([shared, few[1]]))):
        began = time.time()
        found = substring_dedup.passages(a, b)
        assert time.time() - began < 60
        if len(a) > 50_000:
            assert any(p.start <= 50_000 and p.end == 50_080 and p.other_start == 0 for p in found)


def test_passages_on_odd_and_empty_tables(odd_docs, no_docs):
    found = substring_dedup.repeated_passages(odd_docs)
    assert [(r.doc_id, r.start, r.end, r.other_id, r.other_start, r.other_end, r.edits) for r in found.collect()] == [(6, 0, 70, 5, 80, 150, 0)]
    cut = substring_dedup.cut_passages(odd_docs, found)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert len(cut.where("doc_id = 6").first().text.split()) == 90
    assert substring_dedup.repeated_passages(no_docs).collect() == []
    assert substring_dedup.cut_passages(no_docs, substring_dedup.repeated_passages(no_docs)).collect() == []
