import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import byte_bpe, token_counts
from corpusmill.llm.queries import BYTE_RANKS, PIECES, encode_and_decode

RANKS = byte_bpe.load_ranks(public_tokenizers.path(BYTE_RANKS))
VOCABULARY = byte_bpe.Vocabulary(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
UNIGRAM = token_counts.load_pieces(public_tokenizers.path(PIECES))
SIGNS = st.text(st.one_of(st.sampled_from("etaoin shrdlu'stre\n\t  ééñ1239.!?日本語  \x1c"), st.characters(exclude_categories=("Cs",))), max_size=80)


def library(text):
    return np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(SIGNS, min_size=1, max_size=5))
def test_ids_are_those_of_the_library(texts):
    assert byte_bpe.TextEncoder(VOCABULARY, public_tokenizers.PATTERN).encode(texts) == [library(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=90), st.data())
def test_appending_and_editing_give_the_encoding_of_the_whole(piece, data):
    encoder = byte_bpe.PrefixEncoder(VOCABULARY)
    cut = data.draw(st.integers(0, len(piece)))
    encoder.append(piece[:cut])
    encoder.append(piece[cut:])
    plain = lambda p: [RANKS[x] for x in VOCABULARY.merged(p)]
    assert encoder.tokens() == plain(piece)
    start = data.draw(st.integers(0, len(piece)))
    end, new = data.draw(st.integers(start, len(piece))), data.draw(st.binary(max_size=6))
    encoder.edit(start, end, new)
    changed = piece[:start] + new + piece[end:]
    assert encoder.piece == changed and encoder.tokens() == plain(changed)


def test_an_edit_works_out_only_what_is_near():
    text = " ".join(random.Random(1).choices(["lower", "thing", "nation", "over"], k=2000)).encode()
    encoder = byte_bpe.PrefixEncoder(VOCABULARY)
    encoder.append(text)
    assert encoder.edit(500, 503, b"zz") < 1000
    assert len(encoder.last) == len(encoder.piece) + 1
    fresh = byte_bpe.PrefixEncoder(VOCABULARY)
    fresh.append(encoder.piece)
    assert encoder.last == fresh.last


def test_long_pieces(spark):
    texts = ["a" * 3000, " " * 2000 + "b", "é" * 700, "1" * 999, "!?" * 400]
    assert byte_bpe.TextEncoder(VOCABULARY, public_tokenizers.PATTERN).encode(texts) == [library(t) for t in texts]


def test_odd_and_empty_tables_round_trip(odd_docs, no_docs):
    rows = byte_bpe.decode(byte_bpe.encode(odd_docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert sorted(map(str, rows)) == sorted(map(str, byte_bpe.round_trip(odd_docs, RANKS, public_tokenizers.PATTERN).collect()))
    want = sorted((r.doc_id or -1, r.text or "") for r in odd_docs.collect())
    assert sorted((r.doc_id or -1, r.decoded.decode()) for r in rows) == want
    assert sorted(bytes(r.ids) for r in rows) == sorted(library(t) for _, t in want)
    assert encode_and_decode(no_docs).collect() == []


def splits(word, pieces):
    """Every split of a word by its definition: pieces, or a single character that no piece has to cover."""
    if not word:
        yield 0.0, 0
    for n in range(1, len(word) + 1):
        head = word[-n:]
        for score, tokens in splits(word[:-n], pieces):
            if head in pieces.scores:
                yield score + pieces.scores[head], tokens + 1
            if n == 1:
                yield score + pieces.unknown, tokens + len(head.encode())


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(st.sampled_from("ab▁é日"), min_size=1, max_size=8), min_size=1, max_size=8))
def test_trie_states_are_the_best_of_all_splits(words):
    pieces = token_counts.Pieces({"a": -1.0, "b": -1.5, "ab": -2.5, "aba": -2.25, "▁": -0.5, "▁a": -1.5, "é": -1.0, "éb": -4.0, "bé": -2.0})
    ordered = sorted(w.encode() for w in words)
    for word, (score, tokens) in zip(ordered, token_counts.trie_states(ordered, pieces).tolist(), strict=True):
        assert (score, -tokens) == max((s, -n) for s, n in splits(word.decode(), pieces))
        assert (score, tokens) == token_counts.best_split(word.decode(), pieces)


def test_counts_of_texts(spark, odd_docs, no_docs):
    rows = token_counts.count_tokens(odd_docs, UNIGRAM).collect()
    want = []
    for r in odd_docs.collect():
        words = (r.text or "").replace("\n", " ").replace("\t", " ").split(" ")
        each = [token_counts.best_split("▁" + w, UNIGRAM) for w in words if w]
        want.append((r.doc_id or -1, len(each), sum(n for _, n in each)))
    assert sorted((r.doc_id or -1, r.n_words, r.n_tokens) for r in rows) == sorted(want)
    assert token_counts.count_tokens(no_docs, UNIGRAM).collect() == []


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMORY", 3)
    counter = token_counts.Counter()
    words = token_counts.find_words(pa.array(["over the hills", "and over", "hills and far away"], pa.large_string()))
    first = counter.lookup(words, UNIGRAM)
    assert (counter.lookup(words, UNIGRAM) == first).all()
