"""Token counts under a unigram vocabulary, with the work shared between pre-tokens that begin alike.

A pre-token is a word with the mark of the space before it. The distinct pre-tokens of a slice of texts form a
trie. The forward state of a prefix (best log-probability, tokens on that best path) depends on nothing behind
it, so it is worked out once per trie node, depth by depth for all nodes of a depth at once; the state of a
terminal node is the word's count. Counts of words already met are kept, and a text's count is the sum over its
words. Texts are not shuffled: a slice's trie is local to its task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import Words, find_words, per_text, prefix_sums, slices, span_hash

MARK = "▁".encode()
FILTER_BITS = 22
# Longer words are split one by one.
LONG_WORD = 64
# Words whose counts are kept in a worker's memory.
MEMORY = 2_000_000
# A character that no piece covers costs this much more than the rarest piece, and counts as its UTF-8 bytes.
UNKNOWN_COST = 10.0


class Pieces:
    """A unigram vocabulary: log-probabilities of pieces, also as arrays sorted by hash.

    It is broadcast, and the counts that a Python worker keeps beside its copy serve all tasks of that worker.
    """

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_COST
        self.longest = max(map(len, scores), default=0)
        raw = [p.encode() for p in scores]
        self.lengths = sorted({len(p) for p in raw})
        self.reach = max([4, *self.lengths]) + 1
        size = np.array([len(p) for p in raw], np.int64)
        end = np.cumsum(size)
        hashes = span_hash(prefix_sums(np.frombuffer(b"".join(raw), np.uint8)), end - size, end)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], np.array(list(scores.values()), float)[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[hashes >> np.uint64(64 - FILTER_BITS)] = True
        self.counter = Counter()


def load_pieces(path: str) -> Pieces:
    """The pieces of a SentencePiece file, most frequent first, with probabilities after Zipf's law.

    Files learned by merging hold an order but no probabilities; control, unknown and byte pieces are left
    out, as they are not text. The file is read on the driver.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = math.log(sum(1 / rank for rank in range(1, len(names) + 1)))
    return Pieces({name: -math.log(rank) - total for rank, name in enumerate(names, 1)})


def best_split(word: str, pieces: Pieces) -> tuple[float, int]:
    """(log-probability, tokens) of the best split of one word; on a tie, of the split with fewer tokens."""
    score, count = [0.0], [0]
    for d in range(1, len(word) + 1):
        best, tokens = score[d - 1] + pieces.unknown, count[d - 1] + len(word[d - 1].encode())
        for length in range(1, min(d, pieces.longest) + 1):
            own = pieces.scores.get(word[d - length:d])
            if own is not None and (own + score[d - length], -count[d - length] - 1) > (best, -tokens):
                best, tokens = own + score[d - length], count[d - length] + 1
        score.append(best)
        count.append(tokens)
    return score[-1], count[-1]


def trie_states(words: list[bytes], pieces: Pieces) -> np.ndarray:
    """(log-probability, tokens) of each of the distinct `words`, given in sorted order.

    Equal prefixes stand together in sorted order, so the nodes of the trie at depth d are the runs of words
    with the same first d bytes. The states are worked out depth by depth for all nodes at once, each node
    from its ancestors at the distances that pieces have. Bytes inside a character are no place to split.
    """
    n = len(words)
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size) - size
    sums = prefix_sums(data)
    inner = np.append((data & 0xC0) == 0x80, False)  # True where a cut before this byte would split a character
    result = np.zeros((n, 2))
    # States of the last depths, by depth: best score and tokens of each node, and the node of each word.
    score, count, node = {0: np.zeros(1)}, {0: np.zeros(1, np.int64)}, {0: np.zeros(n, np.int32)}
    active = np.arange(n)
    for d in range(1, int(size.max(initial=0)) + 1):
        active = active[size[active] >= d]
        prefix = span_hash(sums, start[active], start[active] + d)
        new = np.ones(len(active), bool)
        new[1:] = prefix[1:] != prefix[:-1]
        node[d] = np.zeros(n, np.int32)
        node[d][active] = np.cumsum(new) - 1
        first = active[new]
        end = start[first] + d
        best, tokens = np.full(len(first), -np.inf), np.zeros(len(first), np.int64)
        # A cut is possible where the word ends or another character begins.
        open_ = np.flatnonzero((size[first] == d) | ~inner[end])
        for length in range(1, min(4, d) + 1):  # a character no piece covers
            at = open_[~inner[end[open_] - length]] if length < 2 else open_[_is_character(inner, end[open_], length)]
            back = node[d - length][first[at]]
            best[at] = score[d - length][back] + pieces.unknown
            tokens[at] = count[d - length][back] + length
        for length in pieces.lengths:
            if length > d:
                break
            own = span_hash(sums, end[open_] - length, end[open_])
            likely = np.flatnonzero(pieces.filter[own >> np.uint64(64 - FILTER_BITS)])
            place = np.minimum(np.searchsorted(pieces.hashes, own[likely]), len(pieces.hashes) - 1)
            hit = pieces.hashes[place] == own[likely]
            at, place = open_[likely[hit]], place[hit]
            back = node[d - length][first[at]]
            value, n_tokens = score[d - length][back] + pieces.values[place], count[d - length][back] + 1
            better = (value > best[at]) | ((value == best[at]) & (n_tokens < tokens[at]))
            best[at[better]], tokens[at[better]] = value[better], n_tokens[better]
        score[d], count[d] = best, tokens
        done = active[size[active] == d]
        result[done, 0], result[done, 1] = best[node[d][done]], tokens[node[d][done]]
        for old in (score, count, node):
            old.pop(d - pieces.reach, None)
    return result


def _is_character(inner: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """True where the last `length` bytes before `end` are one character."""
    whole = ~inner[end - length]
    for k in range(1, length):
        whole &= inner[end - k]
    return whole


class Counter:
    """Counts of the words met so far, by word hash; beyond MEMORY words they are worked out again."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.values = np.zeros((0, 2))

    def lookup(self, words: Words, pieces: Pieces) -> np.ndarray:
        """(log-probability, tokens) of each word."""
        hashes = words.hashes
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > MEMORY:
            self.forget()
        at = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != distinct[inside]
        if new.any():
            whole = words.data.tobytes()
            texts = [MARK + whole[words.start[i]:words.end[i]] for i in first[new]]
            values = np.empty((len(texts), 2))
            order = sorted(range(len(texts)), key=texts.__getitem__)
            short = [i for i in order if len(texts[i]) <= LONG_WORD]
            values[short] = trie_states([texts[i] for i in short], pieces)
            for i in order:
                if len(texts[i]) > LONG_WORD:
                    values[i] = best_split(texts[i].decode("utf-8"), pieces)
            where = np.searchsorted(self.hashes, distinct[new])
            self.hashes = np.insert(self.hashes, where, distinct[new])
            self.values = np.insert(self.values, where, values, axis=0)
        return self.values[np.searchsorted(self.hashes, distinct)][place]


def count_tokens(docs: DataFrame, pieces: Pieces, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_tokens, log_prob) for each row of `docs`.

    Null and empty texts have no tokens and log-probability 0; repeated rows are counted each; an empty table
    gives no rows; other columns are not read. The vocabulary has a fixed size and is sent to all tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.value.counter
        for batch in batches:
            for part in slices(batch, "_text"):
                words = find_words(part.column(1))
                values = counter.lookup(words, shared.value)
                tokens = per_text(words.bounds, values[:, 1].astype(np.int64))
                prob = np.bincount(words.text_of, weights=values[:, 0], minlength=words.n_texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words.counts.astype(np.int64)), pa.array(tokens), pa.array(prob.astype(np.float64))],
                    names=[key, "n_words", "n_tokens", "log_prob"],
                )

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, n_words bigint, n_tokens bigint, log_prob double")
