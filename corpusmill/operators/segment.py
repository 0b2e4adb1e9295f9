"""Segmentation of one word with a known vocabulary: the small helpers used inside tasks.

`pieces` maps a token to (id, score), `ranks` maps a pair of tokens to its merge rank. A result is a list
of ids, with `unk_id` for what the vocabulary cannot express (nothing if `unk_id` is null).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from hashlib import blake2b
from heapq import heapify, heappop, heappush
from math import inf
from typing import Any

Pieces = dict[str, tuple[int, float | None]]
Ranks = dict[tuple[str, str], int]

# Fixed value: the unknown character's distance below the worst score.
UNK_PENALTY = 10.0


def whole_word(word: str, pieces: Pieces, ranks: Ranks, unk_id: int | None, **_: Any) -> list[int]:
    found = pieces.get(word)
    return [found[0]] if found else [] if unk_id is None else [unk_id]


def byte_pairs(
    word: str, pieces: Pieces, ranks: Ranks, unk_id: int | None, fuse_unk: bool = False,
    continuing_subword_prefix: str = "", end_of_word_suffix: str = "", dropout: float = 0.0, draws: Iterator[float] | None = None, **_: Any,
) -> list[int]:
    """Apply the merges by rank, leftmost first. With `draws` the next merge is passed over with probability `dropout`."""
    prefix = continuing_subword_prefix
    symbols: list[str | None] = []
    for i, c in enumerate(word):
        s = (prefix if i else "") + c + (end_of_word_suffix if i == len(word) - 1 else "")
        if s in pieces:
            symbols.append(s)
        elif unk_id is not None and not (fuse_unk and symbols and symbols[-1] is None):
            symbols.append(None)
    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    queue = [(ranks[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapify(queue)
    gone = [False] * len(symbols)
    passed: list[tuple] = []
    while queue:
        if draws is not None and next(draws) < dropout:
            passed.append(heappop(queue))
            continue
        _rank, i, left, right = heappop(queue)
        # What was passed over has another chance after each merge that is looked at.
        for merge in passed:
            heappush(queue, merge)
        passed.clear()
        j = after[i]
        if gone[i] or j < 0 or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i] = left + (right[len(prefix):] if prefix and right.startswith(prefix) else right)
        gone[j], after[i] = True, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (symbols[a], symbols[b]) in ranks:
                heappush(queue, (ranks[symbols[a], symbols[b]], a, symbols[a], symbols[b]))
    return [unk_id if s is None else pieces[s][0] for s, g in zip(symbols, gone) if not g]


def draws_of(seed: int, key: str, place: int) -> Iterator[float]:
    """Numbers from 0 to 1 that depend on nothing but a seed, the key of a row and the place of a word in it."""
    turn = 0
    while True:
        block = blake2b(f"{seed}:{place}:{turn}:{key}".encode(), digest_size=64).digest()
        for at in range(0, 64, 8):
            yield int.from_bytes(block[at:at + 8], "big") / 2.0**64
        turn += 1


def word_pieces(
    word: str, pieces: Pieces, ranks: Ranks, unk_id: int | None, longest: int = 0,
    continuing_subword_prefix: str = "##", max_input_chars_per_word: int = 100, **_: Any,
) -> list[int]:
    """The longest token that fits, again and again; the whole word is unknown if that gets stuck.

    Words above `max_input_chars_per_word` are unknown without a look; 100 is the published default.
    """
    unknown = [] if unk_id is None else [unk_id]
    if len(word) > max_input_chars_per_word:
        return unknown
    ids, start = [], 0
    while start < len(word):
        for end in range(min(len(word), start + longest), start, -1):
            found = pieces.get((continuing_subword_prefix if start else "") + word[start:end])
            if found:
                break
        else:
            return unknown
        ids.append(found[0])
        start = end
    return ids


def best_path(word: str, pieces: Pieces, longest: int, unk_score: float) -> list[tuple[int, int, bool]]:
    """The most probable cut of a word as (start, end, known)."""
    best = [(0.0, 0, True)] + [(-inf, -1, True)] * len(word)
    for start in range(len(word)):
        base, single = best[start][0], False
        for end in range(start + 1, min(len(word), start + longest) + 1):
            found = pieces.get(word[start:end])
            if found:
                single |= end == start + 1
                if base + found[1] > best[end][0]:
                    best[end] = (base + found[1], start, True)
        if not single and base + unk_score > best[start + 1][0]:
            best[start + 1] = (base + unk_score, start, False)
    cuts, end = [], len(word)
    while end > 0:
        _, start, known = best[end]
        cuts.append((start, end, known))
        end = start
    return cuts[::-1]


def most_probable(
    word: str, pieces: Pieces, ranks: Ranks, unk_id: int | None, longest: int = 0, lowest: float = 0.0, **_: Any
) -> list[int]:
    ids: list[int] = []
    unknown_before = False
    for start, end, known in best_path(word, pieces, longest, lowest - UNK_PENALTY):
        if known:
            ids.append(pieces[word[start:end]][0])
        elif unk_id is not None and not unknown_before:
            ids.append(unk_id)
        unknown_before = not known
    return ids


class Matcher:
    """All pieces that end at each character of a word, longest first, in one pass.

    A state is the longest end of what was read that begins a piece; its failure link leads to the next shorter one, its
    output link to the next shorter one that is a piece.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.piece: list[tuple[int, int, float] | None] = [None]
        for text, (number, score) in pieces.items():
            at = 0
            for c in text:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.piece.append(None)
                at = self.next[at][c]
            if text:
                self.piece[at] = (len(text), number, score)
        self.fail, self.output = [0] * len(self.next), [0] * len(self.next)
        waiting = deque(self.next[0].values())
        while waiting:
            at = waiting.popleft()
            for c, child in self.next[at].items():
                back = self.fail[at]
                while back and c not in self.next[back]:
                    back = self.fail[back]
                self.fail[child] = self.next[back].get(c, 0)
                waiting.append(child)
            shorter = self.fail[at]
            self.output[at] = shorter if self.piece[shorter] else self.output[shorter]

    def best_path(self, word: str, unk_score: float) -> list[tuple[int, int, int | None]]:
        """The most probable cut of a word as (start, end, number of the piece or null)."""
        best: list[tuple[float, int, int | None]] = [(0.0, 0, None)]
        at = 0
        for end, c in enumerate(word, 1):
            while at and c not in self.next[at]:
                at = self.fail[at]
            at = self.next[at].get(c, 0)
            found, single = (-inf, -1, None), False
            state = at if self.piece[at] else self.output[at]
            while state:
                size, number, score = self.piece[state]
                single = size == 1
                if best[end - size][0] + score > found[0]:
                    found = (best[end - size][0] + score, end - size, number)
                state = self.output[state]
            if not single and best[end - 1][0] + unk_score > found[0]:
                found = (best[end - 1][0] + unk_score, end - 1, None)
            best.append(found)
        cuts, end = [], len(word)
        while end > 0:
            _, start, number = best[end]
            cuts.append((start, end, number))
            end = start
        return cuts[::-1]


def unigram_reader(pieces: Pieces, ranks: Ranks, unk_id: int | None, lowest: float = 0.0, **_: Any) -> Callable[[str], list[int]]:
    """`most_probable` for many words."""
    matcher = Matcher(pieces)

    def read(word: str) -> list[int]:
        ids: list[int] = []
        unknown_before = False
        for _start, _end, number in matcher.best_path(word, lowest - UNK_PENALTY):
            if number is not None:
                ids.append(number)
            elif unk_id is not None and not unknown_before:
                ids.append(unk_id)
            unknown_before = number is None
        return ids

    return read


class LongestMatch:
    """Longest match again and again, in one pass over a word.

    A trie holds the pieces for the start of a word, another those that continue one. Where a state cannot go on, its failure
    link names the pieces that are then certain, and the state that the characters behind them lead to.
    """

    START, GO_ON = 0, 1

    def __init__(self, pieces: Pieces, prefix: str) -> None:
        self.next: list[dict[str, int]] = [{}, {}]
        piece: dict[int, int] = {}
        for text, (number, _) in pieces.items():
            for root, part in ((self.START, text), (self.GO_ON, text[len(prefix):] if text.startswith(prefix) else "")):
                at = root
                for c in part:
                    if c not in self.next[at]:
                        self.next[at][c] = len(self.next)
                        self.next.append({})
                    at = self.next[at][c]
                if part:
                    piece[at] = number
        self.fail: list[int | None] = [None] * len(self.next)
        # The pieces of a failure as a linked list from the last to the first.
        self.certain: list[tuple | None] = [None] * len(self.next)
        waiting = deque([self.START, self.GO_ON])
        while waiting:
            at = waiting.popleft()
            for c, child in self.next[at].items():
                waiting.append(child)
                if child in piece:
                    self.fail[child], self.certain[child] = self.GO_ON, (None, [piece[child]])
                    continue
                back, certain = self.fail[at], self.certain[at]
                while back is not None and c not in self.next[back]:
                    certain, back = (certain, self._list(self.certain[back])), self.fail[back]
                if back is not None:
                    self.fail[child], self.certain[child] = self.next[back][c], certain

    @staticmethod
    def _list(certain: tuple | None) -> list[int]:
        parts = []
        while certain is not None:
            certain, own = certain
            parts.append(own)
        return [n for own in reversed(parts) for n in own]

    def read(self, word: str) -> list[int] | None:
        """The numbers of the pieces, null if the match gets stuck."""
        at, ids = self.START, []
        for c in word:
            while c not in self.next[at]:
                back = self.fail[at]
                if back is None:
                    return None
                ids += self._list(self.certain[at])
                at = back
            at = self.next[at][c]
        while word and at != self.GO_ON:
            back = self.fail[at]
            if back is None:
                return None
            ids += self._list(self.certain[at])
            at = back
        return ids


def wordpiece_reader(
    pieces: Pieces, ranks: Ranks, unk_id: int | None, continuing_subword_prefix: str = "##", max_input_chars_per_word: int = 100, **_: Any
) -> Callable[[str], list[int]]:
    """`word_pieces` for many words."""
    matcher, unknown = LongestMatch(pieces, continuing_subword_prefix), [] if unk_id is None else [unk_id]

    def read(word: str) -> list[int]:
        ids = None if len(word) > max_input_chars_per_word else matcher.read(word)
        return unknown if ids is None else ids

    return read


SEGMENTERS: dict[str, Callable[..., list[int]]] = {
    "word_level": whole_word,
    "bpe": byte_pairs,
    "wordpiece": word_pieces,
    "unigram": most_probable,
}

# For tasks that cut up many words with one vocabulary: what is worked out of it once, as a function of a word.
READERS: dict[str, Callable[..., Callable[[str], list[int]]]] = {"unigram": unigram_reader, "wordpiece": wordpiece_reader}


def reader(kind: str, pieces: Pieces, ranks: Ranks, **constants: Any) -> Callable[[str], list[int]]:
    if kind in READERS:
        return READERS[kind](pieces, ranks, **constants)
    return lambda word: SEGMENTERS[kind](word, pieces, ranks, **constants)
