"""All ways to write many words by pieces, side by side as one graph in arrays."""

from __future__ import annotations

import numpy as np


class Lattice:
    """Words laid out one behind the other: nodes are the places between characters, arcs the pieces that fit there.

    A word of n characters that begins at node `at` owns the nodes at ... at + n. Where no piece of one character fits, an
    arc of unknown text with the number -1 goes on. Arcs are worked through by the distance of their end from the
    start of its word, for all words at once, so the steps are as many as the longest word has characters.
    """

    def __init__(
        self, at: np.ndarray, sizes: np.ndarray, source: np.ndarray, length: np.ndarray, piece: np.ndarray, score: np.ndarray,
        unknown: float, proper: bool = False,
    ) -> None:
        """`at` and `source` count along a layout that may have gaps; arcs in gaps are left out, and if `proper` also whole words."""
        self.order = np.argsort(at, kind="stable")
        at, self.sizes = at[self.order], sizes[self.order]
        self.end = np.cumsum(self.sizes + 1) - 1
        self.at = self.end - self.sizes
        self.total = int(self.end[-1]) + 1 if len(self.end) else 0
        self.word = np.repeat(np.arange(len(at)), self.sizes + 1)
        self.level = np.arange(self.total) - self.at[self.word]

        word = np.searchsorted(at, source, "right") - 1
        inside = word >= 0
        inside[inside] = source[inside] < (at + self.sizes)[word[inside]]
        if proper:
            inside[inside] = length[inside] < self.sizes[word[inside]]
        word, length, piece, score = word[inside], length[inside], piece[inside], score[inside]
        source = self.at[word] + source[inside] - at[word]
        served = self.level == self.sizes[self.word]
        served[source[length == 1]] = True
        alone = np.flatnonzero(~served)
        self.source = np.concatenate([source, alone])
        self.target = np.concatenate([source + length, alone + 1])
        self.piece = np.concatenate([piece, np.full(len(alone), -1)])
        self.score = np.concatenate([score, np.full(len(alone), unknown)])

    def _steps(self, near: np.ndarray, far: np.ndarray, rank: np.ndarray):
        """Arcs in order of the rank of their far node; per step the arcs, where each far node's arcs begin, and these nodes."""
        order = np.lexsort((near, far, rank[far]))
        ranks, nodes = rank[far[order]], far[order]
        heads = np.flatnonzero(np.diff(nodes, prepend=-1))
        cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
        for begin, end in zip(cuts, np.append(cuts[1:], len(order))):
            low, high = np.searchsorted(heads, (begin, end))
            own = heads[low:high]
            yield order[begin:end], own - begin, nodes[own]

    def _sums(self, near: np.ndarray, far: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The logarithm of the sum over all paths from an end of the word to each node."""
        value = np.zeros(self.total)
        for arcs, heads, nodes in self._steps(near, far, rank):
            reached = value[near[arcs]] + self.score[arcs]
            highest = np.maximum.reduceat(reached, heads)
            many = np.diff(np.append(heads, len(reached)))
            value[nodes] = highest + np.log(np.add.reduceat(np.exp(reached - np.repeat(highest, many)), heads))
        return value

    def expected(self, weight: np.ndarray, n_pieces: int) -> np.ndarray:
        """Per piece, how often all words use it, by the probability of each way to write a word."""
        if not self.total:
            return np.zeros(n_pieces)
        forward = self._sums(self.source, self.target, self.level)
        backward = self._sums(self.target, self.source, self.sizes[self.word] - self.level)
        word = self.word[self.source]
        share = np.exp(forward[self.source] + self.score + backward[self.target] - forward[self.end[word]])
        known = self.piece >= 0
        return np.bincount(self.piece[known], (share * weight[self.order][word])[known], n_pieces)

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, piece) for each arc of the most probable way to write each word; of equal ones, that whose last pieces are longest."""
        value, back = np.zeros(self.total), np.full(self.total, -1)
        for arcs, heads, nodes in self._steps(self.source, self.target, self.level):
            reached = value[self.source[arcs]] + self.score[arcs]
            highest = np.maximum.reduceat(reached, heads)
            group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(reached))))
            first = np.flatnonzero(reached == highest[group])
            _, chosen = np.unique(group[first], return_index=True)
            value[nodes], back[nodes] = highest, arcs[first[chosen]]
        words, pieces = [], []
        at, word = self.end, np.arange(len(self.end))
        while len(at):
            arcs = back[at]
            on = arcs >= 0
            arcs, word = arcs[on], word[on]
            words.append(self.order[word])
            pieces.append(self.piece[arcs])
            at = self.source[arcs]
        return np.concatenate(words or [np.zeros(0, int)]), np.concatenate(pieces or [np.zeros(0, int)])
