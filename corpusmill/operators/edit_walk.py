"""All terms of a dictionary within an edit distance of each of many words, by one walk over two tries.

The words of a batch and the terms are tries, kept as arrays. The walk goes down the words' trie level by level and
holds, for each node there, the nodes of the terms' trie whose strings are within the distance of its string, with
that distance: a bounded edit-distance automaton whose states are shared by all words with a common start. A step
reads one more character of the words: deleted, matched, replaced, or swapped with the one before it (which
looks two levels back); characters that only the term has are added within a level. Edits are insertion, deletion,
replacement and swap of neighbours, no place edited twice. Nodes whose words and terms can no longer come to lengths within
the distance are dropped. Every pair within the distance is reached, as each prefix pair of its cheapest edits is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Room for a code point beside the number of a node.
_CHAR_BITS = 21
# States that are held at once, for about 30 times as many candidates for the next level.
STATES = 100_000


class Trie:
    """Nodes by level, those of a level by parent and character; node 0 is the empty string."""

    def __init__(self, strings: list[str]) -> None:
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        node = np.zeros(len(strings), np.int64)
        keys, levels, depth = [np.full(1, -1)], [0, 1], 0
        left = np.flatnonzero(sizes > 0)
        while len(left):
            key = node[left] << _CHAR_BITS | flat[begin[left] + depth]
            distinct, which = np.unique(key, return_inverse=True)
            node[left] = levels[-1] + which
            keys.append(distinct)
            levels.append(levels[-1] + len(distinct))
            depth += 1
            left = left[sizes[left] > depth]
        #: (parent, character) of each node but the root, which makes them sorted; levels[d]:levels[d + 1] are those of depth d
        self.keys = np.concatenate(keys)
        self.levels = levels
        self.parent = self.keys >> _CHAR_BITS
        self.char = self.keys & ((1 << _CHAR_BITS) - 1)
        n = levels[-1]
        self.child = np.searchsorted(self.parent, np.arange(n + 1))
        self.child[0] = min(1, n)
        self.children = np.diff(self.child)
        #: number of the string that ends at a node, or -1
        self.string = np.full(n, -1)
        self.string[node] = np.arange(len(strings))
        # The least and the most characters from a node to the end of a string below it.
        self.least = np.where(self.string >= 0, 0, np.iinfo(np.int32).max).astype(np.int64)
        self.most = np.zeros(n, np.int64)
        for d in range(len(levels) - 2, 0, -1):
            own = np.arange(levels[d], levels[d + 1])
            np.minimum.at(self.least, self.parent[own], self.least[own] + 1)
            np.maximum.at(self.most, self.parent[own], self.most[own] + 1)

    def find(self, nodes: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows that have a child by their character, that child)."""
        key = nodes << _CHAR_BITS | chars
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rows = np.flatnonzero(self.keys[at] == key)
        return rows, at[rows]

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, child) for each child of each node."""
        count = self.children[nodes]
        rows = np.repeat(np.arange(len(nodes)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return rows, self.child[nodes[rows]] + offset


def _least(u: np.ndarray, v: np.ndarray, e: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair of nodes once, with its least distance."""
    packed = np.unique((u * n_terms + v) << 3 | e)
    pair = packed >> 3
    first = np.ones(len(pair), bool)
    first[1:] = pair[1:] != pair[:-1]
    pair = pair[first]
    return pair // n_terms, pair % n_terms, packed[first] & 7


def walk(words: list[str], terms: Trie, most: int, states: int = STATES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word, term, distance) of all pairs with a distance of at most `most` (up to 7), those of a word together; words are distinct."""
    asked = Trie(words)
    n, n_asked = len(terms.keys), len(asked.keys)

    def possible(u: np.ndarray, v: np.ndarray, e: np.ndarray) -> np.ndarray:
        apart = np.maximum(asked.least[u] - terms.most[v], terms.least[v] - asked.most[u])
        return np.maximum(apart, 0) + e <= most

    def settle(u: np.ndarray, v: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """With the characters that only terms have."""
        keep = possible(u, v, e)
        u, v, e = _least(u[keep], v[keep], e[keep], n)
        new_u, new_v, new_e = u, v, e
        for _ in range(most):
            open_ = new_e < most
            rows, child = terms.below(new_v[open_])
            new_u, new_v, new_e = new_u[open_][rows], child, new_e[open_][rows] + 1
            keep = possible(new_u, new_v, new_e)
            new_u, new_v, new_e = new_u[keep], new_v[keep], new_e[keep]
            if not len(new_u):
                break
            u, v, e = np.concatenate([u, new_u]), np.concatenate([v, new_v]), np.concatenate([e, new_e])
        return _least(u, v, e, n)

    def ends(u: np.ndarray, v: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word, term = asked.string[u], terms.string[v]
        at = np.flatnonzero((word >= 0) & (term >= 0))
        return word[at], term[at], e[at]

    def within(states: tuple[np.ndarray, np.ndarray, np.ndarray], low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The states, which go by node, of the nodes from `low` to `high`."""
        a, b = np.searchsorted(states[0], [low, high])
        return tuple(x[a:b] for x in states)

    zero = np.zeros(1, np.int64)
    start = settle(zero, zero, zero)
    yield ends(*start)
    waiting = [(None, start)]
    while waiting:
        before, now = waiting.pop()
        nodes = now[0]
        if not len(nodes):
            continue
        if len(nodes) > states and nodes[0] != nodes[-1]:
            # Cut between two nodes near the middle; parents of both shares go with both.
            cut = int(nodes[len(nodes) // 2])
            cut += cut == nodes[0]
            for low, high in ((cut, n_asked), (0, cut)):
                part = within(now, low, high)
                above = None if before is None else within(before, asked.parent[part[0][0]], asked.parent[part[0][-1]] + 1)
                waiting.append((above, part))
            continue
        u, v, e = now
        rows, next_u = asked.below(u)
        v, e, c = v[rows], e[rows], asked.char[next_u]
        same, child = terms.find(v, c)
        parts = [(next_u[same], child, e[same])]
        if most:
            open_ = np.flatnonzero(e < most)
            parts.append((next_u[open_], v[open_], e[open_] + 1))
            rows, child = terms.below(v[open_])
            parts.append((next_u[open_][rows], child, e[open_][rows] + 1))
        if before is not None and most:
            open_ = before[2] < most
            u2, v2, e2 = (x[open_] for x in before)
            rows, middle = asked.below(u2)
            # A parent of nodes of two shares is seen by each with its own.
            own = (middle >= u[0]) & (middle <= u[-1])
            rows, middle = rows[own], middle[own]
            v2, e2 = v2[rows], e2[rows]
            rows, last = asked.below(middle)
            middle, v2, e2 = middle[rows], v2[rows], e2[rows]
            rows, child = terms.find(v2, asked.char[last])
            last, middle, e2 = last[rows], middle[rows], e2[rows]
            rows, child = terms.find(child, asked.char[middle])
            parts.append((last[rows], child, e2[rows] + 1))
        after = settle(*(np.concatenate(x) for x in zip(*parts)))
        yield ends(*after)
        waiting.append((now, after))
