"""Byte-level BPE by prefixes: each prefix of a piece has one valid last token, which is all that encoding has to store.

The encoding of a prefix ends in exactly one token t such that the prefix without t ends, by the same rule, in
a token s whose concatenation with t encodes to s, t. The last tokens of all prefixes thus follow from left to
right, and reading them from the end gives the encoding. A prefix's last token does not depend on what comes
behind it, so text can be appended exactly, pieces that begin alike share their work, and after an edit only
the positions up to where the tokens fall in step again have to be worked out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import binary_rows, mix, prefix_sums, slices, span_hash, text_bytes

# Pieces and token pairs kept in a task's memory; beyond it they are worked out again.
MEMORY = 100_000
# Texts encoded together: the more, the more beginnings their pieces share.
PIECE_BYTES = 1 << 21
LONG_PIECE = 64
FILTER_BITS = 22
NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line. Read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Ranks with what is learned about tokens and pairs while encoding.

    It is broadcast, and the memory that a Python worker fills in its copy serves all tasks of that worker.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.packed = [int(i).to_bytes(4, "little") for i in range(len(self.bytes_of))]
        self.longest = max(map(len, ranks), default=0)
        lengths: dict[bytes, set[int]] = {}
        for token in ranks:
            lengths.setdefault(token[-2:], set()).add(len(token))
        # By the last two bytes: the lengths that a token ending so can have, longest first.
        self.lengths = {last: sorted(found, reverse=True) for last, found in lengths.items()}
        self.pieces: dict[str, bytes] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._edges: dict[int, tuple[list, list]] = {}
        self._arrays: TokenArrays | None = None

    @property
    def arrays(self) -> TokenArrays:
        if self._arrays is None:
            self._arrays = TokenArrays(self)
        return self._arrays

    def merged(self, piece: bytes, until: int = 1) -> list[bytes]:
        """The parts of a piece as the definition has it: join the adjacent parts of lowest rank, leftmost first, down to `until` parts at least."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > until:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self, token: int) -> tuple[list, list]:
        """The parts at the left and at the right end of a token while it forms, each with the rank that ends it; first parts first.

        A token that its own bytes do not encode to has no edges.
        """
        found = self._edges.get(token)
        if found is None:
            whole = self.bytes_of[token]
            parts = self.merged(whole, 2)
            if len(parts) == 1:
                found = ([(whole, NEVER)], [(whole, NEVER)])
            elif len(parts) > 2 or self.ranks.get(parts[0] + parts[1]) != token:
                found = ([], [])
            else:
                left, right = self.edges(self.ranks[parts[0]])[0], self.edges(self.ranks[parts[1]])[1]
                found = ([*left[:-1], (parts[0], token), (whole, NEVER)], [*right[:-1], (parts[1], token), (whole, NEVER)])
            self._edges[token] = found
        return found

    def follows(self, before: int, token: int) -> bool:
        """True if the bytes of `before` and `token`, put together, are encoded as these two tokens.

        Only the parts that face each other can join across the border. Both sides grow in the order of the
        ranks; the border falls if at any moment the two facing parts have a lower rank together than the
        next step of either side (on the right also an equal one, as the leftmost pair goes first).
        """
        pair = (before, token)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= MEMORY:
                self._pairs.clear()
            known = self._pairs[pair] = self._apart(self.edges(before)[1], self.edges(token)[0])
        return known

    def _apart(self, left: list, right: list) -> bool:
        if not left or not right:
            return False
        rank_of, i, j = self.ranks.get, 0, 0
        while True:
            (a, a_ends), (b, b_ends) = left[i], right[j]
            across = rank_of(a + b, NEVER)
            if across < a_ends and across <= b_ends and across != NEVER:
                return False
            if a_ends == b_ends == NEVER:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1


class PrefixEncoder:
    """The last token of every prefix of a piece, kept while the piece changes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = [-1]

    def _last_token(self, end: int) -> int:
        v, piece, last = self.vocabulary, self.piece, self.last
        ranks = v.ranks
        for length in v.lengths.get(piece[end - 2:end], ()) if end > 1 else ():
            if length <= end:
                token = ranks.get(piece[end - length:end])
                if token is not None and (v.follows(last[end - length], token) if length < end else v.edges(token)[0]):
                    return token
        token = ranks.get(piece[end - 1:end])
        if token is None:
            raise ValueError(f"no token for byte {piece[end - 1]}")
        return token

    def append(self, more: bytes) -> None:
        self.piece += more
        for end in range(len(self.last), len(self.piece) + 1):
            self.last.append(self._last_token(end))

    def move_to(self, piece: bytes) -> None:
        """Go to another piece and keep what both share from their beginnings."""
        shared = len(commonprefix((piece, self.piece)))
        del self.last[shared + 1:]
        self.piece = piece[:shared]
        self.append(piece[shared:])

    def edit(self, start: int, end: int, replacement: bytes) -> int:
        """Replace piece[start:end] and return how many positions were worked out anew.

        Once as many positions in a row as the longest token has bytes end in the tokens they had before, all
        further positions do so too.
        """
        tail, old = self.piece[end:], self.last[end + 1:]
        del self.last[start + 1:]
        self.piece = self.piece[:start]
        self.append(replacement)
        self.piece += tail
        agreed, done = 0, 0
        for token in old:
            if agreed >= self.vocabulary.longest:
                break
            self.last.append(self._last_token(len(self.last)))
            agreed = agreed + 1 if self.last[-1] == token else 0
            done += 1
        self.last += old[done:]
        return len(replacement) + done

    def tokens(self) -> list[int]:
        """The encoding of the piece."""
        found, end = [], len(self.piece)
        while end:
            found.append(self.last[end])
            end -= len(self.vocabulary.bytes_of[found[-1]])
        return found[::-1]


class PairTable:
    """Answers of Vocabulary.follows for many pairs at once: a table with one entry per slot, the latest pair of each slot."""

    SLOT_BITS = 21

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.keys = np.full(1 << self.SLOT_BITS, -1, np.int64)
        self.apart = np.zeros(1 << self.SLOT_BITS, bool)

    def follow(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """True where the pair stays apart; before = -1 asks whether the token holds together by itself."""
        keys = (before + 1) << 32 | tokens
        slots = (mix(keys) >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
        answer = self.apart[slots]
        unknown = np.flatnonzero(self.keys[slots] != keys)
        if len(unknown):
            asked, first, place = np.unique(keys[unknown], return_index=True, return_inverse=True)
            v = self.vocabulary
            found = np.array([
                v.follows(b, t) if b >= 0 else bool(v.edges(t)[0])
                for b, t in zip(before[unknown[first]].tolist(), tokens[unknown[first]].tolist(), strict=True)
            ], bool)
            answer[unknown] = found[place]
            self.keys[slots[unknown[first]]], self.apart[slots[unknown[first]]] = asked, found
        return answer


def trie_tokens(pieces: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The encodings of distinct `pieces` in sorted order: flat[bounds[i]:bounds[i + 1]] for piece i.

    Equal beginnings stand together in sorted order, so the prefixes of d bytes are runs of pieces. The last
    tokens are worked out for all prefixes of one length at once, from those of the shorter prefixes.
    """
    n = len(pieces)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces])
    start = np.cumsum(size) - size
    sums = prefix_sums(data)
    v = vocabulary.arrays
    last, node = {0: np.full(1, -1)}, {0: np.zeros(n, np.int32)}
    active = np.arange(n)
    for d in range(1, int(size.max()) + 1):
        active = active[size[active] >= d]
        prefix = span_hash(sums, start[active], start[active] + d)
        new = np.ones(len(active), bool)
        new[1:] = prefix[1:] != prefix[:-1]
        node[d] = np.zeros(n, np.int32)
        node[d][active] = np.cumsum(new) - 1
        first = active[new]
        end = start[first] + d
        last[d] = np.full(len(first), -1)
        open_ = np.arange(len(first))
        for length in reversed(v.lengths):
            if length > d or not len(open_):
                continue
            own = span_hash(sums, end[open_] - length, end[open_])
            likely = np.flatnonzero(v.filter[own >> np.uint64(64 - FILTER_BITS)])
            place = np.minimum(np.searchsorted(v.hashes, own[likely]), len(v.hashes) - 1)
            hit = v.hashes[place] == own[likely]
            at, token = open_[likely[hit]], v.tokens[place[hit]]
            before = last[d - length][node[d - length][first[at]]]
            ok = v.pairs.follow(before, token)
            last[d][at[ok]] = token[ok]
            open_ = open_[last[d][open_] < 0]
    owners, places, tokens = [], [], []
    left = size.copy()
    for d in range(int(size.max()), 0, -1):
        at = np.flatnonzero(left == d)
        token = last[d][node[d][at]]
        left[at] -= v.sizes[token]
        owners.append(at)
        places.append(np.full(len(at), d))
        tokens.append(token)
    owner, token = np.concatenate(owners), np.concatenate(tokens)
    order = np.lexsort((np.concatenate(places), owner))
    return token[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


class TokenArrays:
    """The tokens of a vocabulary sorted by the hash of their bytes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        raw = list(vocabulary.ranks)
        size = np.array([len(t) for t in raw])
        end = np.cumsum(size)
        hashes = span_hash(prefix_sums(np.frombuffer(b"".join(raw), np.uint8)), end - size, end)
        order = np.argsort(hashes)
        self.hashes, self.tokens = hashes[order], np.array(list(vocabulary.ranks.values()))[order]
        self.lengths = sorted(set(size.tolist()))
        self.sizes = np.array([len(t) for t in vocabulary.bytes_of])
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[hashes >> np.uint64(64 - FILTER_BITS)] = True
        self.pairs = PairTable(vocabulary)


class TextEncoder:
    """Encodes texts by pieces, remembering the pieces of one task."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.prefix = PrefixEncoder(vocabulary)
        self.known = vocabulary.pieces

    def learn(self, pieces: set[str]) -> None:
        """Encode new pieces: the short ones together, the few long ones prefix by prefix."""
        ranks, packed = self.vocabulary.ranks, self.vocabulary.packed
        several = []
        for raw, piece in sorted((p.encode(), p) for p in pieces):
            whole = ranks.get(raw)
            if whole is not None:
                self.known[piece] = packed[whole]
            elif len(raw) > LONG_PIECE:
                self.prefix.move_to(raw)
                self.known[piece] = b"".join([packed[token] for token in self.prefix.tokens()])
            else:
                several.append((raw, piece))
        if several:
            flat, bounds = trie_tokens([raw for raw, _ in several], self.vocabulary)
            flat, bounds = flat.astype("<u4").tobytes(), (bounds * 4).tolist()
            for (_, piece), low, high in zip(several, bounds, bounds[1:]):
                self.known[piece] = flat[low:high]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > MEMORY:
            self.known.clear()
        split = [self.split(t) for t in texts]
        new = set().union(*split).difference(self.known)
        if new:
            self.learn(new)
        packed = self.known.__getitem__
        return [b"".join(map(packed, pieces)) for pieces in split]


class TextDecoder:
    """The bytes that ids stand for, for many texts at once."""

    def __init__(self, bytes_of: list[bytes]) -> None:
        self.table = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(n) for n in bytes_of], dtype=np.int64)])

    def decode(self, column: pa.Array) -> pa.Array:
        data, offsets = text_bytes(column.cast(pa.large_binary()))
        ids = np.frombuffer(data.tobytes(), "<u4")
        sizes = self.bounds[ids + 1] - self.bounds[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        source = np.arange(ends[-1]) + np.repeat(self.bounds[ids] - ends[:-1], sizes)
        return binary_rows(self.table[source], ends[offsets // 4]).cast(pa.binary())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) for each row of `docs`: token ids as little-endian unsigned 32-bit integers in one binary value.

    Special tokens' strings are ordinary text. Null texts are encoded as empty ones; repeated rows are encoded
    each; an empty table gives no rows; other columns are not read. The ranks (some 50,000) go to all tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(shared.value, pattern)
        for batch in batches:
            for part in slices(batch, "_text", PIECE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(encoder.encode(part.column(1).to_pylist()), pa.binary())], names=[key, "ids"])

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, ranks: dict[bytes, int], key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the bytes that the ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(ranks).bytes_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = TextDecoder(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), decoder.decode(part.column(1))], names=[key, "ids", "decoded"])

    rows = encoded.select(key, "ids")
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) for each row of `docs`: `encode` and then `decode` of its ids, in one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = TextEncoder(shared.value, pattern), TextDecoder(shared.value.bytes_of)
        for batch in batches:
            for part in slices(batch, "_text", PIECE_BYTES):
                ids = pa.array(encoder.encode(part.column(1).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, decoder.decode(ids)], names=[key, "ids", "decoded"])

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, ids binary, decoded binary")
