"""Operator 13, byte-level byte-pair encoding and decoding.

A text is cut into pieces by a pattern; inside a piece, the neighbouring pair of
the least rank is merged, the leftmost of equals first, until no pair has a rank.
A segment tree over the piece's byte positions stores the least pair rank of each
span. Its root says which merge is next, a descent that prefers the left child
finds the leftmost such pair, and a merge changes three leaves: those of the
merged pair, of the neighbour that is gone and of the live neighbour before. A
piece of n bytes costs O(n log n). The distinct short pieces of a window have
their trees side by side in arrays, and take a merge each in every step.

Ids are packed as little-endian unsigned 32-bit integers, the layout of token
files; ``token_list`` makes arrays of them.

Null text counts as empty and has no ids. Rows stay where they are: nothing is
shuffled, dropped or joined, so repeated rows, null ids, empty tables and hot
groups are ordinary. A new column whose name an input column has gets leading
underscores. A very long text is read in windows that end where the pattern must
end a piece anyway, so beyond the text and its ids a task holds one window's
pieces. One piece without such a place (megabytes of letters) is a single merge
problem and takes about 30 bytes for each of its bytes.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.arrow import with_kernel

# Characters of a text, and ids, that are taken at once.
WINDOW = 1 << 20
# Distinct pieces whose ids a Python worker remembers from one window to the next.
REMEMBERED = 1 << 18
# Leaves of the trees that are worked on many at a time.
SHORT = 64

_NO_RANK = (1 << 31) - 1
# Between a character that is no space and a single space before another such
# character: a pattern that takes a leading space into the next piece ends here.
_CUT = regex.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by rank, which is the id, and the pattern that makes pieces.

    ``cuttable`` says that a piece never goes on after a character that is no
    white space into a single space; only then long texts are read in windows.
    """

    ranks: dict[bytes, int]
    pattern: str
    cuttable: bool = True

    def __post_init__(self):
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"Vocabulary without the bytes {missing[:5]}")


def read_vocabulary(path: str, pattern: str, cuttable: bool = True) -> Vocabulary:
    """The vocabulary of a rank file: base64 token, space, rank in each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern, cuttable)


def merge_piece(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one piece by a segment tree of leftmost least pair ranks."""
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    find = ranks.get
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = array("i", [_NO_RANK]) * (2 * size)
    for i in range(n - 1):
        tree[size + i] = find(piece[i : i + 2], _NO_RANK)
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    # Of a live token: where the next one starts, and the one before it.
    after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))

    def put(leaf: int, rank: int) -> None:
        i = size + leaf
        tree[i] = rank
        while i > 1:
            other = tree[i ^ 1]
            i >>= 1
            least = rank if rank < other else other
            if tree[i] == least:
                return
            tree[i] = rank = least

    def pair_rank(start: int, end: int) -> int:
        return find(piece[start:end], _NO_RANK) if end - start <= longest else _NO_RANK

    while (least := tree[1]) != _NO_RANK:
        i = 1
        while i < size:
            i *= 2
            if tree[i] != least:
                i += 1
        i -= size
        gone = after[i]
        end = after[gone]
        after[i] = end
        if end < n:
            put(gone, _NO_RANK)
            before[end] = i
            put(i, pair_rank(i, after[end]))
        else:
            put(i, _NO_RANK)
        if before[i] >= 0:
            put(before[i], pair_rank(before[i], end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


def _pair_ranks(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of ids whose bytes make a token, as sorted keys, and the token's rank."""
    found = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[left << 32 | right] = rank
    keys = np.fromiter(found.keys(), np.int64, len(found))
    values = np.fromiter(found.values(), np.int32, len(found))
    order = np.argsort(keys)
    # One more key than any pair has, so that a search always ends on an entry.
    return np.append(keys[order], np.iinfo(np.int64).max), np.append(values[order], _NO_RANK).astype(np.int32)


class _Merger:
    """``merge_piece`` for many short pieces at once: a row of the arrays is a piece with its tree."""

    def __init__(self, ranks: dict[bytes, int]):
        self.keys, self.values = _pair_ranks(ranks)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray, live: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(live & (self.keys[at] == key), self.values[at], _NO_RANK)

    def merge(self, pieces: list[bytes], size: int) -> list[list[int]]:
        """Ids of pieces of 2 to ``size`` + 1 bytes; ``size`` is a power of two."""
        rows, width = len(pieces), size + 2
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(rows, width)
        n = np.array([len(p) for p in pieces])
        ids = self.of_byte[raw]
        place = np.arange(width)
        after, before = np.tile(place + 1, (rows, 1)), np.tile(place - 1, (rows, 1))
        tree = np.full((rows, 2 * size), _NO_RANK, np.int32)
        tree[:, size:] = self.pair_rank(ids[:, :size], ids[:, 1 : size + 1], place[:size] < n[:, None] - 1)
        level = size
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        row = np.flatnonzero(tree[:, 1] != _NO_RANK)
        while len(row):
            least = tree[row, 1]
            node = np.ones(len(row), np.int64)
            for _ in range(size.bit_length() - 1):
                node = 2 * node + (tree[row, 2 * node] != least)
            at = node - size
            gone = after[row, at]
            end = after[row, gone]
            ids[row, at] = least
            after[row, at] = end
            before[row, end] = at
            tree[row, size + np.minimum(gone, size - 1)] = _NO_RANK
            tree[row, node] = self.pair_rank(least.astype(np.int64), ids[row, np.minimum(end, width - 1)], end < n[row])
            previous = before[row, at]
            live = previous >= 0
            # Without a previous token the merged pair's own leaf is written once more.
            other = np.where(live, previous, at)
            tree[row, size + other] = np.where(
                live, self.pair_rank(ids[row, other], least.astype(np.int64), live), tree[row, node]
            )
            nodes = [node, size + np.minimum(gone, size - 1), size + other]
            for _ in range(size.bit_length() - 1):
                nodes = [k >> 1 for k in nodes]
                for k in nodes:
                    tree[row, k] = np.minimum(tree[row, 2 * k], tree[row, 2 * k + 1])
            row = row[tree[row, 1] != _NO_RANK]
        result = []
        for of_piece, following, length in zip(ids.tolist(), after.tolist(), n.tolist()):
            i, found = 0, []
            while i < length:
                found.append(of_piece[i])
                i = following[i]
            result.append(found)
        return result


class _Encoder(dict):
    """Packed ids by piece, of the pieces met so far."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.ranks, self.cuttable = vocabulary.ranks, vocabulary.cuttable
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(vocabulary.pattern)
        self.merger = _Merger(self.ranks)

    def windows(self, text: str) -> Iterator[str]:
        start = 0
        while self.cuttable and len(text) - start > WINDOW:
            cut = _CUT.search(text, start + WINDOW)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def learn(self, pieces: set[str]) -> None:
        """Work out the ids of pieces, short ones together with those of like length."""
        classes = defaultdict(list)
        for piece in pieces:
            raw = piece.encode()
            if raw in self.ranks:
                self[piece] = struct.pack("<I", self.ranks[raw])
            else:
                classes[max(2, 1 << (len(raw) - 2).bit_length())].append((piece, raw))
        for size, members in classes.items():
            raws = [raw for _, raw in members]
            if size <= SHORT:
                merged = self.merger.merge(raws, size)
            else:
                merged = [merge_piece(raw, self.ranks, self.longest) for raw in raws]
            for (piece, _), ids in zip(members, merged):
                self[piece] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Packed ids of each text; the pieces of about a window's characters are held at a time."""
        packed: list[list[bytes]] = []
        waiting: list[tuple[int, list[str]]] = []
        chars = 0

        def flush() -> None:
            nonlocal chars
            met = set().union(*(pieces for _, pieces in waiting))
            self.learn({piece for piece in met if piece not in self})
            for text, pieces in waiting:
                packed[text].append(b"".join(map(self.__getitem__, pieces)))
            waiting.clear()
            chars = 0
            if len(self) > REMEMBERED:
                self.clear()

        for text in texts:
            packed.append([])
            for window in self.windows(text):
                waiting.append((len(packed) - 1, self.pattern.findall(window)))
                chars += len(window)
                if chars >= WINDOW:
                    flush()
        flush()
        return [b"".join(parts) for parts in packed]


def _on_worker(sent: Broadcast, made: dict, make):
    """What ``make`` builds from the vocabulary, once in a Python worker."""
    if not made:
        made[0] = make(sent.value)
    return made[0]


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """The frame plus the text's packed ids, without special tokens."""
    # As large as the vocabulary's file, whatever the table holds.
    sent, made = df.sparkSession.sparkContext.broadcast(vocabulary), {}

    def kernel(column: pa.Array) -> list[pa.Array]:
        encoder = _on_worker(sent, made, _Encoder)
        return [pa.array(encoder.encode(x.as_py() or "" for x in column), pa.binary())]

    return with_kernel(df, text, T.StructType().add(ids, T.BinaryType()), kernel)


def _token_bytes(vocabulary: Vocabulary) -> list[bytes | None]:
    tokens: list[bytes | None] = [None] * (max(vocabulary.ranks.values()) + 1)
    for token, rank in vocabulary.ranks.items():
        tokens[rank] = token
    return tokens


def _decode(packed: bytes, tokens: list[bytes | None]) -> bytes:
    ids = np.frombuffer(packed, "<u4")
    try:
        return b"".join(b"".join(map(tokens.__getitem__, ids[i : i + WINDOW].tolist())) for i in range(0, len(ids), WINDOW))
    except (IndexError, TypeError):
        raise ValueError("An id that the vocabulary does not have") from None


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """The frame plus the bytes of the packed ids; null ids have none. Unknown ids raise."""
    sent, made = df.sparkSession.sparkContext.broadcast(vocabulary), {}

    def kernel(column: pa.Array) -> list[pa.Array]:
        tokens = _on_worker(sent, made, _token_bytes)
        return [pa.array((_decode(x.as_py() or b"", tokens) for x in column), pa.binary())]

    return with_kernel(df, ids, T.StructType().add(decoded, T.BinaryType()), kernel)


def token_count(ids: Column) -> Column:
    """How many ids are packed."""
    return F.shiftright(F.octet_length(ids), 2).cast("long")


def token_list(ids: Column) -> Column:
    """Packed ids as an array of longs."""
    digits = F.hex(ids)

    def one(i: Column) -> Column:
        low_first = [F.substr(digits, i * 8 + 1 + 2 * k, F.lit(2)) for k in range(4)]
        return F.conv(F.concat(*reversed(low_first)), 16, 10).cast("long")

    empty = F.array().cast("array<long>")
    return F.when(token_count(ids) == 0, empty).otherwise(
        F.transform(F.sequence(F.lit(0), F.shiftright(F.octet_length(ids), 2) - 1), one)
    )
