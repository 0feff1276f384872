"""Byte-level BPE: a segment tree over byte positions finds the leftmost pair of least rank."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeworks.llm.common import Memory, give_back, slices

# stretches and pieces whose ids a Python worker remembers, twice that many of each at most
CACHE = 300_000
# bytes of text that are cut into stretches at once; a stretch in hand takes many times its bytes
SLICE = 1 << 20
# bytes of the longest piece that is merged beside others
LONG = 64
# stands above every rank
NONE = 2**40

# fixed values: the code points that Unicode calls white space, as the body of a character class
WHITE = (
    r"\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    r"\u200a\u2028\u2029\u202f\u205f\u3000"
)
# A stretch is a run without white space and the blank before it, or white space that nothing follows
# closely. No match of a pattern of the usual form reaches over the end of a stretch.
STRETCH = rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, blank, rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the leftmost pair of least rank is merged until no pair has a rank.

    A leaf of the tree belongs to the position where a live part starts and holds the rank of the
    pair of that part and its right neighbour; an inner node holds the least of its two children, the
    left one on a tie. A merge changes three leaves, so a piece of n bytes takes O(n log n).
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    none = len(ranks) + 1
    size = 1 << max(0, (n - 1).bit_length())
    get = ranks.get
    tree = [none] * (2 * size)
    tree[size : size + n - 1] = [get(piece[i : i + 2], none) for i in range(n - 1)]
    for node in range(size - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a <= b else b
    after = list(range(1, n + 1))  # start of the right neighbour
    before = list(range(-1, n - 1))

    while tree[1] < none:
        node, least = 1, tree[1]
        while node < size:
            node *= 2
            if tree[node] != least:
                node += 1
        left = node - size
        gone = after[left]
        right = after[gone]
        after[left] = right
        changed = [(gone, none), (left, none)]
        if right < n:
            before[right] = left
            changed[1] = (left, get(piece[left : after[right]], none))
        if left:
            first = before[left]
            changed.append((first, get(piece[first:right], none)))
        for leaf, rank in changed:
            node = size + leaf
            tree[node] = rank
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                if b < a:
                    a = b
                if tree[node] == a:
                    break
                tree[node] = a
                node >>= 1
    ids, start = [], 0
    while start < n:
        ids.append(ranks[piece[start : after[start]]])
        start = after[start]
    return ids


class PairTable:
    """Rank of the pair of two token ids, for whole arrays of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        get = ranks.get
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[key] for key in self.keys.tolist()] + [NONE], dtype=np.int64)
        self.keys = np.append(self.keys, np.int64(2**62))

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of every pair, NONE where the two do not merge."""
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def merge_pieces(pieces: list[bytes], singles: np.ndarray, table: PairTable) -> list[bytes]:
    """``merge_piece`` for many pieces of like length at once: one tree per row, one merge per step.

    The id of a merged part is the rank of its pair, so parts are kept as ids. ``singles`` has the id
    of every byte. Returns each piece's ids as little-endian 32-bit integers.
    """
    lengths = np.array([len(x) for x in pieces])
    n = int(lengths.max())
    size = 1 << max(1, (n - 1).bit_length())
    width = np.arange(n)
    live = width < lengths[:, None]
    part = np.zeros((len(pieces), n + 1), dtype=np.int64)
    part[:, :n][live] = singles[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    after = np.tile(np.arange(1, n + 2), (len(pieces), 1))
    before = np.tile(np.arange(-1, n), (len(pieces), 1))
    tree = np.full((len(pieces), 2 * size), NONE, dtype=np.int64)
    paired = width[:-1] + 1 < lengths[:, None]
    leaves = tree[:, size : size + n - 1]
    leaves[paired] = table.find(part[:, : n - 1][paired], part[:, 1:n][paired])
    level = size
    while level > 1:
        pairs = tree[:, level : 2 * level]
        tree[:, level // 2 : level] = np.minimum(pairs[:, ::2], pairs[:, 1::2])
        level //= 2
    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        least = tree[rows, 1]
        node = np.ones(len(rows), dtype=np.int64)
        while node[0] < size:
            node *= 2
            node += tree[rows, node] != least
        left = node - size
        gone = after[rows, left]
        right = after[rows, gone]
        first = before[rows, left]
        part[rows, left] = least
        after[rows, left] = right
        live[rows, gone] = False
        more, less = right < lengths[rows], first >= 0
        before[rows[more], right[more]] = left[more]
        behind = np.where(more, table.find(least, part[rows, np.minimum(right, n)]), NONE)
        ahead = np.where(less, table.find(part[rows, np.maximum(first, 0)], least), NONE)
        for who, leaf, rank in (
            (rows, gone, np.full(len(rows), NONE)),
            (rows, left, behind),
            (rows[less], first[less], ahead[less]),
        ):
            node = size + leaf
            tree[who, node] = rank
            for _ in range(size.bit_length() - 1):
                node >>= 1
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
        rows = rows[tree[rows, 1] < NONE]
    ids = part[:, :n][live].astype("<u4").tobytes()
    ends = (4 * np.cumsum(live.sum(axis=1))).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Codec:
    """Encoder and decoder of one vocabulary; remembers the ids of what it has met lately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.stretch = re.compile(STRETCH).findall
        self.table = PairTable(ranks)
        self.singles = np.array([ranks.get(bytes([i]), 0) for i in range(256)], dtype=np.int64)
        self.stretches, self.pieces = Memory(CACHE), Memory(CACHE)
        words = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            words[rank] = token
        self.lengths = np.array([len(x) for x in words], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(words), dtype=np.uint8)

    def _merge(self, pieces: list[str]) -> list[bytes]:
        raw = [x.encode() for x in pieces]
        found: list[bytes | None] = [None] * len(raw)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(raw):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONG:
                found[i] = np.array(merge_piece(piece, self.ranks), dtype="<u4").tobytes()
            else:
                by_size.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for places in by_size.values():
            for start in range(0, len(places), 20_000):
                some = places[start : start + 20_000]
                merged = merge_pieces([raw[i] for i in some], self.singles, self.table)
                for i, ids in zip(some, merged, strict=True):
                    found[i] = ids
        return found

    def _stretches(self, stretches: list[str]) -> list[bytes]:
        # a blank and letters only are one piece under the pattern's letter rule
        cut = [[x] if x[x[0] == " " :].isalpha() else self.split(x) for x in stretches]
        ids = self.pieces.look_up({piece for pieces in cut for piece in pieces}, self._merge)
        return [b"".join([ids[piece] for piece in pieces]) for pieces in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        cut = [self.stretch(x) for x in texts]
        ids = self.stretches.look_up(set().union(*cut), self._stretches)
        return [b"".join(map(ids.__getitem__, stretches)) for stretches in cut]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that such ids stand for."""
        ids = np.frombuffer(ids, dtype="<u4")
        lengths = self.lengths[ids]
        shift = self.starts[ids] - (np.cumsum(lengths) - lengths)
        return self.bytes[np.repeat(shift, lengths) + np.arange(lengths.sum())].tobytes()


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids binary, decoded binary) of every row.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` the bytes they stand for. Each
    match of ``pattern`` is encoded by itself, special tokens are ordinary text. Null counts as empty:
    no ids. The rank file is read on the driver (its size is that of the vocabulary) and broadcast, so
    executors need no copy. A task holds one batch of texts, and the stretches of SLICE bytes of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": read_ranks(ranks_path)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value  # the same object for all tasks of a Python worker
        if "codec" not in model:
            model["codec"] = Codec(model["ranks"], pattern)
        codec = model["codec"]
        for batch in batches:
            for first, end in slices(batch.column(1), SLICE):
                part = batch.slice(first, end - first)
                ids = codec.encode([x or "" for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([codec.decode(x) for x in ids], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )
            del batch
        give_back()

    asked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return asked.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what ``encode_texts`` returns."""
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


