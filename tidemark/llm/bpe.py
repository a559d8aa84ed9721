"""Byte-level BPE encoding and decoding (operator 7).

A text is split by the vocabulary's pattern. Each pre-token is resolved in two
tiers: ``PerfectHash``, a minimal perfect hash over the vocabulary's byte
strings, gives the slot of the only token it can be, and one comparison of the
bytes decides; a miss is merged over its bytes by ``merge``, a heap of
(rank, position) over a doubly linked list. Pre-tokens repeat, so a worker
keeps the ids of those that it has met (``PieceTable``, bounded; it starts
anew when full). Ids are gathered per text with numpy.

Defined results: a null text is empty and has no ids; repeated rows, also of
one doc_id, each give their own row; an empty table gives an empty result;
other columns are ignored. Memory follows the longest text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb

#: Distinct chunks or pre-tokens kept by a worker.
MAX_PIECES = 500_000


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in content.splitlines() if line)}


class PerfectHash:
    """Minimal perfect hash (hash and displace): n distinct byte strings to
    the slots 0..n-1. Groups of strings with one primary hash get, largest
    first, the least displacement that sends all to free slots; a group of one
    is given a free slot outright (stored as its negative)."""

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.groups = max(1, n // 3)
        h = self.hashes(keys)
        group = (h % np.uint64(self.groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(self.groups + 1))
        sizes = np.diff(cuts)
        self.shift = np.zeros(self.groups, np.int64)
        slot_of = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        for size in range(int(sizes.max(initial=0)), 1, -1):
            open_groups = np.flatnonzero(sizes == size)
            d = 0
            while len(open_groups):
                members = order[cuts[open_groups][:, None] + np.arange(size)]
                slots = self._place(h[members], d)
                ranked = np.sort(slots, axis=1)
                good = free[slots].all(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                claimed, first = np.unique(slots[good], return_index=True)
                ours = np.zeros(int(good.sum()) * size, bool)  # of groups that want one slot, the first gets it
                ours[first] = True
                placed = np.flatnonzero(good)[ours.reshape(-1, size).all(axis=1)]
                slot_of[members[placed]] = slots[placed]
                free[slots[placed]] = False
                self.shift[open_groups[placed]] = d
                open_groups = np.delete(open_groups, placed)
                d += 1
        rest = np.flatnonzero(slot_of < 0)
        slot_of[rest] = np.flatnonzero(free)
        self.shift[group[rest]] = -1 - slot_of[rest]
        self.slot_of = slot_of

    def _place(self, h: np.ndarray, d) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = tb.mix(h + np.asarray(d).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return (x % np.uint64(self.n)).astype(np.int64)

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        ends = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)))
        data = np.frombuffer(b"".join(keys), np.uint8)
        return tb.span_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The slot of each key, were it a member."""
        h = self.hashes(keys)
        d = self.shift[(h % np.uint64(self.groups)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._place(h, np.maximum(d, 0)))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: the adjacent pair of least rank is merged first, the
    leftmost of equals. Parts are linked by the positions of their starts."""
    n = len(piece)
    get = ranks.get
    none = 1 << 40
    rank = [get(piece[i:i + 2], none) for i in range(n - 1)]
    rank.append(none)  # of the pair that starts here
    heap = [r << 32 | i for i, r in enumerate(rank) if r < none]
    heapq.heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    while heap:
        x = heapq.heappop(heap)
        i = x & 0xFFFFFFFF
        if rank[i] != x >> 32:  # an older pair of this place
            continue
        j = after[i]
        end = after[i] = after[j]
        rank[j] = -1
        before[end] = i
        r = rank[i] = get(piece[i:after[end]], none) if end < n else none
        if r < none:
            heapq.heappush(heap, r << 32 | i)
        p = before[i]
        if p >= 0:
            r = rank[p] = get(piece[p:end], none)
            if r < none:
                heapq.heappush(heap, r << 32 | p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Vocabulary:
    """Ranks, their perfect hash, and the bytes and decimal text of each id."""

    def __init__(self, content: bytes, pattern: str):
        self.ranks = parse_ranks(content)
        self.pattern = pattern
        tokens = list(self.ranks)
        self.hash = PerfectHash(tokens)
        self.slot_token = [b""] * len(tokens)
        for t, s in zip(tokens, self.hash.slot_of):
            self.slot_token[s] = t
        size = max(self.ranks.values()) + 1
        by_id = [b""] * size
        for t, r in self.ranks.items():
            by_id[r] = t
        self.bytes = Spans(by_id)
        self.decimal = Spans([b"%d " % i for i in range(size)])

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        if not pieces:
            return []
        token, ranks = self.slot_token, self.ranks
        return [[ranks[p]] if token[s] == p else merge(p, ranks)
                for p, s in zip(pieces, self.hash.slots(pieces).tolist())]


class Spans:
    """Byte strings laid end to end."""

    def __init__(self, parts: list[bytes]):
        self.lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        return tb.gather(self.data, self.starts[ids], self.lengths[ids]).tobytes()


class PieceTable(dict):
    """Piece to row number; rows hold ids, flat. New pieces are resolved
    together by ``settle``."""

    def __init__(self, encode, limit: int = MAX_PIECES):
        super().__init__()
        self.encode, self.limit = encode, limit
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.rows = 0
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 13, np.int32)
        self.used = 0

    def __missing__(self, piece: str) -> int:
        row = self[piece] = self.rows + len(self.new)
        self.new.append(piece)
        return row

    def begin(self) -> None:
        """Before a slice: a full table starts anew."""
        if self.rows > self.limit:
            self._reset()

    def resolve(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' ids, flat, and each piece's number of ids."""
        found = self.encode(pieces)
        return np.fromiter(chain.from_iterable(found), np.int32), np.fromiter(map(len, found), np.int64, len(found))

    def settle(self) -> None:
        if not self.new:
            return
        ids, lengths = self.resolve(self.new)
        total, rows = len(ids), self.rows + len(lengths)
        if rows > len(self.starts):
            self.starts = np.resize(self.starts, 2 * rows)
            self.lengths = np.resize(self.lengths, 2 * rows)
        if self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + total))
        self.lengths[self.rows:rows] = lengths
        self.starts[self.rows:rows] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used:self.used + total] = ids
        self.used += total
        self.rows = rows
        self.new = []

    def look_up(self, rows: np.ndarray) -> np.ndarray:
        return tb.gather(self.ids, self.starts[rows], self.lengths[rows])


#: Strings with which a text doesn't fall apart at its single spaces and line
#: ends: the other characters of ``\s``, its longer runs, and the mark below.
_ODD = [chr(c) for c in (0x09, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                         0x202F, 0x205F, 0x3000)] + ["  ", " \n", "\n ", "\n\n", "\0"]


def chunks(text: str) -> list[str] | None:
    """The text cut before each space and around each line end, where the
    pattern never matches across: a chunk without its leading space, or a line
    end, or (marked by NUL) a chunk that has no leading space. None for a text
    with other white space."""
    if any(x in text for x in _ODD) or text[:1] in " \n" or text[-1:] in " \n":
        return None
    return ("\0" + text).replace("\n", " \n \0").split(" ")


def _chunk_text(chunk: str) -> str:
    return chunk if chunk == "\n" else chunk[1:] if chunk[:1] == "\0" else " " + chunk


#: Vocabularies and piece tables of this Python worker, by content.
_LOADED: dict[str, tuple] = {}


def _load(content: bytes, pattern: str):
    """Vocabulary, table of chunks, table of pre-tokens, compiled pattern."""
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    if key not in _LOADED:
        v, compiled = Vocabulary(content, pattern), regex.compile(pattern)

        def encode_chunks(new: list[str]) -> list[list[int]]:
            split = [compiled.findall(_chunk_text(c)) for c in new]
            number: dict[str, int] = {}
            for s in split:
                for p in s:
                    number.setdefault(p, len(number))
            found = v.encode_pieces([p.encode() for p in number])
            return [found[number[s[0]]] if len(s) == 1 else [i for p in s for i in found[number[p]]] for s in split]

        _LOADED[key] = (v, PieceTable(encode_chunks),
                        PieceTable(lambda new: v.encode_pieces([p.encode() for p in new])), compiled)
    return _LOADED[key]


def encode_texts(texts: list[str], content: bytes, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, flat, and each text's number of ids."""
    _, by_chunk, by_piece, compiled = _load(content, pattern)
    by_chunk.begin()
    by_piece.begin()
    rows = []
    for text in texts:
        table, found = by_chunk, chunks(text)
        if found is None:
            table, found = by_piece, compiled.findall(text)
        rows.append((table, np.fromiter(map(table.__getitem__, found), np.int64, len(found))))
    by_chunk.settle()
    by_piece.settle()
    parts = [table.look_up(r) for table, r in rows]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate(parts) if parts else np.empty(0, np.int32), counts


def decode_ids(ids: np.ndarray, content: bytes, pattern: str) -> bytes:
    return _load(content, pattern)[0].bytes.join(ids)


_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(docs: DataFrame, content: bytes, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of decimal ids joined by one
    space), decoded_sha256 (of the bytes decoded from the ids), and with
    ``with_ids`` the ids themselves.

    ``content`` is the rank file (about 1 MB, sent to the executors once),
    ``pattern`` the splitting pattern."""
    shared = docs.sparkSession.sparkContext.broadcast(content)
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = shared.value
        vocabulary = _load(content, pattern)[0]
        for batch in batches:
            column = batch.column("text")
            for lo, hi, _, _ in tb.slices(column, 2 << 20):
                texts = ["" if t is None else t for t in column.slice(lo, hi - lo).to_pylist()]
                ids, counts = encode_texts(texts, content, pattern)
                cuts = np.concatenate([[0], np.cumsum(counts)])
                decimal, decoded = [], []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    own = ids[a:b]
                    decimal.append(hashlib.sha256(vocabulary.decimal.join(own)[:-1]).hexdigest())
                    decoded.append(hashlib.sha256(vocabulary.bytes.join(own)).hexdigest())
                arrays = [batch.column("doc_id").slice(lo, hi - lo), pa.array(counts), pa.array(decimal, pa.string()),
                          pa.array(decoded, pa.string())]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, schema)
