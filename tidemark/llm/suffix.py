"""Suffix-array dedup (operator 3): bytes covered by a string of ``length``
bytes that also starts earlier in the corpus.

``repeat_classes`` is the method: of a text with unique separators it takes the
suffix array and its Burrows-Wheeler transform, and expands suffix intervals
breadth first by backward extension. Level by level this fixes the common
prefixes of neighbouring suffixes by increasing value; it stops at ``length``.
Boundaries that are then still open lie between suffixes with equal first
``length`` bytes.

One suffix array of the corpus would fit no task, so equal strings are brought
together first. Each window of ``length`` bytes belongs to its *anchor*, the
least hash of its ``gram``-byte strings, which depends on nothing else. A text
is a sequence of runs of windows with one anchor. Runs that are equal byte for
byte count once (the earliest stays, within a task before the shuffle and by
anchor after it); only anchors that have different runs, or one that repeats
within itself, go to the suffix array, where their windows are compared. Of
these, a run goes only if it may share a window with another: windows of one
anchor at one place of them have the same bytes around it, so runs carry a hash
of the bytes that all windows of a quarter of the places have (a *core*), and
one that shares no core shares no window. In a large corpus most different runs
of an anchor share little more than its string. An
anchor with over ``heavy`` such runs (the edge of a passage that very many
texts share) is dealt out by whole windows instead of whole runs.

Order is by (doc_id, hash of the text, byte). Defined results: a null or short
text loses nothing; a null doc_id sorts first; rows that repeat one doc_id with
other texts are texts of their own; rows equal in both are one text and each
gets its result; an empty table gives an empty result; other columns are kept
by ``dedup_documents`` and ignored otherwise. Memory follows the longest text
and a share of the shuffle, not the number of copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textbytes as tb
from tidemark.session import materialize

#: Runs of one anchor are cut at so many windows (periodic text).
_LONGEST_RUN = 4096
#: Runs that a task gathers before it drops those it has met and sends the rest.
_BLOCK_ROWS = 400_000
#: Bytes of runs in one suffix array (a larger anchor has one for itself).
_BATCH_BYTES = 1 << 19

#: Classes of the anchor's place in a window, each with a core.
_CORES = 4
#: Core of a class in which the run has no window; of a run in which the
#: anchor's string occurs more than once (its windows have no one place).
_NO_CORE, _ANY_CORE = 0, 1

_RUN = np.dtype([("anchor", "<u4"), ("hash", "<u8"), ("start", "<u4"), ("n", "<u2"), ("text", "<u4"), ("own", "?"),
                 ("cores", "<u4", (_CORES,))])
_TEXT = np.dtype([("id", "<i8"), ("key", "<i8")])
_PIECE = np.dtype([("group", "<u8"), ("id", "<i8"), ("key", "<i8"), ("start", "<u4"), ("size", "<u4")])
_MARKS = "kind int, id long, key long, start int, stop int, anchor long"


# -- the method ------------------------------------------------------------

def _sorted_with(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys of so many bits, and the keys in it. With the index in
    their free bits, numbers are sorted instead of indices."""
    room = len(key).bit_length()
    if bits + room > 63:
        by = np.argsort(key)
        return by, key[by]
    key = np.sort(key << room | np.arange(len(key)))
    return key & ((1 << room) - 1), key >> room


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; unique separators end all
    comparisons.

    The first round compares as many symbols as a number holds, the later ones
    only suffixes that are still equal to another. The least codes count as
    separators where each occurs once and they ascend: suffixes that are equal
    up to one are in order of their positions."""
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    if codes.max() > 4 * n + 1024:
        codes = np.unique(codes, return_inverse=True)[1]
    counts, place = np.bincount(codes), np.empty(int(codes.max()) + 1, np.int64)
    place[codes] = np.arange(n)
    there = np.flatnonzero(counts)
    ends = counts[there] == 1
    ends[1:] &= np.diff(place[there]) > 0
    letters = there[len(there) if ends.all() else np.argmin(ends):]
    symbol = np.zeros(len(counts), np.int64)
    symbol[letters] = np.arange(1, len(letters) + 1)
    bits, index = max(1, len(letters).bit_length()), n.bit_length()
    width = min(n, max(1, (63 - index) // bits))
    x = symbol[codes]
    left = np.where(x == 0, np.arange(n), n)
    left = np.minimum.accumulate(left[::-1])[::-1] - np.arange(n)  # symbols before the next separator
    key = np.zeros(n, np.int64)
    for k in range(width):
        key[:n - k] |= x[k:] << bits * (width - 1 - k)
    past = bits * (width - np.minimum(left, width))
    order, key = _sorted_with(key >> past << past, bits * width)
    rank = np.empty(n, np.int64)  # of a suffix: the first row of those that are equal to it so far
    new = np.ones(n + 1, bool)
    new[1:n] = key[1:] != key[:-1]
    rank[order] = np.flatnonzero(new[:n])[np.cumsum(new[:n]) - 1]
    rows = np.flatnonzero(~(new[:-1] & new[1:]))
    while len(rows):
        at = order[rows]
        then = np.where(left[at] < width, at, rank[np.minimum(at + width, n - 1)])
        by, key = _sorted_with(rank[at] << index | then, 2 * index)
        at = at[by]
        order[rows] = at
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        rank[at] = rows[np.flatnonzero(new[:-1])[np.cumsum(new[:-1]) - 1]]
        rows = rows[~(new[:-1] & new[1:])]
        width *= 2
    return order


def repeat_classes(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(suffix array, class of each of its rows)``: rows of one class have
    equal first ``length`` codes. The last code is a separator, and separators
    are unique."""
    n = len(codes)
    sa = suffix_array(codes)
    inverse = np.empty(n, np.int64)
    inverse[sa] = np.arange(n)
    back = inverse[sa - 1]  # the row of the suffix with the transform's symbol before it
    first = codes[sa]
    known = np.zeros(n + 1, bool)  # of a row: its common prefix with the row before is known
    known[0] = known[n] = True
    edges = np.flatnonzero(first[1:] != first[:-1]) + 1
    known[edges] = True
    lo, hi = np.concatenate([[0], edges]), np.concatenate([edges, [n]])
    for _ in range(length - 1):
        one = hi - lo == 1
        single = back[lo[one]]
        lo, hi = lo[~one], hi[~one]
        sizes = hi - lo
        rows = tb.gather(back, lo, sizes)
        key = np.sort(np.repeat(np.arange(len(lo)), sizes) << 32 | rows)
        rows = key & 0xFFFFFFFF
        cut = np.ones(len(key), bool)
        cut[1:] = (key[1:] >> 32 != key[:-1] >> 32) | (first[rows[1:]] != first[rows[:-1]])
        at = np.flatnonzero(cut)
        lo = np.concatenate([single, rows[at]])
        hi = np.concatenate([single + 1, rows[np.concatenate([at[1:], [len(rows)]]) - 1] + 1 if len(rows) else rows])
        fresh = ~known[hi]
        lo, hi = lo[fresh], hi[fresh]
        if not len(lo):
            break
        known[hi] = True
    return sa, np.cumsum(known[:n]) - 1


# -- runs of windows with one anchor ------------------------------------------

def _slide(x: np.ndarray, width: int, take) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = take(x[:-span], x[span:])
        span *= 2
    return take(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of windows of one anchor: text, first byte (in the text), number of
    windows, anchor, hash of the bytes, whether the anchor's string occurs
    twice in the run (only then can two windows of it be equal), and cores."""
    n, width = len(data), length - gram + 1
    none = np.empty(0, np.int64)
    if n < length:
        return (none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool),
                np.empty((0, _CORES), np.uint32))
    up, down = tb._Pow.get(n + 1)
    with np.errstate(over="ignore"):
        c = np.empty(n + 1, np.uint64)
        c[0] = 0
        np.cumsum(tb._BYTE[data] * up[:n], out=c[1:])
        g = tb.mix((c[gram:] - c[:-gram]) * down[:n - gram + 1])
    least = _slide(g, width, np.minimum)
    inner = offsets[1:-1]
    across = np.zeros(len(least) + 1, np.int32)
    np.add.at(across, np.minimum(np.maximum(inner - length + 1, 0), len(least)), 1)
    np.add.at(across, np.minimum(inner, len(least)), -1)
    valid = np.cumsum(across[:-1]) == 0
    other = np.ones(len(least), bool)
    other[1:] = least[1:] != least[:-1]
    change = other.copy()
    change[1:] |= valid[1:] != valid[:-1]
    starts = np.flatnonzero(change)
    count = np.diff(np.append(starts, len(least)))
    turn = np.cumsum(other[starts]) - 1  # of the least value, whatever the texts
    good = valid[starts]
    starts, count, turn = starts[good], count[good], turn[good]
    parts = -(-count // _LONGEST_RUN)
    if len(parts) and parts.max() > 1:
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        count = np.minimum(np.repeat(count, parts) - k * _LONGEST_RUN, _LONGEST_RUN)
        starts, turn = np.repeat(starts, parts) + k * _LONGEST_RUN, np.repeat(turn, parts)
    text = np.searchsorted(offsets, starts, "right") - 1
    hashes = tb.span_hashes(data, starts, starts + count + length - 1)
    # positions that are the least of some window; equal neighbours make a run repeat
    most = _slide(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    chosen = np.flatnonzero(g == most)
    again = (g[chosen[1:]] == g[chosen[:-1]]) & (np.diff(chosen) <= width)
    at = chosen[:-1][again]
    own = np.zeros(len(starts), bool)
    if len(at) and len(starts):
        limit = offsets[np.searchsorted(offsets, at, "right")] - length
        own[np.maximum(np.searchsorted(starts, np.minimum(at, limit), "right") - 1, 0)] = True
    # the least value moves on where its place does, so its turns and the places of one value correspond
    first = np.ones(len(chosen), bool)
    first[1:] = g[chosen[1:]] != g[chosen[:-1]]
    first = np.flatnonzero(first)
    single = (np.diff(np.append(first, len(chosen))) == 1)[turn]
    own &= ~single
    cores = _cores(c, down, starts, count, chosen[first[turn]], single, length, gram)
    return text, starts - offsets[text], count, least[starts], hashes, own, cores


def _cores(c: np.ndarray, down: np.ndarray, starts: np.ndarray, count: np.ndarray, place: np.ndarray, single: np.ndarray,
           length: int, gram: int) -> np.ndarray:
    """Per run and class of places a hash of the bytes that all windows of the
    class have. ``c``: sums of the bytes' polynomial; ``place`` of the anchor's
    string, if it is the single one. Equal bytes have equal hashes, others may."""
    cores = np.full((len(starts), _CORES), _NO_CORE, np.uint32)
    free = length - gram + 1
    for k in range(_CORES):
        lo, hi = k * free // _CORES, (k + 1) * free // _CORES  # bytes of a window before its anchor's string
        has = single & (np.maximum(lo, place - starts - count + 1) <= np.minimum(hi - 1, place - starts))
        a, b = place[has] - lo, place[has] + length - hi + 1
        with np.errstate(over="ignore"):
            cores[has, k] = np.maximum(tb.mix((c[b] - c[a]) * down[a]) >> np.uint64(32), np.uint64(_ANY_CORE + 1))
    cores[~single] = _ANY_CORE
    return cores


def _ranges(order_keys: tuple[np.ndarray, ...], start: np.ndarray, stop: np.ndarray):
    """Index of the first row and bounds of the union of ranges per key."""
    if not len(start):
        return np.empty(0, np.int64), start, stop
    by = np.lexsort((start, *order_keys[::-1]))
    keys = [k[by] for k in order_keys]
    s, e = start[by].astype(np.int64), stop[by].astype(np.int64)
    new = np.ones(len(by), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    group = np.cumsum(new) - 1
    shift = group * (int(e.max()) + 2)  # one line for all keys, so that a running maximum stays in its key
    reach = np.maximum.accumulate(e + shift)
    first = np.ones(len(by), bool)
    first[1:] = (s + shift)[1:] > reach[:-1]
    at = np.flatnonzero(first)
    last = np.concatenate([at[1:], [len(by)]]) - 1
    return by[at], s[at], reach[last] - shift[last]


def _not_first(sort_keys: tuple[np.ndarray, ...], same: tuple[np.ndarray, ...]):
    """Rows sorted by (same keys, sort keys); flags, in that order, of each
    group's first row and of rows that come truly after it."""
    by = np.lexsort((*sort_keys[::-1], *same[::-1]))
    n = len(by)
    head = np.ones(n, bool)
    head[1:] = np.any([k[by][1:] != k[by][:-1] for k in same], axis=0)
    first = np.flatnonzero(head)
    lead = by[first[np.cumsum(head) - 1]] if n else by
    later = np.any([k[by] != k[lead] for k in sort_keys], axis=0) if n else head
    return by, head, later


class _Block:
    """Runs gathered from slices; equal ones are dropped but for the first."""

    def __init__(self, length: int, buckets: int):
        self.length, self.buckets = length, buckets
        self.clear()

    def clear(self):
        self.texts: list[tuple[np.ndarray, np.ndarray]] = []
        self.parts: list[tuple] = []
        self.n_texts = self.rows = 0

    def add(self, ids, keys, text, *runs):
        self.parts.append((text + self.n_texts, *runs))
        self.texts.append((ids, keys))
        self.n_texts += len(ids)
        self.rows += len(text)

    def emit(self) -> Iterator[tuple[int, bytes]]:
        if not self.rows:
            return self.clear()
        text, start, count, anchor, hashes, own, cores = (np.concatenate(x) for x in zip(*self.parts))
        ids, keys = (np.concatenate(x) for x in zip(*self.texts))
        self.clear()
        by, head, later = _not_first((ids[text], keys[text], start), (hashes, anchor))
        gone = by[later]
        at, a, b = _ranges((text[gone],), start[gone], start[gone] + count[gone] + self.length - 1)
        marks = np.empty(len(at), _PIECE)
        marks["group"], marks["id"], marks["key"] = 0, ids[text[gone[at]]], keys[text[gone[at]]]
        marks["start"], marks["size"] = a, b - a
        for lo in range(0, len(marks), 50_000):
            yield -1 - lo // 50_000, marks[lo:lo + 50_000].tobytes()
        kept = by[head]
        bucket = (anchor[kept] >> np.uint64(32)) % np.uint64(self.buckets)
        kept = kept[np.argsort(bucket, kind="stable")]
        bucket = np.sort(bucket)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for rows in np.split(kept, cuts):
            local, index = np.unique(text[rows], return_inverse=True)
            table = np.empty(len(local), _TEXT)
            table["id"], table["key"] = ids[local], keys[local]
            r = np.empty(len(rows), _RUN)
            r["anchor"], r["hash"], r["start"], r["n"] = anchor[rows] & np.uint64(0xFFFFFFFF), hashes[rows], start[rows], count[rows]
            r["text"], r["own"], r["cores"] = index, own[rows], cores[rows]
            yield (int(anchor[rows[0]] >> np.uint64(32)) % self.buckets,
                   np.uint32(len(local)).tobytes() + table.tobytes() + r.tobytes())


def _rows(pairs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int32()),
                                       pa.array([p[1] for p in pairs], pa.binary())], ["bucket", "payload"])


def _batched(pairs: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for p in pairs:
        held.append(p)
        size += len(p[1])
        if size > 4 << 20:
            yield _rows(held)
            held, size = [], 0
    if held:
        yield _rows(held)


def _send_runs(length: int, gram: int, buckets: int):
    def pairs(batches):
        block = _Block(length, buckets)
        for batch in batches:
            ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
            for lo, hi, data, offsets in tb.slices(batch.column("text")):
                block.add(ids[lo:hi], keys[lo:hi], *anchored_runs(data, offsets, length, gram))
                if block.rows >= _BLOCK_ROWS:
                    yield from block.emit()
        yield from block.emit()

    return lambda batches: _batched(pairs(batches))


def _mark_batch(kind, ids, keys, start, stop, anchor) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids), pa.array(keys), pa.array(start.astype(np.int32)),
         pa.array(stop.astype(np.int32)), pa.array(anchor.astype(np.int64))], [c.split()[0] for c in _MARKS.split(", ")])


def _passed_marks(payload: bytes) -> pa.RecordBatch:
    m = np.frombuffer(payload, _PIECE)
    return _mark_batch(0, m["id"], m["key"], m["start"].astype(np.int64), m["start"].astype(np.int64) + m["size"],
                       np.zeros(len(m), np.int64))


def _sharing(group: np.ndarray, cores: np.ndarray) -> np.ndarray:
    """Which of the groups' different runs may share a window with another: those
    with a core of another in their group, and all of a group in which a run's
    cores aren't known."""
    shared = (np.bincount(group, cores[:, 0] == _ANY_CORE) > 0)[group]
    for k in range(_CORES):
        has = np.flatnonzero(cores[:, k] > _ANY_CORE)
        key = group[has] << 32 | cores[has, k]
        by = np.argsort(key)
        twice = np.flatnonzero(key[by[1:]] == key[by[:-1]])
        shared[has[by[twice]]] = shared[has[by[twice + 1]]] = True
    return shared


def _compare_runs(length: int, heavy: int):
    """Of each bucket's runs: marks of equal ones that come later (kind 0) and
    the runs whose windows have to be compared (kind 1, heavy: 2)."""

    def run(batches):
        held, ids, keys, buckets = [], [], [], []
        for batch in batches:
            for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
                payload = payload.as_buffer()
                if bucket < 0:
                    yield _passed_marks(payload)
                    continue
                n = int(np.frombuffer(payload, np.uint32, 1)[0])
                table = np.frombuffer(payload, _TEXT, n, 4)
                r = np.frombuffer(payload, _RUN, offset=4 + n * _TEXT.itemsize)
                held.append(r)
                ids.append(table["id"][r["text"]])
                keys.append(table["key"][r["text"]])
                buckets.append(np.full(len(r), bucket, np.int64))
        if not held:
            return
        r, ids, keys, buckets = (np.concatenate(x) for x in (held, ids, keys, buckets))
        group = buckets << 32 | r["anchor"].astype(np.int64)
        start, count = r["start"].astype(np.int64), r["n"].astype(np.int64)
        by, head, later = _not_first((ids, keys, start), (group, r["hash"]))
        gone = by[later]
        at, a, b = _ranges((ids[gone], keys[gone]), start[gone], start[gone] + count[gone] + length - 1)
        yield _mark_batch(0, ids[gone[at]], keys[gone[at]], a, b, np.zeros(len(at), np.int64))
        kept = by[head]
        new = np.ones(len(kept), bool)
        new[1:] = group[kept][1:] != group[kept][:-1]
        of = np.cumsum(new) - 1
        own = np.bincount(of, r["own"][kept]) > 0
        want = ((np.bincount(of) > 1) | own)[of]
        kept, of = kept[want], of[want]
        want = own[of] | _sharing(of, r["cores"][kept])
        kept, of = kept[want], of[want]
        kind = np.where(np.bincount(of)[of] > heavy, 2, 1)
        for k in (1, 2):
            w = kept[kind == k]
            yield _mark_batch(k, ids[w], keys[w], start[w], start[w] + count[w] + length - 1, group[w])

    return run


# -- comparison of windows ---------------------------------------------------------

def _pack(pieces: np.ndarray, raw: np.ndarray) -> bytes:
    return np.uint32(len(pieces)).tobytes() + pieces.tobytes() + raw.tobytes()


def _send_pieces(length: int, buckets: int):
    """Bytes of the wanted runs; of heavy anchors those of their windows."""

    def pairs(batches):
        for batch in batches:
            ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
            wants = batch.column("wanted")
            cuts = wants.offsets.to_numpy()
            want = wants.flatten()
            kind, start, stop, anchor = (want.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            cuts = cuts - cuts[0]
            for lo, hi, data, offsets in tb.slices(batch.column("text")):
                text = np.repeat(np.arange(hi - lo), np.diff(cuts[lo:hi + 1]))
                own = slice(cuts[lo], cuts[hi])
                k, s, e, g = kind[own], start[own].astype(np.int64), stop[own].astype(np.int64), anchor[own].astype(np.uint64)
                whole = k == 1
                t2, s2, g2 = text[~whole], s[~whole], g[~whole]
                n2 = e[~whole] - s2 - length + 1
                t2, g2, base = np.repeat(t2, n2), np.repeat(g2, n2), np.repeat(s2, n2)
                s2 = base + np.arange(len(base)) - np.repeat(np.cumsum(n2) - n2, n2)
                if len(s2):  # the group of a window: its bytes' hash, so that equal ones meet and others part
                    at = offsets[t2] + s2
                    up = np.argsort(at, kind="stable")
                    hashes = np.empty(len(at), np.uint64)
                    hashes[up] = tb.span_hashes(data, at[up], at[up] + length)
                    g2 = g2 ^ hashes
                    by, head, later = _not_first((ids[lo + t2], keys[lo + t2], s2), (g2,))
                    gone = by[later]
                    at, a, b = _ranges((t2[gone],), s2[gone], s2[gone] + length)
                    m = np.empty(len(at), _PIECE)
                    m["group"], m["id"], m["key"], m["start"], m["size"] = 0, ids[lo + t2[gone[at]]], keys[lo + t2[gone[at]]], a, b - a
                    yield -1, m.tobytes()
                    first = by[head]
                    t2, s2, g2 = t2[first], s2[first], g2[first]
                t = np.concatenate([text[whole], t2])
                p = np.empty(len(t), _PIECE)
                p["id"], p["key"] = ids[lo + t], keys[lo + t]
                p["group"], p["start"] = np.concatenate([g[whole], g2]), np.concatenate([s[whole], s2])
                p["size"] = np.concatenate([e[whole] - s[whole], np.full(len(s2), length)])
                bucket = (tb.mix(p["group"].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                at = offsets[t] + p["start"]
                for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    if len(rows):
                        yield int(bucket[rows[0]]), _pack(p[rows], tb.gather(data, at[rows], p["size"][rows].astype(np.int64)))

    return lambda batches: _batched(pairs(batches))


def _batch_marks(pieces: np.ndarray, raw: np.ndarray, length: int) -> pa.RecordBatch:
    """Marks of the windows that repeat among pieces laid end to end."""
    n, sizes = len(pieces), pieces["size"].astype(np.int64)
    ends = np.cumsum(sizes + 1)
    codes = np.empty(int(ends[-1]), np.int64)
    is_sep = np.zeros(len(codes), bool)
    is_sep[ends - 1] = True
    codes[is_sep] = np.arange(n)
    codes[~is_sep] = raw.astype(np.int64) + n
    sa, cls = repeat_classes(codes, length)
    piece = np.searchsorted(ends, sa, "right")
    left = ends[piece] - 1 - sa
    inside = left >= length
    row_class, row_piece, row_at = cls[inside], piece[inside], sa[inside]
    many = np.bincount(row_class, minlength=1)[row_class] > 1
    row_class, row_piece, row_at = row_class[many], row_piece[many], row_at[many]
    at = pieces["start"][row_piece].astype(np.int64) + row_at - (ends - 1 - sizes)[row_piece]
    ids, keys = pieces["id"][row_piece], pieces["key"][row_piece]
    by, _, later = _not_first((ids, keys, at), (row_class,))
    gone = by[later]
    first, a, b = _ranges((ids[gone], keys[gone]), at[gone], at[gone] + length)
    return _mark_batch(0, ids[gone[first]], keys[gone[first]], a, b, np.zeros(len(first), np.int64))


def _compare_pieces(length: int):
    def run(batches):
        pieces, raws = [], []
        for batch in batches:
            for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
                payload = payload.as_buffer()
                if bucket < 0:
                    yield _passed_marks(payload)
                    continue
                n = int(np.frombuffer(payload, np.uint32, 1)[0])
                pieces.append(np.frombuffer(payload, _PIECE, n, 4))
                raws.append(np.frombuffer(payload, np.uint8, offset=4 + n * _PIECE.itemsize))
        if not pieces:
            return
        p, raw = np.concatenate(pieces), np.concatenate(raws)
        at = np.cumsum(p["size"].astype(np.int64)) - p["size"]
        order = np.lexsort((p["start"], p["key"], p["id"], p["group"]))
        s = p[order]
        keep = np.ones(len(s), bool)  # rows that are repeated in the input
        keep[1:] = s[1:] != s[:-1]
        order = order[keep]
        size = np.cumsum(p["size"][order].astype(np.int64))
        group = p["group"][order]
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        lo = 0
        while lo < len(order):  # whole groups of together about _BATCH_BYTES
            done = size[lo - 1] if lo else 0
            k = np.searchsorted(heads, np.searchsorted(size, done + _BATCH_BYTES, "right"), "right") - 1
            hi = int(heads[k]) if heads[k] > lo else int(heads[np.searchsorted(heads, lo, "right")]) if heads[-1] > lo else len(order)
            if size[-1] - done <= _BATCH_BYTES:
                hi = len(order)
            rows = order[lo:hi]
            yield _batch_marks(p[rows], tb.gather(raw, at[rows], p["size"][rows].astype(np.int64)), length)
            lo = hi

    return run


# -- jobs ---------------------------------------------------------------------------

def _keyed(docs: DataFrame, *more) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(tb.NULL_ID)).alias("id"),
                       F.xxhash64(text).alias("key"), text.alias("text"), *more)


def repeated_ranges(docs: DataFrame, length: int = 100, gram: int = 32, heavy: int = 4_000) -> DataFrame:
    """id, key (of the text, as _keyed gives them) and ``ranges``, an array of
    (start, stop) in bytes; only texts that have some."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs)
    sent = keyed.mapInArrow(_send_runs(length, gram, 4 * n), "bucket int, payload binary")
    marks, _ = materialize(sent.repartition(n, "bucket").mapInArrow(_compare_runs(length, heavy), _MARKS), "suffix-runs")
    wanted = marks.where("kind > 0").groupBy("id", "key").agg(
        F.collect_list(F.struct("kind", "start", "stop", "anchor")).alias("wanted"))
    pieces = keyed.join(wanted, ["id", "key"]).mapInArrow(_send_pieces(length, 4 * n), "bucket int, payload binary")
    more, _ = materialize(pieces.repartition(n, "bucket").mapInArrow(_compare_pieces(length), _MARKS), "suffix-windows")
    return marks.where("kind = 0").union(more).groupBy("id", "key").agg(
        F.collect_list(F.struct("start", "stop")).alias("ranges"))


def _cut(row_ranges, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as starts and stops."""
    if not len(row_ranges[0]):
        return row_ranges
    _, a, b = _ranges((np.zeros(len(row_ranges[0]), np.int8),), *row_ranges)
    touch = np.ones(len(a), bool)
    touch[1:] = a[1:] > b[:-1]
    at = np.flatnonzero(touch)
    return a[at], b[np.concatenate([at[1:], [len(a)]]) - 1]


def _texts(batch: pa.RecordBatch):
    """Each row's bytes with its ranges to remove."""
    lists = batch.column("ranges")
    if lists.null_count:
        empty = pa.array([[]] * 1, lists.type)[0]
        lists = lists.fill_null(empty)
    cuts = lists.offsets.to_numpy()
    flat = lists.flatten()
    start, stop = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
    cuts = cuts - cuts[0]
    for lo, hi, data, offsets in tb.slices(batch.column("text")):
        for k in range(hi - lo):
            own = slice(cuts[lo + k], cuts[lo + k + 1])
            yield lo + k, data[offsets[k]:offsets[k + 1]], _cut((start[own], stop[own]), offsets[k + 1] - offsets[k])


def _left(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> bytes:
    edges = [0, *np.column_stack([starts, stops]).ravel().tolist(), len(data)]
    return b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))


def removal_digests(docs: DataFrame, length: int = 100, **parameters) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ranges = repeated_ranges(docs, length, **parameters)

    def run(batches):
        for batch in batches:
            out = []
            for i, data, (a, b) in _texts(batch):
                out.append((len(data), int((b - a).sum()), len(a), hashlib.sha256(_left(data, a, b)).hexdigest()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _keyed(docs, docs["doc_id"].cast("long").alias("doc_id")).join(ranges, ["id", "key"], "left")
    return joined.select("doc_id", "text", "ranges").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup_documents(docs: DataFrame, length: int = 100, **parameters) -> DataFrame:
    """docs with repeated bytes cut from the texts. A character that loses a
    byte goes as a whole; n_chars, where there is such a column, is that of
    the new text; a text that loses nothing is as it was; a row all of whose
    bytes repeat earlier ones goes."""
    ranges = repeated_ranges(docs, length, **parameters)
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts, gone = [], []
            nulls = batch.column("text").is_null().to_pylist()
            for i, data, (a, b) in _texts(batch):
                t = _left(data, a, b).decode("utf-8", "ignore") if len(a) else data.tobytes().decode()
                texts.append(None if nulls[i] else t)
                gone.append(bool(len(a)) and not t)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(gone, pa.bool_())],
                                             ["row", "text", "gone"])

    rest = [c for c in names if c != "text"]
    row = F.struct(F.lit(0).alias("_"), *(docs[c] for c in rest)).alias("row")
    joined = _keyed(docs, row).join(ranges, ["id", "key"], "left").select("row", "text", "ranges")
    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL("text string, gone boolean").fields])
    out = joined.mapInArrow(run, schema).where("not gone")
    size = lambda c: F.length("text").cast(docs.schema[c].dataType) if c == "n_chars" else F.col("row").getField(c)
    return out.select(*((F.col("text") if c == "text" else size(c)).alias(c) for c in names))
