"""Benchmark decontamination (operator 5): training suffix arrays.

Training texts are read in shards (slices of whole texts). Of each shard a
suffix array of words is built, and every suffix of every benchmark item is
searched in it by bisection, word after word, which gives its longest verbatim
match and all places of its window (``window`` words, or the whole of a shorter
item). Words outside the benchmark's vocabulary, and pairs of neighbours that
no item has, can't be inside a match, so a shard's array holds only the
stretches between them that are long enough.

The benchmark is the stated query set: it is indexed in blocks of about
``block_bytes`` bytes of text, each broadcast by itself, and the training texts
are scanned once for each block. Nothing of the training side leaves its task
but the results: of the first block's scan each row's word count and hits, of
another's the hits of rows that have some, which then join the first's.

Defined results: a null or wordless text has no hit and is clean; a null or
wordless item never occurs; item rows that share an id count as one item, a
null item_id is written ``null``; repeated training rows each get their
result; empty tables give clean or no rows; other columns are kept by
``filter_documents`` and ignored otherwise. Memory follows the longest text.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.llm.suffix import _cut, suffix_array
from tidemark.session import materialize

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z are lower-cased; every byte of
#: a character beyond ASCII belongs to a word.
_WORD = ~tb.classes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_FILTER_BITS = 20


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all words."""
    data = tb.LOWER[data]
    starts, ends = tb.runs(_WORD[data], offsets)
    return starts, tb.span_hashes(data, starts, ends)


class _Set:
    """Sorted hashes with a bitmap before the search."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values.astype(np.uint64))
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[self._slot(self.values)] = True

    @staticmethod
    def _slot(x: np.ndarray) -> np.ndarray:
        return (x >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def index(self, x: np.ndarray) -> np.ndarray:
        """Place of each value, -1 for strangers."""
        out = np.full(len(x), -1, np.int64)
        if not len(self.values):
            return out
        maybe = np.flatnonzero(self.bits[self._slot(x)])
        at = np.searchsorted(self.values, x[maybe])
        at[at == len(self.values)] = 0
        hit = self.values[at] == x[maybe]
        out[maybe[hit]] = at[hit]
        return out


class Index:
    """The test side: words of the items of one block."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        column = pa.array([t or "" for _, t in items], pa.large_string())
        parts, counts = [], []
        for _, _, data, offsets in tb.slices(column, 1 << 62):
            starts, hashes = words(data, offsets)
            parts.append(hashes)
            counts.append(np.diff(np.searchsorted(starts, offsets)))
        hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        counts = np.concatenate(counts) if counts else np.empty(0, np.int64)
        self.vocabulary = _Set(hashes)
        self.words = self.vocabulary.index(hashes)
        item = np.repeat(np.arange(len(counts)), counts)
        ends = np.cumsum(counts)
        self.ends = ends[item]  # of each suffix's item
        place = np.arange(len(item)) - np.repeat(ends - counts, counts)
        self.need = np.minimum(window, counts)[item]  # words of the window that starts here
        self.has_window = np.arange(len(item)) + self.need <= self.ends
        self.shortest = int(self.need.min()) if len(item) else 0
        follows = np.flatnonzero(item[1:] == item[:-1])
        self.pairs = _Set(tb.mix(self._pair(self.words[follows], self.words[follows + 1])))
        self.names = ["null" if i is None else str(i) for i, _ in items]
        self.item, self.place = item, place

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)

    def stretches(self, starts: np.ndarray, hashes: np.ndarray, offsets: np.ndarray, least: int | None = None):
        """Bounds (in words) of the shard's stretches that can hold a match of
        ``least`` words (default: those of the shortest window)."""
        ids = self.vocabulary.index(hashes)
        known = ids >= 0
        if len(ids) < 2:
            joined = np.zeros(max(0, len(ids) - 1), bool)
        else:
            text = np.searchsorted(offsets, starts, "right")
            joined = known[1:] & known[:-1] & (text[1:] == text[:-1])
            at = np.flatnonzero(joined)
            joined[at] = self.pairs.index(tb.mix(self._pair(ids[at], ids[at + 1]))) >= 0
        first = known.copy()
        first[1:] &= ~joined
        last = known.copy()
        last[:-1] &= ~joined
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        long = b - a >= (self.shortest if least is None else least)
        return ids, a[long], b[long]


def _bisect(codes, sa, lo, hi, depth, symbol, right: bool):
    """Per query the first row in [lo, hi) whose code at depth is not less
    than (right: is greater than) its symbol."""
    lo, hi = lo.copy(), hi.copy()
    last = len(codes) - 1
    while True:
        live = lo < hi
        if not live.any():
            return lo
        mid = (lo + hi) // 2
        code = codes[np.minimum(sa[np.minimum(mid, last)] + depth, last)]
        below = live & ((code <= symbol) if right else (code < symbol))
        lo = np.where(below, mid + 1, lo)
        hi = np.where(live & ~below, mid, hi)


def search(index: Index, ids: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Suffix array of the stretches, and of every test suffix its longest
    match: ``(word positions by row, suffix, length, its rows lo, hi, window rows
    lo, hi)``; suffixes without a match are left out."""
    sizes = b - a
    n = len(a)
    where = np.full(int(sizes.sum()) + n, -1, np.int64)
    ends = np.cumsum(sizes + 1)
    is_sep = np.zeros(len(where), bool)
    is_sep[ends - 1] = True
    where[~is_sep] = tb.gather(np.arange(len(ids)), a, sizes)
    codes = np.empty(len(where), np.int64)
    codes[is_sep] = np.arange(n)
    codes[~is_sep] = ids[where[~is_sep]] + n
    sa = suffix_array(codes)
    q = np.arange(len(index.words))
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(codes), np.int64)
    length, row, end = (np.zeros(len(q), np.int64) for _ in range(3))
    window_lo, window_hi = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
    depth = 0
    while len(q):
        symbol = index.words[q + depth] + n
        left = _bisect(codes, sa, lo, hi, depth, symbol, False)
        right = _bisect(codes, sa, left, hi, depth, symbol, True)
        found = left < right
        q, lo, hi = q[found], left[found], right[found]
        depth += 1
        length[q], row[q], end[q] = depth, lo, hi
        full = index.need[q] == depth
        window_lo[q[full]], window_hi[q[full]] = lo[full], hi[full]
        more = q + depth < index.ends[q]
        q, lo, hi = q[more], lo[more], hi[more]
    hit = np.flatnonzero(length)
    return where[sa], hit, length[hit], row[hit], end[hit], window_lo[hit], window_hi[hit]


def _occurrences(index: Index, positions, hit, lo, hi):
    """Windows' places: (first word, words, item), once for each window and
    place."""
    use = index.has_window[hit] & (lo < hi)
    hit, lo, hi = hit[use], lo[use], hi[use]
    at = tb.gather(positions, lo, hi - lo)
    return at, np.repeat(index.need[hit], hi - lo), np.repeat(index.item[hit], hi - lo)


_HITS = "doc_id long, row_hash long, n_words long, hits array<struct<start:long,stop:long>>, items array<string>"
_DIGEST = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
           "row_hash long")


def _fields(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _scan(shared, every_row: bool):
    """Per row: words, runs of hit words, names of the items found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            for lo, hi, data, offsets in tb.slices(batch.column("text")):
                starts, hashes = words(data, offsets)
                first = np.searchsorted(starts, offsets)
                hits = np.zeros(len(starts) + 1, np.int64)
                items: list[set] = [set() for _ in range(hi - lo)]
                ids, a, b = index.stretches(starts, hashes, offsets)
                if len(a):
                    positions, hit, _, _, _, w_lo, w_hi = search(index, ids, a, b)
                    at, count, item = _occurrences(index, positions, hit, w_lo, w_hi)
                    np.add.at(hits, at, 1)
                    np.add.at(hits, at + count, -1)
                    text = np.searchsorted(first, at, "right") - 1
                    for t, i in np.unique(np.column_stack([text, item]), axis=0).tolist():
                        items[t].add(index.names[i])
                start, stop = tb.runs(np.cumsum(hits[:-1]) > 0, first)
                of = np.searchsorted(first, start, "right") - 1
                ranges = pa.StructArray.from_arrays([pa.array(start - first[of]), pa.array(stop - first[of])], ["start", "stop"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(hi - lo + 1)), pa.int32()), ranges)
                out = pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "row_hash")]
                    + [pa.array(np.diff(first).astype(np.int64)), lists, pa.array([sorted(i) for i in items], pa.list_(pa.string()))],
                    _fields(_HITS))
                yield out if every_row else out.filter(pa.array([bool(i) for i in items], pa.bool_()))

    return run


def _digest_batch(percent: int, batch: pa.RecordBatch, counts, hits, items) -> pa.RecordBatch:
    """Results of the batch's rows, of each row's words, runs and items found."""
    out = []
    for n, runs, names in zip(counts, hits, items):
        pairs = np.array([(r["start"], r["stop"]) for r in runs], np.int64).reshape(-1, 2)
        start, stop = _cut((pairs[:, 0], pairs[:, 1]), n)
        n_hit, names = int((stop - start).sum()), sorted(set(names))
        out.append((n, n_hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    n_hit > 0 and 100 * n_hit >= percent * n))
    cols = list(zip(*out)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()),
         pa.array(cols[4], pa.bool_()), batch.column("row_hash")], _fields(_DIGEST))


def _lists(batch: pa.RecordBatch):
    return (batch.column(c).to_pylist() for c in ("n_words", "hits", "items"))


def _digests(percent: int):
    """Per row, of all blocks' runs and items (lists of lists): the results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hits, items = _lists(batch)
            yield _digest_batch(percent, batch, n, map(chain.from_iterable, hits), map(chain.from_iterable, items))

    return run


def _scan_digests(shared, percent: int):
    """The results of a benchmark of one block, in the worker that scans: a
    second Python step in one stage would have a worker of its own, which
    stays with what it holds."""
    scan = _scan(shared, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in scan(batches):
            yield _digest_batch(percent, found, *_lists(found))

    return run


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Index]:
    rows = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield n, k, Index([(r.item_id, r.text) for r in part.distinct().collect()], window)


def _texts(docs: DataFrame) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("row_hash"), text.alias("text"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 5,
                  block_bytes: int = 4 << 20) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit (words in some occurrence of a
    window), n_items, items_sha256, contaminated (hit words make up
    ``percent`` or more), row_hash (of the text)."""
    context = docs.sparkSession.sparkContext
    texts, rows, others = _texts(docs), None, None
    for n, k, index in _blocks(benchmark, window, block_bytes):
        if n == 1:
            return texts.mapInArrow(_scan_digests(context.broadcast(index), percent), _DIGEST)
        found = texts.mapInArrow(_scan(context.broadcast(index), k == 0), _HITS)
        if k == 0:
            rows = found
        else:
            others = found if others is None else others.unionByName(found)
    # one row for each text that another block hits; repeated rows are equal, a set drops them
    more = others.groupBy(F.coalesce("doc_id", F.lit(tb.NULL_ID)).alias("_id"), F.col("row_hash").alias("_hash")).agg(
        F.collect_set("hits").alias("_hits"), F.collect_set("items").alias("_items"))
    # by shuffle (no texts in it), so that scan and results are stages with one Python worker a task each
    rows = rows.join(more.hint("merge"), (F.coalesce("doc_id", F.lit(tb.NULL_ID)) == F.col("_id")) & (F.col("row_hash") == F.col("_hash")), "left")
    lists = [F.concat(F.array(c), F.coalesce(f"_{c}", F.array())).alias(c) for c in ("hits", "items")]
    return rows.select("doc_id", "row_hash", "n_words", *lists).mapInArrow(_digests(percent), _DIGEST)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_bytes: int = 4 << 20) -> DataFrame:
    """Of every test suffix with a match in some shard the longest:
    item_id, place (first word in the item), length (words, from 1 on), doc_id,
    position (first word in the text). Of equally long matches the one of the
    least doc_id (null first), then of the least position."""
    context, out = docs.sparkSession.sparkContext, None
    schema = "item_id string, place long, length long, doc_id long, position long"
    for _, _, index in _blocks(benchmark, window, block_bytes):
        shared = context.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                doc_ids = batch.column("doc_id")
                order = doc_ids.fill_null(tb.NULL_ID).to_numpy()
                for lo, hi, data, offsets in tb.slices(batch.column("text")):
                    starts, hashes = words(data, offsets)
                    first = np.searchsorted(starts, offsets)
                    ids, a, b = index.stretches(starts, hashes, offsets, 1)
                    if not len(a):
                        continue
                    positions, hit, length, left, right, _, _ = search(index, ids, a, b)
                    if not len(hit):
                        continue
                    # rank of each row by (doc_id, position); the least of each distinct interval
                    text = np.searchsorted(first, positions, "right") - 1
                    by = np.lexsort((positions - first[text], order[lo:hi][text]))
                    rank = np.empty(len(by) + 1, np.int64)
                    rank[by], rank[-1] = np.arange(len(by)), len(by)
                    interval, which = np.unique(left << 32 | right, return_inverse=True)
                    bounds = np.column_stack([interval >> 32, interval & 0xFFFFFFFF]).ravel()
                    row = by[np.minimum.reduceat(rank, bounds)[::2]][which]
                    at, text = positions[row], text[row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([index.names[i] for i in index.item[hit]], pa.string()), pa.array(index.place[hit]),
                         pa.array(length), doc_ids.slice(lo, hi - lo).take(pa.array(text)),
                         pa.array(at - first[text])], _fields(schema))

        found = _texts(docs).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    early = F.coalesce("doc_id", F.lit(tb.NULL_ID))
    best = F.min_by(F.struct("length", "doc_id", "position"), F.struct(-F.col("length"), early, F.col("position")))
    return out.groupBy("item_id", "place").agg(best.alias("m")).select("item_id", "place", "m.*")


def filter_documents(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """docs without contaminated rows; columns as they were."""
    bad = contamination(docs, benchmark, **parameters).where("contaminated").select(
        F.coalesce("doc_id", F.lit(tb.NULL_ID)).alias("_bad_id"), F.col("row_hash").alias("_bad_hash")).distinct()
    bad, _ = materialize(bad, "contaminated")
    match = (F.coalesce(docs["doc_id"].cast("long"), F.lit(tb.NULL_ID)) == bad["_bad_id"]) & \
        (F.xxhash64(docs["text"].cast("string")) == bad["_bad_hash"])
    return docs.join(bad, match, "left_anti")
