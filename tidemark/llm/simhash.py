"""SimHash near-duplicates (operator 8): meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``max_bits`` bits have a common
variant, a word that each reaches by flipping at most half of them. So every
distinct fingerprint emits all its variants of ``max_bits / 2`` flips, the
shuffle brings equal variants together, and all fingerprints of one variant
are linked to the least of them after the distance of each such pair has been
verified.

A variant's row would be its value; the shuffle sends fewer. Its key is the
variant's top ``prefix_bits``, and one row (prefix, fingerprint) stands for all
of the fingerprint's variants in that prefix, which the receiving task
expands and sorts. A prefix whose fingerprints have more than ``task_variants``
variants is dealt to several tasks by the hash of the variant. Links leave a
task as a spanning forest, never as all pairs.

Defined results: a null or blank text has the fingerprint zero and links like
any other; rows that repeat (also one doc_id with several texts) each keep a
row; a null doc_id never names a component unless no other does (then null);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.llm.components import components
from tidemark.session import materialize

_LOWER = tb.LOWER.tobytes()
_BLOCK = 1 << 16
#: Crowded prefixes (12 bytes each) that are broadcast; more are joined by shuffle.
MAX_BROADCAST_PREFIXES = 500_000


def fingerprint(text: bytes, width: int, seed: int) -> int:
    """Majority bits of the hashes of all word shingles of a UTF-8 text."""
    words = text.translate(_LOWER).split()  # bytes.split() splits at [\x20\x09-\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words), np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts[1:] = ends[:-1] + 1
    width = min(width, len(words))
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, _BLOCK):
        hi = min(n, lo + _BLOCK)
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(
            starts[lo:hi].tolist(), ends[lo + width - 1:hi + width - 1].tolist())), np.uint64, hi - lo)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """Per row: doc_id, row_hash (of the text), fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tb.slices(batch.column("text")):
                raw = data.tobytes()
                fps = [fingerprint(raw[a:b], width, seed) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("row_hash").slice(lo, hi - lo),
                     pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "row_hash", "fp"])

    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("row_hash"), text.alias("text")) \
        .mapInArrow(run, "doc_id long, row_hash long, fp long")


def flips(bits: int, most: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``most`` set."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each of n nodes' components under the edges a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        if (root[a] == low).all() and (root[b] == low).all():
            return root
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root != root[root]).any():
            root = root[root]


def _forest(prefix: int, part: int, parts: int, fps: np.ndarray, masks: list[np.ndarray], low_bits: int,
            radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints of one prefix that share a variant there."""
    fps = np.unique(fps)
    if len(fps) < 2:
        return fps[:0], fps[:0]
    low = np.uint64((1 << low_bits) - 1)
    used = np.bitwise_count((fps >> np.uint64(low_bits)) ^ np.uint64(prefix))
    base = (fps & low) | np.uint64(prefix << low_bits)
    values, owners = [], []
    for flipped in range(radius + 1):
        at = np.flatnonzero(used == flipped)
        mask = masks[radius - flipped]
        for lo in range(0, len(at), max(1, (1 << 21) // len(mask))):
            own = at[lo:lo + max(1, (1 << 21) // len(mask))]
            v = (base[own][:, None] ^ mask[None, :]).ravel()
            o = np.repeat(own.astype(np.int32), len(mask))
            if parts > 1:
                mine = tb.mix(v) % np.uint64(parts) == part
                v, o = v[mine], o[mine]
            values.append(v)
            owners.append(o)
    v, o = np.concatenate(values), np.concatenate(owners)
    order = np.argsort(v)
    v, o = v[order], o[order]
    same = v[1:] == v[:-1]
    a, b = o[:-1][same], o[1:][same]
    near = np.bitwise_count(fps[a] ^ fps[b]) <= 2 * radius  # verified, though a common variant implies it
    root = _roots(len(fps), a[near], b[near])
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[moved], fps[root[moved]]


def _links(prefix_bits: int, max_bits: int):
    radius, low_bits = max_bits // 2, 64 - prefix_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [flips(low_bits, k) for k in range(radius + 1)]
        held: list[np.ndarray] = []
        key = None
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def close():
            if key is not None:
                out.append(_forest(*key, np.concatenate(held), masks, low_bits, radius))

        def drain():
            a, b = (np.concatenate(x) if out else np.empty(0, np.uint64) for x in (list(zip(*out)) or ([], [])))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:  # sorted by the key, so a key's rows follow each other
            cols = [batch.column(c).to_numpy() for c in ("prefix", "part", "parts")]
            fps = batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(fps)]):
                if lo == hi:
                    continue
                new = tuple(int(c[lo]) for c in cols)
                if new != key:
                    close()
                    key, held = new, []
                held.append(fps[lo:hi].copy())
            if out:
                yield drain()
        close()
        if out:
            yield drain()

    return run


def prefix_size(n: int, radius: int, task_variants: int) -> int:
    """Bits of prefix with which n fingerprints have about ``task_variants``
    variants in a prefix at most."""
    return min(40, max(12, math.ceil(math.log2(max(1, n) * len(flips(64, radius)) / task_variants))))


def links(fps: DataFrame, max_bits: int = 4, prefix_bits: int | None = None, task_variants: int = 4_000_000) -> DataFrame:
    """``fps``: a written table of distinct fingerprints (column fp). Returns
    links a, b (a > b as unsigned words) whose components are those of all
    pairs at ``max_bits`` or fewer differing bits."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: each side flips half of them")
    spark, radius = fps.sparkSession, max_bits // 2
    prefix_bits = prefix_bits or prefix_size(fps.count(), radius, task_variants)
    low_bits = 64 - prefix_bits
    masks = F.array(*(F.lit(int(m)) for m in flips(prefix_bits, radius)))
    top = F.shiftrightunsigned("fp", low_bits)
    rows = fps.select("fp", F.explode(masks).alias("_m")).select("fp", top.bitwiseXOR(F.col("_m")).alias("prefix"),
                                                                F.bit_count("_m").alias("_used"))
    ball = {k: len(flips(low_bits, radius - k)) for k in range(radius + 1)}
    emitted = sum((F.when(F.col("_used") == k, n).otherwise(0) for k, n in ball.items()), F.lit(0))
    heavy = rows.groupBy("prefix").agg(F.sum(emitted).alias("_n")).where(F.col("_n") > task_variants) \
        .select("prefix", F.ceil(F.col("_n") / task_variants).cast("int").alias("parts"))
    heavy, _ = materialize(heavy, "simhash-heavy")
    hint = F.broadcast if heavy.count() <= MAX_BROADCAST_PREFIXES else (lambda d: d)
    rows = rows.join(hint(heavy), "prefix", "left").withColumn("parts", F.coalesce("parts", F.lit(1))) \
        .select("fp", "prefix", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "prefix", "part").sortWithinPartitions("prefix", "part")
    return dealt.mapInArrow(_links(prefix_bits, max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4, seed: int = 42, **parameters) -> DataFrame:
    """Per row of docs: doc_id, fp, root (the component's least fingerprint as a
    signed long), component_id (the least doc_id among the fingerprints
    reachable over links; it may name several components), row_hash."""
    marks, _ = materialize(fingerprints(docs, width, seed), "simhash-fingerprints")
    least, _ = materialize(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    edges = links(least.select("fp"), max_bits, **parameters)
    roots, _ = materialize(components(edges), "simhash-roots")
    named = roots.join(least.withColumnRenamed("fp", "node"), "node").select("node", "root", "least") \
        .union(roots.select("root").distinct().join(least.withColumnRenamed("fp", "root"), "root")
               .select(F.col("root").alias("node"), "root", "least"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    joined = named.select("node", "root").join(ids, "root").select(F.col("node").alias("fp"), "root", "component_id")
    # a fingerprint without links is its own component
    every, _ = materialize(least.join(joined, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")), "simhash-components")
    return marks.join(every, "fp").select("doc_id", "fp", "root", "component_id", "row_hash")


def keep_first(docs: DataFrame, **parameters) -> DataFrame:
    """docs with one row of each component: the one of least (doc_id, text
    hash); of rows equal in both, one stays. Columns as they were."""
    found, _ = materialize(near_duplicates(docs, **parameters), "simhash-rows")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash")).alias("f")) \
        .select(F.coalesce("f.doc_id", F.lit(tb.NULL_ID)).alias("_keep_id"), F.col("f.row_hash").alias("_keep_hash")).distinct()
    first, _ = materialize(first, "simhash-kept")
    return _only_one(docs, first)


def _only_one(docs: DataFrame, first: DataFrame) -> DataFrame:
    """The rows of docs named in ``first``, a row that is repeated only once."""
    key = [F.coalesce(docs["doc_id"].cast("long"), F.lit(tb.NULL_ID)), F.xxhash64(docs["text"].cast("string"))]
    names = docs.columns
    rows = docs.select(key[0].alias("_id"), key[1].alias("_hash"), F.struct(*(docs[c] for c in names)).alias("_row"))
    rows = rows.join(first, (F.col("_id") == F.col("_keep_id")) & (F.col("_hash") == F.col("_keep_hash")), "left_semi")
    one = rows.groupBy("_id", "_hash").agg(F.first("_row").alias("_row"))
    return one.select(*(F.col("_row").getField(c).alias(c) for c in names))
