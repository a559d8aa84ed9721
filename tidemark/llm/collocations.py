"""Phrase collocation mining (operator 13): an FM-index of word ids per shard.

Texts are cut into pieces at punctuation and line ends, pieces into words.
A *shard* is a run of whole pieces, of about ``SHARD_WORDS`` words, with word
numbers of its own; a separator stands after every piece. Its index is the
Burrows-Wheeler transform of the numbers, sorted to the depth of the longest
phrase, and the rank function that follows from it (``successors``).

A phrase of d words is an interval of a shard's rows. Intervals of d + 1 words
come from those of d by extension on both sides at once (``extend``): the rows
of a longer phrase lie inside its first d words' interval (right extension),
and their successors inside its last d words' interval (left extension), so
each longer interval names both. Counts are summed over the shards by that pair
of names, and the phrases found often enough are sent back, to the shards that
have them only, for the next depth. A phrase's name is its least (shard, row),
which no other phrase of its depth has: nothing rests on a hash.

Every shard sends one entry for a phrase however often it has it, so a very
common phrase doesn't weigh more than another. The entries of a shard travel as
packed arrays, one for each bucket of phrase names, and are summed bucket by
bucket; the number of buckets follows the number of occurrences that can still
matter, which is counted before, and beyond ``FAN`` buckets the arrays are dealt
in two steps. Words found too seldom take part in no longer phrase. Shards are
independent of languages: a word's number stands for the word in its language.

Defined results: a null text has no pieces; a null language counts as ``und``;
punctuation alone gives no words; repeated rows count as often as they occur;
an empty table gives an empty result; other columns are ignored. A text longer
than a shard is split between pieces; memory of a task follows the shard and
the longest piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.textbytes import mix
from tidemark.session import materialize, release

SHARD_WORDS = 1 << 21
#: Bits of a row in a name; the shard's number stands above them.
ROW_BITS = 28
#: Bits of the running number of a shard in its task.
TURN_BITS = 12
#: Entries that are summed together, and arrays that a task makes of its own.
BUCKET = 2_000_000
FAN = 4096

_FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\x0d\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")


# -- the index ---------------------------------------------------------------

def transform(codes: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform of codes (0: separator, also the last one);
    rows are sorted by their first ``depth`` codes, a power of two."""
    n = len(codes)
    rank, width = codes.astype(np.int64), 1
    while True:
        key = rank << 32
        key |= np.concatenate([rank[width:], rank[:width]])
        width *= 2
        order = np.argsort(key)
        if width >= depth:
            return codes[order - 1]
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])


def successors(bwt: np.ndarray) -> np.ndarray:
    """Row of the suffix that starts one code later, for every row: the inverse
    of the transform's rank step."""
    return np.argsort(bwt, kind="stable")


def extend(after: np.ndarray, lo: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one more word: first row, size, and the indexes of the
    intervals of their first and last words among the given ones (sorted)."""
    label = np.full(len(after), -1, np.int32)
    total = int(count.sum())
    if total:
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(total)
        label[rows] = np.repeat(np.arange(len(lo), dtype=np.int32), count)
    rows = np.flatnonzero((label >= 0) & (label[after] >= 0))
    head, tail = label[rows], label[after[rows]]
    cut = np.ones(len(rows), bool)
    cut[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
    at = np.flatnonzero(cut)
    return rows[at], np.diff(np.concatenate([at, [len(rows)]])), head[at], tail[at]


def _pack(codes: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(codes.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)
    return np.int64(len(codes)).tobytes() + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(blob: bytes) -> np.ndarray:
    n = int(np.frombuffer(blob[:8], np.int64)[0])
    planes = np.frombuffer(pa.decompress(blob[8:], 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view(np.uint32).ravel()


# -- shards ------------------------------------------------------------------

class _Numbers(dict):
    """Numbers of a language's words, from one counter for all languages."""

    def __init__(self, counter: list):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        self.counter[0] += 1
        n = self[word] = self.counter[0]
        return n


def _shards(depth: int, shard_words: int):
    schema = pa.schema([("shard", pa.int64()), ("bwt", pa.binary()), ("words", pa.list_(pa.struct([
        ("lang", pa.string()), ("word", pa.binary()), ("lo", pa.int64()), ("n", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn = TaskContext.get().partitionId(), 0
        counter, numbers, codes = [0], {}, [0]

        def close():
            nonlocal turn, counter, numbers, codes
            text = np.array(codes, np.int64)
            sizes = np.bincount(text, minlength=counter[0] + 1)
            lo = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            words = [{"lang": lang, "word": w, "lo": int(lo[k]), "n": int(sizes[k])} for lang, d in numbers.items() for w, k in d.items()]
            row = [[task << TURN_BITS | turn], [_pack(transform(text, depth))], [words]]
            turn += 1
            counter, numbers, codes = [0], {}, [0]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                if (data := text.as_buffer()) is None:
                    continue
                pieces = data.to_pybytes().translate(_FOLD).split(b"\n")
                known = numbers.get(key := lang.as_py())
                for piece in pieces:
                    if words := piece.split(b" ") if piece else None:
                        if known is None:
                            known = numbers[key] = _Numbers(counter)
                        size = len(codes)
                        codes.extend([known[w] for w in words if w])
                        if len(codes) > size:
                            codes.append(0)
                            if len(codes) >= shard_words:
                                yield close()
                                known = None
        if len(codes) > 1:
            yield close()

    return run


SHARD = "shard long, bwt binary, words array<struct<lang: string, word: binary, lo: long, n: long>>"
#: Entries of one bucket, packed.
PACKED = "bucket int, entries binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("entries", pa.binary())])
#: What a bucket finds: for each shard its phrases found often enough (packed:
#: id, that is shard and first row, n rows, name) with the sum of their rows, and
#: in a row without a shard the phrases, with the names of their first and last
#: words.
FOUND = "shard long, sent binary, n long, phrases array<struct<name: long, f: long, head: long, tail: long>>"
_PHRASE = pa.struct([(c, pa.int64()) for c in ("name", "f", "head", "tail")])
_FOUND = pa.schema([("shard", pa.int64()), ("sent", pa.binary()), ("n", pa.int64()), ("phrases", pa.list_(_PHRASE))])


def _planes(numbers: np.ndarray) -> bytes:
    """Rows of numbers, packed byte by byte, as neighbours share their upper
    bytes; of the first row the differences."""
    part = np.ascontiguousarray(numbers)
    part[0, 1:] = np.diff(part[0])
    planes = np.ascontiguousarray(part.view(np.uint8).reshape(len(part), -1, 8).transpose(0, 2, 1))
    return np.int64(part.shape[1]).tobytes() + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _numbers(packed: bytes, rows: int) -> np.ndarray:
    n = int(np.frombuffer(packed[:8], np.int64)[0])
    planes = np.frombuffer(pa.decompress(packed[8:], 8 * rows * n, "zstd", asbytes=True), np.uint8)
    out = planes.reshape(rows, 8, n).transpose(0, 2, 1).copy().view(np.int64).reshape(rows, n)
    out[0] = np.cumsum(out[0])
    return out


def _dealt(entries: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Entries (rows: id, n, head, tail), packed by bucket of their phrase."""
    bucket = (mix(entries[2].view(np.uint64) ^ mix(entries[3].view(np.uint64))) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        yield int(bucket[rows[0]]), _planes(entries[:, rows])


def _entries(packed: bytes) -> np.ndarray:
    return _numbers(packed, 4)


def _batch(parts: list[tuple], schema=_PACKED) -> pa.Table:
    return pa.table([pa.array([p[k] for p in parts], f.type) for k, f in enumerate(schema)], schema=schema)


def _extension(buckets: int, packed: bool):
    """Longer intervals of one shard, from the phrases sent back to it (as rows
    of numbers, or packed)."""
    def run(shards: pa.Table, phrases: pa.Table) -> pa.Table:
        if not len(shards) or not len(phrases):
            return _PACKED.empty_table()
        after = successors(_unpack(shards.column("bwt")[0].as_py()))
        if packed:
            sent = np.concatenate([_numbers(p.as_py(), 3) for p in phrases.column("sent")], axis=1)
        else:
            sent = np.array([phrases.column(c).to_numpy() for c in ("id", "n", "name")])
        ids, n, names = sent[:, np.argsort(sent[0])]
        first = int(shards.column("shard")[0].as_py()) << ROW_BITS
        lo, n, head, tail = extend(after, ids - first, n)
        return _batch(list(_dealt(np.array([lo + first, n, names[head], names[tail]], np.int64), buckets)))

    return run


def _dealt_again(buckets: int, size: int):
    """Packed entries of a coarse bucket, dealt to the fine ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for packed in batch.column(1):
                held.append(_entries(packed.as_py()))
                n += held[-1].shape[1]
                if n >= size:
                    yield from _batch(list(_dealt(np.concatenate(held, axis=1), buckets))).to_batches()
                    held, n = [], 0
        if held:
            yield from _batch(list(_dealt(np.concatenate(held, axis=1), buckets))).to_batches()

    return run


def _summed_entries(least: int):
    """Of one bucket's entries the phrases found ``least`` times or more."""
    def run(packed: pa.Table) -> pa.Table:
        ids, n, head, tail = np.concatenate([_entries(p.as_py()) for p in packed.column("entries")], axis=1)
        order = np.lexsort((ids, tail, head))
        ids, n, head, tail = ids[order], n[order], head[order], tail[order]
        at = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])]))
        sizes = np.diff(np.concatenate([at, [len(ids)]]))
        f = np.add.reduceat(n, at)
        name, keep = np.repeat(ids[at], sizes), np.repeat(f >= least, sizes)
        at = at[f >= least]
        if not len(at):
            return _FOUND.empty_table()
        phrases = pa.StructArray.from_arrays([pa.array(x) for x in (ids[at], f[f >= least], head[at], tail[at])], fields=list(_PHRASE))
        sent = np.array([ids, n, name])[:, keep]
        sent = sent[:, np.argsort(sent[0])]
        shard = sent[0] >> ROW_BITS
        cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        sums = np.add.reduceat(sent[1], cuts)
        back = [(int(shard[i]), _planes(sent[:, i:j]), int(s), None) for i, j, s in zip(cuts, [*cuts[1:], len(shard)], sums)]
        found = pa.table([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
                          pa.ListArray.from_arrays(pa.array([0, len(phrases)], pa.int32()), phrases)], schema=_FOUND)
        return pa.concat_tables([_batch(back, _FOUND), found])

    return run


def _longer(indexes: DataFrame, common: DataFrame, least: int, bucket: int, fan: int) -> DataFrame:
    """The phrases of one word more that are found ``least`` times or more."""
    # no shard has more intervals than rows in those that are extended
    buckets = max(1, math.ceil((common.agg(F.sum("n")).first()[0] or 0) / bucket))
    is_packed = "sent" in common.columns
    sent = common.where(F.col("shard").isNotNull()).select("shard", "sent") if is_packed else \
        common.select(F.shiftright("id", ROW_BITS).alias("shard"), "id", "n", "name")
    packed = indexes.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(_extension(min(buckets, fan), is_packed), PACKED)
    if buckets > fan:
        packed = packed.repartition("bucket").mapInArrow(_dealt_again(buckets, 2 * bucket), PACKED)
    return packed.groupBy("bucket").applyInArrow(_summed_entries(least), FOUND)


def counted_phrases(docs: DataFrame, longest: int, least: int, shard_words: int, copies: list[str], bucket: int = BUCKET,
                    fan: int = FAN) -> tuple[DataFrame, list[DataFrame]]:
    """(words of each language, per length the phrases found ``least`` times or
    more: name, f, and for one word lang and word, else the names head and tail
    of its first and last words). Paths of written copies go to ``copies``."""
    def written(df, name):
        out, path = materialize(df, name)
        copies.append(path)
        return out

    depth = 1 << max(1, longest - 1).bit_length()
    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")), docs["text"].cast("string").cast("binary"))
    shards = written(texts.mapInArrow(_shards(depth, shard_words), SHARD), "phrase-shards")
    words = shards.select("shard", F.explode("words").alias("w")).select(
        F.shiftleft("shard", ROW_BITS).bitwiseOR(F.col("w.lo")).alias("id"), F.col("w.n").alias("n"),
        F.col("w.lang").alias("lang"), F.col("w.word").cast("string").alias("word"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang", "word")  # a row for each shard
    found = words.withColumn("f", F.sum("n").over(w)).withColumn("name", F.min("id").over(w)).where(F.col("f") >= least)
    common = written(found, "phrase-words")
    levels = [common.where("id = name").select("name", "f", "lang", "word")]
    indexes = shards.select("shard", "bwt")
    for size in range(2, longest + 1):
        common = written(_longer(indexes, common, least, bucket, fan), f"phrases{size}")
        levels.append(common.where(F.col("shard").isNull()).select(F.explode("phrases").alias("p")).select("p.*"))
    return totals, levels


# -- scores ------------------------------------------------------------------

def _with_parts(levels: list[DataFrame]) -> list[DataFrame]:
    """Phrases of two words and more with the counts of their first k words
    (``firsts``) and last k words (``lasts``) for every k, and their words'
    names."""
    one = levels[0].select("name", "f", F.array("name").alias("words"),
                           F.array().cast("array<long>").alias("firsts"), F.array().cast("array<long>").alias("lasts"))
    out, below = [], one
    for level in levels[1:]:
        h = below.select(F.col("name").alias("head"), F.concat("firsts", F.array("f")).alias("firsts"), F.col("words").alias("_w"))
        t = below.select(F.col("name").alias("tail"), F.concat("lasts", F.array("f")).alias("lasts"),
                         F.element_at("words", -1).alias("_last"))
        below = level.join(h, "head").join(t, "tail").select(
            "name", "head", "tail", "f", F.concat("_w", F.array("_last")).alias("words"), "firsts", "lasts")
        out.append(below)
    return out


def _lowest_cut(size: int):
    """Struct (score, k, l, r) of the cut that scores lowest; exact."""
    cuts = []
    for k in range(1, size):
        l, r = F.col("firsts")[k - 1], F.col("lasts")[size - k - 1]
        wide = F.col("f").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)")
        both = l.cast("decimal(20,0)") + r.cast("decimal(20,0)")
        score = F.call_function("div", wide, both)
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, covered: int = 80, top: int = 2000,
                 shard_words: int = SHARD_WORDS, **parameters) -> DataFrame:
    """Per language the ``top`` phrases: lang, rank, phrase, a (its count), l
    and r (the counts of the two sides of its weakest cut), n (words of the
    language), score. Phrases of which ``covered`` percent or more lie inside
    one longer phrase are left out."""
    spark, copies = docs.sparkSession, []
    totals, levels = counted_phrases(docs, longest, least, shard_words, copies, **parameters)
    names = levels[0].select(F.col("name").alias("_word"), "lang", "word")
    scored = None
    parts = _with_parts(levels)
    for size, level in enumerate(parts, 2):
        if size < longest:
            # the longest share of any longer phrase is that of one with a word more
            over = levels[size].select(F.col("head").alias("name"), "f").union(levels[size].select("tail", "f")) \
                .groupBy("name").agg(F.max("f").alias("_over"))
            level = level.join(over, "name", "left").where(F.coalesce(100 * F.col("_over") < covered * F.col("f"), F.lit(True)))
        rows = level.select("words", "f", _lowest_cut(size).alias("cut"))
        scored = rows if scored is None else scored.unionByName(rows)
    first = names.select(F.col("_word").alias("_first"), "lang")
    scored = scored.select("words", F.col("words")[0].alias("_first"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score").join(first, "_first")
    # ties at the last place stay until the words are known
    best = scored.withColumn("_rank", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))) \
        .where(F.col("_rank") <= top)
    best, path = materialize(best.drop("_rank", "_first"), "phrase-best")
    copies.append(path)
    spelt = best.select("lang", "words", "a", "l", "r", "score", F.posexplode("words").alias("_k", "_word")) \
        .join(names.select("_word", "word"), "_word").groupBy("lang", "words", "a", "l", "r", "score") \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_k", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelt.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).join(totals, "lang") \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    out, _ = materialize(ranked, "phrases")
    for path in copies:
        release(spark, path)
    return out
