"""Token files (operator 1): texts as ids, in shards compressed by Re-Pair.

Rows are range-partitioned and sorted by (doc_id, text hash); each task
encodes its texts in that order and closes a shard when it holds
``SHARD_IDS`` ids. ``compress`` replaces frequent neighbours by nonterminals,
round after round, until no pair of neighbours is found ``LEAST_COUNT`` times;
in a round all pairs are replaced that no more frequent pair of the round can
overlap. The shard keeps the rules, the expansion
length of each, and the places of sampled symbols, so ``Shard.read`` expands
no more than the symbols that cover the ids asked for.

Files are Parquet: a row is one self-contained shard with its place in the
order, so Spark's commit protocol makes a lost executor's files good. A
shard's first id in the corpus is the sum of the tasks before its own (one
number each) and of its task's earlier shards (kept in the row).

Defined results: a null or blank text has only the end id; null doc_ids come
first; rows that repeat are encoded each, those of one doc_id in the order of
their texts' hashes; an empty table gives no shards; other columns are
ignored. A text is never split: memory follows the longest one.
"""

from __future__ import annotations

import hashlib
import json
import os
import string
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.llm.bpe import PieceTable
from tidemark.session import work_dir

SHARD_IDS = 1 << 20
MAGIC = b"TMRP0001"
#: Every so many symbols the shard keeps the number of ids before them.
SAMPLE = 1024
#: Pairs found so often get a rule: about as often as one pays for itself.
LEAST_COUNT = 8
#: Rules of one round at most; what it leaves is for the next.
_ROUND_RULES = 4096


# -- Re-Pair -----------------------------------------------------------------------

def _frequent_pairs(seq: np.ndarray, fresh: int, waiting: np.ndarray, symbols: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the pairs of neighbours found ``least`` times or more.
    After a round only pairs with one of its symbols (``fresh`` and above) can
    have become frequent, and of the others only ``waiting`` ones still are."""
    if fresh:
        side = np.zeros(symbols, np.uint8)  # 1: left of a waiting pair, 2: right of one, 4: fresh
        side[waiting[:, 0]] = 1
        side[waiting[:, 1]] |= 2
        side[fresh:] = 4
        near = side[seq]
        at = np.flatnonzero(((near[:-1] & near[1:] >> 1 & 1) | (near[:-1] | near[1:]) & 4).astype(bool))
        key = seq[at] * symbols + seq[at + 1]
    else:
        key = seq[:-1] * symbols + seq[1:]
    key.sort()
    if not len(key):
        return key, key
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(at, len(key)))
    often = count >= least
    return key[at[often]], count[often]


def _choose(keys: np.ndarray, counts: np.ndarray, symbols: int, most: int) -> np.ndarray:
    """Of the pairs by falling count those in which no symbol stands left in
    one and right in another, so that their places can't overlap."""
    side: dict[int, int] = {}
    out = []
    for key in keys[np.lexsort((keys, -counts))][:4 * most].tolist():
        a, b = divmod(key, symbols)
        if a == b:
            if a not in side:
                side[a] = 3
                out.append(key)
        elif side.get(a, 1) == 1 and side.get(b, 2) == 2:
            side[a], side[b] = 1, 2
            out.append(key)
        if len(out) == most:
            break
    return np.array(sorted(out), np.int64)


def compress(ids: np.ndarray, terminals: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """``(sequence, rules of each round)``; rule k of all rounds in order is
    symbol ``terminals + k``, a row (left, right)."""
    seq, rounds, symbols, fresh = ids.astype(np.int64), [], terminals, 0
    waiting = np.empty((0, 2), np.int64)
    while len(seq) > 1:
        keys, counts = _frequent_pairs(seq, fresh, waiting, symbols, LEAST_COUNT)
        chosen = _choose(keys, counts, symbols, _ROUND_RULES)
        if not len(chosen):
            break
        side = np.zeros(symbols, np.uint8)  # 1: left of a chosen pair, 2: right of one
        side[chosen // symbols] = 1
        side[chosen % symbols] |= 2
        near = side[seq]
        at = np.flatnonzero((near[:-1] & near[1:] >> 1 & 1).view(bool))
        key = seq[at] * symbols + seq[at + 1]
        rule = np.minimum(np.searchsorted(chosen, key), len(chosen) - 1)
        hit = chosen[rule] == key
        at, rule = at[hit], rule[hit]
        # only a symbol's pair with itself overlaps: of its run every other place
        start = np.ones(len(at), bool)
        start[1:] = at[1:] != at[:-1] + 1
        first = np.flatnonzero(start)
        even = (np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))) % 2 == 0
        at, rule = at[even], rule[even]
        before = len(seq)
        seq[at] = symbols + rule
        keep = np.ones(before, bool)
        keep[at + 1] = False
        seq = seq[keep]
        rounds.append(np.column_stack([chosen // symbols, chosen % symbols]).astype(np.int32))
        left_over = keys[~np.isin(keys, chosen, assume_unique=True)]
        waiting = np.column_stack([left_over // symbols, left_over % symbols])
        fresh = symbols
        symbols += len(chosen)
    return seq, rounds


def expansions(terminals: int, rounds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expansions of all symbols laid end to end: ``(ids, starts, lengths)``."""
    data = np.arange(terminals, dtype=np.int32)
    starts, lengths = np.arange(terminals, dtype=np.int64), np.ones(terminals, np.int64)
    for rules in rounds:
        pairs = rules.ravel().astype(np.int64)
        new = tb.gather(data, starts[pairs], lengths[pairs])
        size = lengths[pairs].reshape(-1, 2).sum(axis=1)
        starts = np.concatenate([starts, len(data) + np.cumsum(size) - size])
        lengths = np.concatenate([lengths, size])
        data = np.concatenate([data, new])
    return data, starts, lengths


# -- the format ----------------------------------------------------------------------

def pack(ids: np.ndarray, doc_ids: np.ndarray, known: np.ndarray, counts: np.ndarray, terminals: int) -> bytes:
    """One shard: magic, ten 64-bit numbers, then round sizes, rules, expansion
    lengths, documents (id, whether it has one, ids), samples, symbols."""
    seq, rounds = compress(ids, terminals)
    _, _, lengths = expansions(terminals, rounds)
    before = np.cumsum(lengths[seq]) - lengths[seq] if len(seq) else np.empty(0, np.int64)
    rules = np.concatenate(rounds) if rounds else np.empty((0, 2), np.int32)
    width = 2 if terminals + len(rules) <= 1 << 16 else 4
    head = np.array([terminals, len(rounds), len(rules), len(counts), len(seq), len(ids), width, SAMPLE, 0, 0], "<i8")
    return b"".join([
        MAGIC, head.tobytes(), np.array([len(r) for r in rounds], "<i4").tobytes(), rules.astype("<u4").tobytes(),
        lengths[terminals:].astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(), known.astype("u1").tobytes(),
        counts.astype("<u4").tobytes(), before[::SAMPLE].astype("<u4").tobytes(), seq.astype(f"<u{width}").tobytes()])


class Shard:
    """Reader of ``pack``'s bytes."""

    def __init__(self, content):
        if bytes(content[:8]) != MAGIC:
            raise ValueError("not a token shard")
        (self.terminals, n_rounds, n_rules, n_docs, n_seq, self.n_ids, width, self.sample, _, _) = \
            np.frombuffer(content, "<i8", 10, 8).tolist()
        at = 88

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        sizes = take("<i4", n_rounds)
        rules = take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int32)
        self.rounds = np.split(rules, np.cumsum(sizes)[:-1]) if n_rounds else []
        self.rules = rules
        self.lengths = np.concatenate([np.ones(self.terminals, np.int64), take("<u4", n_rules)])
        self.doc_ids, self.known = take("<i8", n_docs), take("u1", n_docs).astype(bool)
        self.counts = take("<u4", n_docs).astype(np.int64)
        self.samples = take("<u4", -(-n_seq // self.sample)).astype(np.int64)
        self.seq = take(f"<u{width}", n_seq)

    def read_all(self) -> np.ndarray:
        data, starts, lengths = expansions(self.terminals, self.rounds)
        return tb.gather(data, starts[self.seq], lengths[self.seq])

    def _expand(self, symbol: int) -> list[int]:
        out, stack = [], [symbol]
        while stack:
            s = stack.pop()
            if s < self.terminals:
                out.append(s)
            else:
                a, b = self.rules[s - self.terminals]
                stack += [int(b), int(a)]
        return out

    def read(self, start: int, count: int) -> np.ndarray:
        """ids[start:start + count] without expanding the rest."""
        stop = min(start + count, self.n_ids)
        if start >= stop:
            return np.empty(0, np.int32)
        block = int(np.searchsorted(self.samples, start, "right")) - 1
        lo = block * self.sample
        before = int(self.samples[block])
        out: list[int] = []
        for symbol in self.seq[lo:].tolist():
            if before >= stop:
                break
            size = int(self.lengths[symbol])
            if before + size > start:
                out += self._expand(symbol)[max(0, start - before):stop - before]
            before += size
        return np.array(out, np.int32)

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.counts[:k].sum()), int(self.counts[k]))


# -- jobs ------------------------------------------------------------------------------

_LOADED: dict[str, tuple] = {}
#: Distinct stretches kept by a worker.
MAX_WORDS = 800_000
#: Stands between words that are encoded in one call.
_MARK = "|"
_CALL_WORDS = 256
#: Of a byte: 1 an ASCII letter or digit, 2 an ASCII mark but the apostrophe, 4
#: white space. No token holds both of the first two, and the normalizer
#: changes neither for the other.
_SIDE = np.zeros(256, np.uint8)
_SIDE[list(string.punctuation.replace("'", "").encode())] = 2
_SIDE[list((string.ascii_letters + string.digits).encode())] = 1
_SIDE[tb.SPACE] = 4


# Normalizers, and the pre-tokenizer's pattern, under which a text
# may be encoded stretch by stretch. They change no character because of one
# beyond white space, and white space belongs to no token.
_LOCAL_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_LOCAL_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def by_stretches(description: dict) -> bool:
    """Whether the tokenizer's texts may be encoded stretch by stretch."""
    normal, cut = description.get("normalizer") or {}, description.get("pre_tokenizer") or {}
    steps = cut.get("pretokenizers") or [{}]
    return (normal.get("normalizers") == _LOCAL_NORMALIZERS and len(steps) == 2 and description.get("post_processor") is None
            and steps[0].get("type") == "Split" and steps[0].get("pattern") == {"Regex": _LOCAL_PATTERN}
            and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
            and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex"))


class _Whole:
    """Ids of whole texts, for any tokenizer."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, flat, and each text's number of ids."""
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])]
        rows = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))


class _Words:
    """Ids of words by the tokenizers library, a batch of new ones in a call."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        mark = self._encode(_MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:  # the model marks the last token of what it was given
            self.last[[k for w, k in vocabulary.items() if w.endswith(suffix)]] = True

    def ends_alone(self, word: bytes) -> bool:
        """Whether a mark after the word is a token by itself, as the tokenizer
        sees the word: normalized, its last character may be another."""
        if word[-1:].isalnum():
            return True
        if 0x20 < word[-1] < 0x7F:  # joins the mark
            return False
        text = self.tokenizer.normalizer.normalize_str(word.decode() + ",")
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return bool(parts) and parts[-1][1] == (len(text) - 1, len(text))

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, words: list[bytes]) -> list[list[int]]:
        found: dict[bytes, list[int]] = {}
        mark = self.mark
        plain = [w for w in words if b"|" not in w] if mark is not None else []
        for lo in range(0, len(plain), _CALL_WORDS):
            part = plain[lo:lo + _CALL_WORDS]
            ids = self._encode(b" | ".join(part).decode())
            cuts = [-1, *(i for i, x in enumerate(ids) if x == mark), len(ids)]
            if len(cuts) == len(part) + 1:
                found.update(zip(part, [ids[i + 1:j] for i, j in zip(cuts, cuts[1:])]))
        return [found[w] if w in found else self._encode(w.decode()) for w in words]

    def resolve(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids, flat, and each word's number of ids. Words of letters
        are told apart by the model's word ends, others by marks."""
        texts = b" ".join(words).decode().split(" ")
        letters = np.fromiter(map(str.isalpha, texts), bool, len(texts)) if self.last.any() else np.zeros(len(texts), bool)
        order, parts, sizes = [], [], []
        other = [np.flatnonzero(~letters)]
        letters = np.flatnonzero(letters)
        for lo in range(0, len(letters), _CALL_WORDS):
            at = letters[lo:lo + _CALL_WORDS]
            ids = np.array(self._encode(" ".join([texts[k] for k in at.tolist()])), np.int32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(at):  # so each is one piece, as none can be less
                order.append(at)
                parts.append(ids)
                sizes.append(np.diff(ends, prepend=0))
            else:
                other.append(at)
        rest = np.concatenate(other)
        found = self.encode([words[k] for k in rest.tolist()])
        order.append(rest)
        parts.append(np.fromiter(chain.from_iterable(found), np.int32))
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        size = np.concatenate(sizes)
        back = np.argsort(np.concatenate(order))
        return tb.gather(np.concatenate(parts), (np.cumsum(size) - size)[back], size[back]), size[back]


class _Table(PieceTable):
    """Rows of ids by piece of a stretch; also whether a mark after a piece is a
    token by itself (found out for those that have one after them)."""

    def __init__(self, words: _Words, limit: int):
        self.words = words
        super().__init__(words.encode, limit)
        self.resolve = words.resolve

    def _reset(self) -> None:
        super()._reset()
        self.names: list[bytes] = []
        self.solid = np.zeros(1 << 12, np.int8)  # 0: not known yet, 1: yes, 2: no

    def settle(self) -> None:
        self.names += self.new
        super().settle()
        if self.rows > len(self.solid):
            self.solid = np.concatenate([self.solid, np.zeros(2 * self.rows - len(self.solid), np.int8)])

    def _rows(self, stretches: list[bytes]) -> np.ndarray:
        rows = np.fromiter(map(self.__getitem__, stretches), np.int64, len(stretches))
        self.settle()
        return rows

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, flat, and each text's number of ids. Each distinct
        piece of the slice is looked up once. Stretches are cut between ASCII
        letters or digits and marks, and before the marks at their end, unless
        the tokenizer would not cut these from the character before them."""
        self.begin()
        text, cased = _lower(data, offsets)
        side = _SIDE[text]
        inside = side != 4
        first, last = tb.runs(inside, offsets)
        for k in cased:  # may hold special tokens: whole stretches
            side[offsets[k]:offsets[k + 1]] &= 4
        begin = np.zeros(len(text), bool)
        begin[1:] = side[1:] + side[:-1] == 3
        begin[first] = True
        marks = side == 2
        marks[1:] &= side[:-1] != 2
        marks = np.flatnonzero(marks)
        close = last[side[last - 1] == 2]
        opened = first[side[last - 1] == 2]
        tail = np.maximum(marks[np.searchsorted(marks, close) - 1], opened) if len(close) else close
        soft = tail > opened
        soft[soft] = side[tail[soft] - 1] == 0
        tail, close = tail[soft], close[soft]
        begin[tail] = True
        start = np.flatnonzero(begin)
        ends = np.append(np.flatnonzero(begin[inside]), np.count_nonzero(inside)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(text[inside])]).dictionary_encode()
        rows = self._rows(_words_of(found.dictionary))[found.indices.to_numpy()]
        at = np.searchsorted(start, tail) - 1
        before = rows[at]
        for r in np.unique(before[self.solid[before] == 0]).tolist():
            self.solid[r] = 1 if self.words.ends_alone(self.names[r]) else 2
        whole = self.solid[before] == 2
        if whole.any():
            at = at[whole]
            rows[at] = self._rows([text[a:b].tobytes() for a, b in zip(start[at], close[whole])])
            rows, start = np.delete(rows, at + 1), np.delete(start, at + 1)
        done = np.concatenate([[0], np.cumsum(self.lengths[rows])])
        return self.look_up(rows), np.diff(done[np.searchsorted(start, offsets)])


def _words_of(column: pa.Array) -> list[bytes]:
    """The values of a binary column that have no space, by one split."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    size = np.diff(ends)
    spaced = np.full(int(ends[-1] - ends[0]) + len(size), ord(" "), np.uint8)
    spaced[np.arange(ends[-1] - ends[0]) + np.repeat(np.arange(len(size)), size)] = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    return spaced.tobytes().split()


def _lower(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """In lower case, as the tokenizer takes it, and which texts keep their
    case, as they may hold a special token."""
    raw, cased = data.tobytes(), []
    text = np.frombuffer(raw.lower(), np.uint8)
    at = raw.find(b"<|")
    if at >= 0:
        text = text.copy()
    while at >= 0:
        k = int(np.searchsorted(offsets, at, "right"))
        text[offsets[k - 1]:offsets[k]] = data[offsets[k - 1]:offsets[k]]
        cased.append(k - 1)
        at = raw.find(b"<|", int(offsets[k]))
    return text, cased


def _pieces(content: bytes) -> tuple[_Table | _Whole, int]:
    """The encoder, and the size of its vocabulary: by stretches between ASCII
    white space where the tokenizer is known to drop that and to join nothing
    across it, else by whole texts."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content.decode())
        local = by_stretches(json.loads(content))
        _LOADED[key] = _Table(_Words(tokenizer), MAX_WORDS) if local else _Whole(tokenizer), tokenizer.get_vocab_size(with_added_tokens=True)
    return _LOADED[key]


_SHARDS = "part int, seq int, base long, n_ids long, n_docs long, shard binary"


def _write(shared, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, terminals = _pieces(shared.value)
        end = np.array([end_id], np.int32)
        part, seq, base = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        size = 0

        def close():
            nonlocal seq, base, size
            ids = np.concatenate(held)
            row = pack(ids, np.array([tb.NULL_ID if d is None else d for d in docs], np.int64),
                       np.array([d is not None for d in docs]), np.array([len(h) for h in held]), terminals)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([base]), pa.array([len(ids)]),
                 pa.array([len(docs)]), pa.array([row], pa.binary())], [c.split()[0] for c in _SHARDS.split(", ")])
            base, seq, size = base + len(ids), seq + 1, 0
            held.clear()
            docs.clear()
            return out

        for batch in batches:
            for lo, hi, data, offsets in tb.slices(batch.column("text"), 2 * tb.SLICE_BYTES):
                ids = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                found, counts = table.encode_slice(data, offsets)
                cuts = np.cumsum(counts)
                for d, a, b in zip(ids, cuts - counts, cuts):
                    own = np.concatenate([found[a:b], end])
                    held.append(own)
                    docs.append(d)
                    size += len(own)
                    if size >= SHARD_IDS:
                        yield close()
        if held:
            yield close()

    return run


def write_shards(docs: DataFrame, tokenizer: bytes, path: str, end_id: int) -> None:
    """Encodes docs (doc_id, text) into shards below ``path``. ``tokenizer`` is
    the tokenizers library's JSON (a few MB, sent to the executors once)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = docs["text"].cast("string")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("row_hash"), text.alias("text"))
    rows = rows.repartitionByRange(n, "doc_id", "row_hash").sortWithinPartitions("doc_id", "row_hash")
    rows.mapInArrow(_write(shared, end_id), _SHARDS).write.mode("overwrite").parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, content in zip(batch.column("first").to_pylist(), batch.column("shard")):
            shard = Shard(content.as_buffer())
            ids = shard.read_all().astype("<u4")
            cuts = np.concatenate([[0], np.cumsum(shard.counts)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.doc_ids, mask=~shard.known), pa.array(first + cuts[:-1]), pa.array(shard.counts),
                 pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])], pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    shards = spark.read.schema(_SHARDS).parquet(path)
    # one row for each writing task
    tasks = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    tasks = tasks.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_before"))
    rows = shards.select("part", "base", "shard").join(tasks, "part")
    return rows.select((F.col("_before") + F.col("base")).alias("first"), "shard").mapInArrow(
        _digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, tokenizer: bytes, end_id: int = 2) -> DataFrame:
    """Writes the shards into the shared work folder and reads them back."""
    path = work_dir(docs.sparkSession, "token-shards")
    write_shards(docs, tokenizer, path, end_id)
    return read_digests(docs.sparkSession, path)
