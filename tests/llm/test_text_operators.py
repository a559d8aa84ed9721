"""Operators over documents, against brute force on edge and driver tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tests.llm import helpers as H
from tidemark.llm import bpe, decontaminate, quality, queries, simhash, suffix, tokenfiles
from tidemark.llm import textbytes as tb

LIKE = {"edge": H.edge_docs, "empty": H.empty_docs, "sf": lambda s: s.read.parquet(f"{H.SF}/documents.parquet")}


@pytest.fixture(scope="module", params=sorted(LIKE))
def docs(spark, request):
    return LIKE[request.param](spark)


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# -- helpers over bytes ---------------------------------------------------------

def test_slices_hold_whole_texts_and_nulls():
    import pyarrow as pa

    texts = ["a" * 50, None, "", "b" * 200, "é"]
    got = []
    for lo, hi, data, offsets in tb.slices(pa.array(texts).slice(1), 60):
        got += [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
        assert hi - lo == len(offsets) - 1
    assert got == ["", "", "b" * 200, "é"]
    assert list(tb.slices(pa.array([], pa.string()))) == []


def test_span_hashes_depend_on_bytes_only(monkeypatch):
    data = np.frombuffer(b"one two one  two two1 one", np.uint8)
    starts, ends = tb.runs(~tb.SPACE[data], np.array([0, len(data)]))
    whole = tb.span_hashes(data, starts, ends)
    assert whole[0] == whole[2] == whole[5] and whole[1] == whole[3] and len(set(whole.tolist())) == 3
    monkeypatch.setattr(tb, "_CHUNK", 4)  # words of several chunks
    assert (tb.span_hashes(data, starts, ends) == whole).all()


def _thue_morse(n, a, b):
    return "".join((a, b)[bin(k).count("1") % 2] for k in range(n))


def test_span_hashes_are_the_polynomial():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts = np.arange(0, 4000, 7)
    ends = starts + np.arange(len(starts)) % 5 + 400  # overlapping
    p, base = (1 << 61) - 1, tb._PRIME_BASE
    want = [sum((int(v) + 1) * pow(base, k, p) for k, v in enumerate(data[a:b])) % p for a, b in zip(starts[::40], ends[::40])]
    assert (tb.span_hashes(data, starts, ends)[::40] == tb.mix(np.array(want, np.uint64))).all()


def test_span_hashes_of_long_spans(monkeypatch):
    data = np.frombuffer(b"ab " + b"x" * 90 + b" ab " + b"x" * 90, np.uint8)
    starts, ends = tb.runs(~tb.SPACE[data], np.array([0, len(data)]))
    monkeypatch.setattr(tb, "_CHUNK", 40)
    monkeypatch.setattr(tb, "_LONGEST_SPAN", 64)
    h = tb.span_hashes(data, starts, ends)
    assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1]


@pytest.mark.parametrize("size", [256, 1024, 2048, 4096])
def test_texts_that_collide_modulo_powers_of_two_are_told_apart(spark, size):
    one, two = _thue_morse(size, "a", "b"), _thue_morse(size, "b", "a")
    data = np.frombuffer((one + two).encode(), np.uint8)
    assert len(set(tb.span_hashes(data, np.array([0, size]), np.array([size, 2 * size])).tolist())) == 2
    # 4: two different lines; 5: an item's words are other words; 3: held to brute force
    docs = spark.createDataFrame([(1, f"{one}\n{two}"), (2, " ".join(["x", one] * 13)), (3, "p" * 50 + one + "q" * 50), (4, "r" * 50 + two + "s" * 50)],
                                 "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source").coalesce(1)
    counts = {r.doc_id: r.n_dup_lines for r in quality.text_statistics(docs).collect()}
    assert counts == {1: 0, 2: 0, 3: 0, 4: 0}
    items = spark.createDataFrame([("a", " ".join(["x", two] * 13))], "item_id string, text string")
    assert not any(r.n_hit for r in decontaminate.contamination(docs, items).collect())
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    got = {r.doc_id: r.n_removed for r in suffix.removal_digests(docs).collect()}
    seen, want = set(), {}
    for i, t in texts:
        gone = set()
        for k in range(len(t) - 99):
            gone.update(range(k, k + 100) if t[k:k + 100] in seen else ())
            seen.add(t[k:k + 100])
        want[i] = len(gone)
    assert got == want


# -- 1 ----------------------------------------------------------------------------

@pytest.mark.parametrize("ids", [[], [5], [0] * 1001, [k * k % 7 for k in range(5000)], list(range(3000)), [1, 2] * 700 + [3]])
def test_repair_round_trip_and_random_access(ids):
    ids = np.array(ids, np.int32)
    shard = tokenfiles.Shard(tokenfiles.pack(ids, np.array([1]), np.array([True]), np.array([len(ids)]), 49408))
    assert (shard.read_all() == ids).all()
    for start in (0, 1, len(ids) // 2, max(0, len(ids) - 3)):
        assert (shard.read(start, 37) == ids[start:start + 37]).all()


def test_repair_rules_have_their_expansion_lengths():
    ids = np.array([1, 2, 3, 4] * 500, np.int32)
    shard = tokenfiles.Shard(tokenfiles.pack(ids, np.array([1, 2]), np.array([True, True]), np.array([900, 1100]), 10))
    assert len(shard.rules) and len(shard.seq) < len(ids) / 2
    for k, n in enumerate(shard.lengths[10:].tolist()):
        assert len(shard._expand(10 + k)) == n
    assert (shard.document(1) == ids[900:]).all()


def test_repair_stops_only_when_no_pair_is_frequent():
    rng = np.random.default_rng(4)
    zipf = np.minimum(rng.zipf(1.3, 60_000), 40_000).astype(np.int32)
    for ids, terminals in ((zipf, 49_408), (zipf, 70_000), (np.tile(np.arange(50, dtype=np.int32), 2000), 70_000)):
        seq, rounds = tokenfiles.compress(ids, terminals)
        pairs = Counter(zip(seq[:-1].tolist(), seq[1:].tolist()))
        assert max(pairs.values(), default=0) < tokenfiles.LEAST_COUNT
        data, starts, lengths = tokenfiles.expansions(terminals, rounds)
        assert (tb.gather(data, starts[seq], lengths[seq]) == ids).all()
    assert len(seq) < 100


def _encoded(table, texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    ids, counts = table.encode_slice(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_ids_before_punctuation_equal_the_library():
    """Every letter, digit, mark and sign before a comma and a full stop, and
    random texts of those whose normal form ends otherwise."""
    import random
    import unicodedata

    from tokenizers import Tokenizer

    content = queries.vocabulary_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_str(content.decode())
    table, _ = tokenfiles._pieces(content)
    assert isinstance(table, tokenfiles._Table)
    chars = [chr(c) for c in range(0x20, 0x30000) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")
             and not (0x3400 < c < 0x9FF0 or 0xAC10 < c < 0xD790 or c > 0x1F000)]
    texts = [f"MAHKEMES{c}, KARARI{c}. x{c},\n{c}{c}, a" for c in chars]
    rng = random.Random(9)
    odd = ["\u0130", "\u0958", "\u095f", "\u09dc", "\u0a33", "\u0b5c", "\u0f43", "\ufb2a", "\u0301", "\u0327", "e", "K", "1", "_", "'s", "'", ",", ".",
           ", ", ". ", " ", "\n", "|", "<|endoftext|>", "\u00a0", "\u200d", "\u1100\u1161", "\u0e47"]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    for lo in range(0, len(texts), 5000):
        part = texts[lo:lo + 5000]
        want = tokenizer.encode_batch(part, add_special_tokens=False)
        assert [t for t, r, w in zip(part, _encoded(table, part), want) if r != w.ids] == []


def test_other_tokenizers_take_whole_texts():
    import json

    content = json.loads(queries.vocabulary_file("word_bpe_49k.json"))
    content["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": "\\s?\\S+"}
    content["normalizer"] = None
    from tokenizers import Tokenizer

    data = json.dumps(content).encode()
    table, _ = tokenfiles._pieces(data)
    texts = ["One two, three.", "", "a  b", ""]
    want = [e.ids for e in Tokenizer.from_str(data.decode()).encode_batch(texts, add_special_tokens=False)]
    assert isinstance(table, tokenfiles._Whole) and _encoded(table, texts) == want


def test_token_files(spark, docs, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenfiles, "SHARD_IDS", 5000)
    got = tokenfiles.token_digests(docs, queries.vocabulary_file("word_bpe_49k.json")).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = texts_of(docs)
    encoded = {t: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows}
    want = [(d, len(encoded[t]), zlib.crc32(np.array(encoded[t], "<u4").tobytes())) for d, t in rows]
    assert H.in_order((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == H.in_order(want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # end to end, in the order of ids
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d))


# -- 3 -----------------------------------------------------------------------------

def test_repeat_classes_are_equal_prefixes():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sizes = rng.integers(0, 40, 6)
        codes = np.concatenate([np.append(rng.integers(6, 8, n), k) for k, n in enumerate(sizes)])
        for length in (1, 3, 7):
            sa, cls = suffix.repeat_classes(codes, length)
            assert sorted(sa.tolist()) == list(range(len(codes)))
            by_class = {}
            for row, c in zip(sa.tolist(), cls.tolist()):
                by_class.setdefault(c, set()).add(tuple(codes[row:row + length].tolist()))
            assert all(len(v) == 1 for v in by_class.values())
            assert len({v for s in by_class.values() for v in s}) == len(by_class)


def test_suffix_array_sorts_suffixes():
    rng = np.random.default_rng(7)
    for k in range(120):
        sizes = rng.integers(0, 60, rng.integers(1, 7))
        codes = np.concatenate([np.append(rng.integers(9, 9 + rng.integers(1, 4), n), i) for i, n in enumerate(sizes)])
        if k % 3 == 1:  # periodic, and letters that occur once
            codes = np.concatenate([np.tile([20, 30], 25), rng.permutation([40, 1, 7, 50]), np.tile([20, 30], 25), [60]])
        if k % 3 == 2:
            codes = codes * 10**9
        assert suffix.suffix_array(codes).tolist() == sorted(range(len(codes)), key=lambda i: codes[i:].tolist())
    assert not len(suffix.suffix_array(np.empty(0, np.int64)))


def _sharing_little(length, gram):
    """Texts that have a string of over ``gram`` bytes in common, and pairs that
    share ``length`` bytes at any place of a window."""
    rng = np.random.default_rng(13)
    prose = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    common = prose(length // 2)
    alone = [prose(150) + common + prose(150) for _ in range(60)]
    pairs = []
    for k in range(length - len(common) + 1):
        shared = prose(k) + common + prose(length - len(common) - k)
        pairs += [prose(40) + shared + prose(40) for _ in range(2)]
    return alone, pairs


@pytest.mark.parametrize("length,gram", [(100, 32), (101, 32), (40, 8)])
def test_only_runs_that_may_share_a_window_are_compared(spark, length, gram):
    import pyarrow as pa

    alone, pairs = _sharing_little(length, gram)
    wanted = {}
    for texts in (alone, alone + pairs):
        ids = pa.array(range(len(texts)), pa.int64())
        batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["id", "key", "text"])
        marks = pa.Table.from_batches(list(suffix._compare_runs(length, 4_000)(suffix._send_runs(length, gram, 4)(iter([batch])))))
        wanted[len(texts)] = {m["id"] for m in marks.to_pylist() if m["kind"]}
    assert not wanted[60]  # one string of a window's half in 60 texts: no window of them repeats
    assert wanted[60 + len(pairs)] >= set(range(60, 60 + len(pairs)))
    docs = spark.createDataFrame(list(enumerate(alone + pairs)), "doc_id long, text string")
    want = H.removals([(k, t.encode()) for k, t in enumerate(alone + pairs)], length)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.removal_digests(docs, length, gram=gram).collect()}
    assert got == want and sum(v[1] > 0 for v in want.values()) == len(pairs) // 2


@pytest.mark.parametrize("alphabet", [2, 26])
def test_runs_of_equal_windows_share_a_core(alphabet):
    """Whatever the text, its bounds and the anchor's place: two runs that have
    one window in common have one core, or one of them has no known cores."""
    rng = np.random.default_rng(17)
    for length, gram in ((40, 8), (23, 8), (12, 12)):
        parts = [rng.integers(97, 97 + alphabet, rng.integers(length, 60), dtype=np.uint8) for _ in range(12)]
        texts = [np.concatenate([parts[i] for i in rng.integers(0, 12, 4)]) for _ in range(40)]
        data, offsets = np.concatenate(texts), np.cumsum([0] + [len(t) for t in texts])
        text, start, count, anchor, _, own, cores = suffix.anchored_runs(data, offsets, length, gram)
        assert cores.shape == (len(text), suffix._CORES)
        assert (cores[own] == suffix._ANY_CORE).all()
        at = {}
        for k in range(len(text)):
            for w in range(start[k], start[k] + count[k]):
                at.setdefault(texts[text[k]][w:w + length].tobytes(), []).append(k)
        known = [{(j, c) for j, c in enumerate(r.tolist()) if c > suffix._ANY_CORE} for r in cores]
        assert any(len(set(v)) > 1 for v in at.values())
        for same in at.values():
            assert len({int(anchor[k]) for k in same}) == 1
            if same.count(same[0]) > 1:
                assert own[same[0]]
            if all(known[k] for k in same):
                assert set.intersection(*(known[k] for k in same))


@pytest.mark.parametrize("length,gram,heavy", [(100, 32, 4_000), (100, 32, 1), (20, 8, 2)])
def test_suffix_dedup(spark, docs, length, gram, heavy):
    keyed = suffix._keyed(docs).collect()
    distinct = {(r.id, r.key): (r.text or "").encode() for r in keyed}
    want = H.removals(sorted(distinct.items()), length)
    got = H.rows_of(suffix.removal_digests(docs, length, gram=gram, heavy=heavy))
    assert got == H.in_order((None if r.id == tb.NULL_ID else r.id, *want[r.id, r.key]) for r in keyed)


def _merged(ranges):
    out = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


@pytest.mark.parametrize("heavy", [20_000, 1])
def test_suffix_dedup_in_many_small_blocks(spark, monkeypatch, heavy):
    """Blocks of few runs, cut runs and one anchor per suffix array find what
    the job finds."""
    import pyarrow as pa

    docs = H.edge_docs(spark)
    want = {(r.id, r.key): _merged((x.start, x.stop) for x in r.ranges) for r in suffix.repeated_ranges(docs).collect()}
    for name, value in (("_BLOCK_ROWS", 10), ("_LONGEST_RUN", 16), ("_BATCH_BYTES", 1)):
        monkeypatch.setattr(suffix, name, value)  # of this process, so call the tasks' functions here
    rows = suffix._keyed(docs).toArrow().combine_chunks()
    sent = list(suffix._send_runs(100, 32, 4)(iter(rows.to_batches(max_chunksize=3))))
    assert sum(b.num_rows for b in sent) > 20
    marks = pa.Table.from_batches(list(suffix._compare_runs(100, heavy)(iter(sent)))).to_pylist()
    wanted = {}
    for m in marks:
        if m["kind"]:
            wanted.setdefault((m["id"], m["key"]), []).append({k: m[k] for k in ("kind", "start", "stop", "anchor")})
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("anchor", pa.int64())]))
    asked = [r for r in rows.to_pylist() if (r["id"], r["key"]) in wanted]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in asked], t) for c, t in (("id", pa.int64()), ("key", pa.int64()), ("text", pa.string()))]
        + [pa.array([wanted[r["id"], r["key"]] for r in asked], kind)], ["id", "key", "text", "wanted"])
    pieces = list(suffix._send_pieces(100, 4)(iter([batch])))
    marks += pa.Table.from_batches(list(suffix._compare_pieces(100)(iter(pieces)))).to_pylist()
    got = {}
    for m in marks:
        if not m["kind"]:
            got.setdefault((m["id"], m["key"]), []).append((m["start"], m["stop"]))
    assert {k: _merged(v) for k, v in got.items()} == want


def test_windows_of_crowded_anchors_are_not_laid_out(spark):
    """A task that sends the windows of crowded anchors holds some numbers for
    each window, not its bytes with their index (9 * length)."""
    import tracemalloc

    import pyarrow as pa

    text = np.random.default_rng(5).integers(97, 123, 150_000, dtype=np.uint8).tobytes().decode()
    runs = [{"kind": 2, "start": a, "stop": a + 10_000, "anchor": a} for a in (100_000, 0, 50_000, 20_000, 80_000)]
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("anchor", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text]), pa.array([runs], kind)],
                                       ["id", "key", "text", "wanted"])
    tracemalloc.start()
    windows = 0
    for out in suffix._send_pieces(100, 512)(iter([batch])):
        for b, payload in zip(out.column("bucket").to_pylist(), out.column("payload").to_pylist()):
            if b < 0:  # marks of equal windows
                assert not payload
                continue
            n = int(np.frombuffer(payload, np.uint32, 1)[0])
            pieces = np.frombuffer(payload, suffix._PIECE, n, 4)
            raw = np.frombuffer(payload, np.uint8, offset=4 + n * suffix._PIECE.itemsize).reshape(n, 100)
            windows += n
            assert all(text[p["start"]:p["start"] + 100].encode() == r.tobytes() for p, r in zip(pieces[::40], raw[::40]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert windows == 5 * 9_901
    assert peak < windows * 9 * 100 * 0.7


def test_dedup_documents_keeps_first_passages(spark):
    docs = H.edge_docs(spark)
    out = suffix.dedup_documents(docs)
    assert out.columns == docs.columns
    ranges = {(r.id, r.key): r.ranges for r in suffix.repeated_ranges(docs).collect()}
    assert any(ranges.values())
    kept = out.select("doc_id", "text", "n_chars").collect()
    assert all(r.n_chars == len(r.text) for r in kept if r.text)
    untouched = [r for r in suffix._keyed(docs).collect() if (r.id, r.key) not in ranges]
    have = {(tb.NULL_ID if r.doc_id is None else r.doc_id, r.text) for r in kept}
    assert all((r.id, r.text) in have for r in untouched)


def test_dedup_documents_cuts_no_character_in_two(spark):
    text = "".join(map(chr, range(0x100, 0x178)))
    # the character before the repeat ends with the same byte as the first's
    docs = spark.createDataFrame([(1, "x" + text), (2, "y\u0140" + text[1:] + "ö")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in suffix.dedup_documents(docs).collect()} == {1: "x" + text, 2: "yö"}


# -- 4 ------------------------------------------------------------------------------

def test_base_statistics(docs):
    got = H.rows_of(quality.text_statistics(docs), "doc_id", *quality.STATS)
    assert got == H.in_order((d, *H.statistics(t)) for d, t in texts_of(docs))


def test_chi_square_and_consistency():
    assert quality.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality.chi2_quantile(0.5, 2) == pytest.approx(1.38629, abs=1e-4)
    assert quality.consistency(1 - 1e-9) == pytest.approx(1, abs=1e-3)


def test_judge_on_edges(spark):
    docs = H.edge_docs(spark)
    got = quality.judge(docs)
    assert got.count() == docs.count()
    for r in got.collect():
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    assert quality.judge(H.empty_docs(spark)).count() == 0


def _percentile(values, share):
    values = np.sort(values)
    at = share * (len(values) - 1)
    low = int(np.floor(at))
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)


def _brute_estimate(x, support=0.75):
    """The method on one group's documents, a row each, with numpy."""
    def fit(sub, scale):
        d = (sub - sub.mean(0))
        cov = quality.bounded(scale * d.T @ d / len(sub))
        return sub.mean(0), np.linalg.inv(cov), round(float(np.linalg.slogdet(cov)[1]), 9)

    med = np.median(x, axis=0)
    mad = np.array([1.4826 * _percentile(np.abs(x[:, i] - med[i]), 0.5) for i in range(x.shape[1])])
    ends = []
    for mu, inv in ((med, np.diag(1 / np.maximum(mad ** 2, np.square(quality.LEAST_SPREAD)))), fit(x, 1.0)[:2]):
        logdet, steps = np.inf, 0
        while True:
            d = np.maximum(np.einsum("ij,jk,ik->i", x - mu, inv, x - mu), 0)
            d = np.floor(100 * np.log(d + 1e-6))
            new = fit(x[d <= np.ceil(_percentile(d, support))], quality.consistency(support))
            if not new[2] < logdet:
                break
            (mu, inv, logdet), steps = new, steps + 1
        ends.append((logdet, mu, inv, steps))
    return min(ends, key=lambda e: e[0])


def _vectors(rows):
    return np.array([[r[c] for c in quality.X] for r in rows], float) / quality.UNIT


@pytest.mark.parametrize("few", [50_000, 0])
def test_estimates_and_verdicts_equal_brute_force(spark, monkeypatch, few):
    """Location, precision and ``kept`` of every group of the table, with
    broadcast groups and with shuffled ones."""
    monkeypatch.setattr(quality, "MAX_BROADCAST_GROUPS", few)
    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    stats = quality._vector(quality.text_statistics(docs)).select("*", *(quality._key(k).alias(f"g{k}") for k in range(3)))
    rows = stats.collect()
    groups = {}
    for r in rows:
        for k in range(3):
            groups.setdefault(r[f"g{k}"], []).append(r)
    want = {g: _brute_estimate(_vectors(rs)) for g, rs in groups.items() if len(rs) >= 50}
    got = {r.gk: r for r in quality.robust_estimates(stats).collect()}
    assert set(got) == set(want) and len(set(w[3] for w in want.values())) > 1  # groups end after different steps
    for g, (_, mu, inv, _) in want.items():
        assert np.allclose(got[g].mu, mu, atol=1e-6) and np.allclose(np.array(got[g].inv).reshape(5, 5), inv, rtol=1e-5, atol=1e-5)
    limit, kept = quality.chi2_quantile(1 - 1e-3, 5), {}
    for r, x in zip(rows, _vectors(rows)):
        fit = next((want[r[f"g{k}"]] for k in range(3) if r[f"g{k}"] in want), None)
        good = fit is None or (x - fit[1]) @ fit[2] @ (x - fit[1]) <= limit
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        kept.setdefault(r.doc_id, []).append(bool(good and not failed))
    have = {}
    for r in quality.judge(docs).collect():
        have.setdefault(r.doc_id, []).append(r.kept)
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in kept.items()}


def test_outliers_go_and_clean_documents_stay(spark):
    """Held-out labels: no document labelled bad stays, next to none of the
    good ones that pass the base rules goes."""
    got = quality.judge(spark.read.parquet(f"{H.SF}/documents.parquet"))
    labels = spark.read.parquet(f"{H.SF}/labels.parquet")
    n = {(r.quality, r.kept): r["count"] for r in got.where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert n.get((0, True), 0) == 0 and n[(0, False)] >= 20
    assert n.get((1, False), 0) <= 0.005 * n[(1, True)]


def _prose(rng, n, letters=5, per_line=10):
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(letters)) for _ in range(n)]
    return "\n".join(" ".join(words[k:k + per_line]) for k in range(0, n, per_line))


def test_an_outlier_in_any_single_dimension_goes(spark):
    import random

    rng = random.Random(3)
    menu = [_prose(rng, 1) for _ in range(30)]
    again = _prose(rng, 45, per_line=50)
    planted = [_prose(rng, 5000), _prose(rng, 200, letters=12), _prose(rng, 200) + " #$%" * 10,
               "\n".join(rng.choice(menu) for _ in range(200)), f"{_prose(rng, 110)} {again}\n{_prose(rng, 5)} {again}"]
    rows = [(k, _prose(rng, rng.randint(150, 250))) for k in range(200)] + [(1000 + k, t) for k, t in enumerate(planted)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge(docs).collect()}
    assert [got[1000 + k] for k in range(5)] == [(False, False)] * 5
    assert all(got[k][1] for k in range(200))


def test_estimates_count_documents_not_distinct_vectors(spark):
    """A few templates with many rows, beside fewer rows of scattered junk."""
    import random

    rng = random.Random(5)
    clean = [_prose(rng, 180 + 10 * k) for k in range(5)]
    junk = [" ".join(_prose(rng, 1, letters=rng.randint(3, 5)) + "#" * rng.randint(1, 9) for _ in range(rng.randint(60, 900))) for _ in range(60)]
    rows = [(k, clean[k % 5], "s") for k in range(500)] + [(1000 + k, t, "s") for k, t in enumerate(junk)]
    rows += [(2000 + k, clean[0], "copies") for k in range(60)]
    docs = spark.createDataFrame([(i, t, "en", s) for i, t, s in rows], "doc_id long, text string, lang string, source string")
    stats = quality._vector(quality.text_statistics(docs))
    assert sum('"a":0' in r.gk for r in quality.robust_estimates(stats).collect()) == 2
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert kept == set(range(500)) | set(range(2000, 2060))


def test_quality_filter_keeps_columns_and_rows(spark):
    docs = H.edge_docs(spark)
    out = quality.filter_documents(docs)
    assert out.columns == docs.columns
    assert out.count() == quality.judge(docs).where("kept").count()
    assert quality.filter_documents(H.empty_docs(spark)).count() == 0


# -- 5 --------------------------------------------------------------------------------

BENCH = [(1, "of the"), (2, "Is"), (None, "b a"), (5, None), (6, "..."), (2, "the")]


@pytest.mark.parametrize("block_bytes", [4 << 20, 1500])
def test_contamination(spark, docs, block_bytes):
    rows = texts_of(docs)
    long = [t for _, t in rows if t and 30 < len(t.split()) < 400][:3]
    bench = BENCH + [(40 + k, " ".join(t.split()[2:40])) for k, t in enumerate(long)]
    table = spark.createDataFrame(bench, "item_id long, text string").unionByName(spark.read.parquet(f"{H.SF}/benchmark.parquet"))
    bench = [(r.item_id, r.text) for r in table.collect()]
    got = decontaminate.contamination(docs, table, block_bytes=block_bytes)
    assert H.rows_of(got.drop("row_hash")) == H.in_order(H.contamination(rows, bench))


@pytest.mark.parametrize("block_bytes", [4 << 20, 1])
def test_contamination_has_one_worker_a_task(spark, block_bytes):
    """No stage has two Python steps, each of which would have a worker of its
    own; also where the other blocks' hits could be broadcast."""
    docs = spark.range(5).selectExpr("id doc_id", "concat('some words of text ', id) text")
    bench = spark.createDataFrame([(1, "words of text 3"), (2, "no such")], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        found = decontaminate.contamination(docs, bench, block_bytes=block_bytes)
        assert [r.doc_id for r in found.where("contaminated").collect()] == [3]
        node = found._jdf.queryExecution().executedPlan().toString().split("MapInArrow")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(node) == 2 if block_bytes > 1 else len(node) > 2
    assert block_bytes > 1 or " Exchange hashpartitioning" in node[1]


def test_contamination_without_items(spark):
    docs = H.edge_docs(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.filter_documents(docs, none).count() == docs.count()


def test_longest_matches_and_filter(spark):
    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    bench = spark.read.parquet(f"{H.SF}/benchmark.parquet")
    words = lambda t: H.WORD13.findall((t or "").translate(H.LOWER))
    texts, items = {d: words(t) for d, t in texts_of(docs)}, {str(r.item_id): words(r.text) for r in bench.collect()}
    found = decontaminate.longest_matches(docs, bench).collect()
    assert found
    for r in found:
        item, text = items[r.item_id][r.place:], texts[r.doc_id][r.position:]
        assert item[:r.length] == text[:r.length]
        assert r.length == len(item) or item[:r.length + 1] != text[:r.length + 1]
    kept = decontaminate.filter_documents(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == decontaminate.contamination(docs, bench).where("not contaminated").count() < docs.count()


def _longest(texts, items):
    """Of every item suffix: (item, place) to (length, doc_id, position)."""
    out = {}
    for name, item in items:
        for place in range(len(item)):
            best = None
            for i, text in texts:
                for at in range(len(text)):
                    n = 0
                    while place + n < len(item) and at + n < len(text) and item[place + n] == text[at + n]:
                        n += 1
                    key = (-n, (i is not None, i or 0), at)
                    if n and (best is None or key < best[0]):
                        best = key, (n, i, at)
            if best:
                out[name, place] = best[1]
    return out


@pytest.mark.parametrize("block_bytes", [4 << 20, 40])
def test_longest_matches_name_the_earliest(spark, block_bytes):
    import random

    rng = random.Random(8)
    texts = [(9 - k if k != 4 else None, [rng.choice("abcd") for _ in range(rng.randint(0, 30))]) for k in range(9)]
    texts += [(2, texts[3][1]), (20, texts[4][1]), (1, texts[4][1])]
    items = [(str(k), [rng.choice("abcde") for _ in range(rng.randint(0, 12))]) for k in range(6)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")
    table = spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id string, text string")
    for parts in (1, 3):
        got = decontaminate.longest_matches(docs.repartition(parts), table, block_bytes=block_bytes).collect()
        assert {(r.item_id, r.place): (r.length, r.doc_id, r.position) for r in got} == _longest(texts, items)


# -- 7 --------------------------------------------------------------------------------

def test_perfect_hash_is_minimal():
    keys = [f"k{i}".encode() for i in range(3000)] + [b"", b"\xff\x00"]
    h = bpe.PerfectHash(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    assert (h.slots(keys) == h.slot_of).all()
    assert bpe.PerfectHash([b"x"]).slots([b"x", b"y"]).tolist() == [0, 0]


def test_bpe_equals_the_public_library(docs):
    import tiktoken

    content = queries.vocabulary_file("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(content), special_tokens={})
    want = []
    for d, t in texts_of(docs):
        ids = encoding.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert H.rows_of(bpe.token_digests(docs, content, public_tokenizers.PATTERN)) == H.in_order(want)


def test_piece_table_starts_anew(monkeypatch):
    table = bpe.PieceTable(lambda new: [[len(p)] * len(p) for p in new], limit=3)
    for words in (["a", "bb", "a"], ["ccc", "", "bb"], ["dddd"], ["a", "ccc"]):
        table.begin()
        rows = np.array([table[w] for w in words])
        table.settle()
        assert table.look_up(rows).tolist() == [len(w) for w in words for _ in w]


# -- 8 --------------------------------------------------------------------------------

def test_near_duplicates(docs):
    got = simhash.near_duplicates(docs).collect()
    rows = texts_of(docs)
    fps = [H.fingerprint(t) for _, t in rows]
    want = [(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, H.clusters(fps, [d for d, _ in rows]))]
    assert H.in_order((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got) == H.in_order(want)


@pytest.mark.parametrize("limit", [4_000_000, 3000])
def test_links_of_close_words(spark, limit):
    """Random words and their neighbours, also where a prefix is dealt to
    several tasks."""
    import random

    rng = random.Random(4)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(6):
            fps.add(f)
            for _ in range(rng.choice([1, 2, 3, 4, 5])):
                f ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    from tidemark.llm.components import components
    from tidemark.session import materialize

    table, _ = materialize(spark.createDataFrame([(f,) for f in signed], "fp long"), "words")
    edges = simhash.links(table, prefix_bits=8, task_variants=limit)
    found = {r.node: r.root for r in components(edges).collect()}
    got = {}
    for f, s in zip(fps, signed):
        got.setdefault(found.get(s, s), set()).add(f)
    want = {}
    for f, c in zip(fps, H.clusters(fps, fps)):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_hubs(spark):
    from tidemark.llm.components import components

    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101 + k) for k in range(50)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{101 + k: 100 for k in range(50)}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_first_of_each_component(spark):
    docs = H.edge_docs(spark)
    out = simhash.keep_first(docs)
    rows = texts_of(docs)
    assert out.columns == docs.columns
    assert out.count() == len(set(H.clusters([H.fingerprint(t) for _, t in rows], list(range(len(rows))))))
    named = [r.doc_id for r in out.collect() if r.doc_id is not None]
    assert set(named) <= {d for d, _ in rows}
    assert simhash.keep_first(H.empty_docs(spark)).count() == 0


def test_keep_first_tells_components_apart_that_share_an_id(spark):
    """Unrelated texts whose ids are all null, or which share one id."""
    prose = ["alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red green blue black white grey",
             "iron copper silver gold tin lead zinc"]
    rows = [(None, prose[0]), (None, prose[0]), (None, prose[1]), (7, prose[2]), (7, prose[3]), (9, prose[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [(r.doc_id, r.text) for r in simhash.keep_first(docs).collect()]
    assert H.in_order(out) == H.in_order([(None, prose[0]), (None, prose[1]), (7, prose[2]), (7, prose[3])])
