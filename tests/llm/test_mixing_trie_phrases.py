"""Source mixing, the prefix trie and phrase mining against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import helpers as H
from tidemark.llm import collocations, mixing, prefixtrie

# -- 11 --------------------------------------------------------------------------


def _targets(totals, weights, cap):
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    stopped, total = {}, sum(totals.values())
    while True:
        free = [s for s in order if s not in stopped]
        if not free:
            return stopped
        unit = (total - sum(stopped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] >= cap * totals[s]]
        if not over:
            return stopped | {s: unit * weight[s] for s in free}
        stopped |= {s: cap * totals[s] for s in over}


def _tilt(sizes, target, cap):
    """By bisection, without the dual's derivatives."""
    sizes = np.array(sizes, float)
    x = sizes / sizes.mean()
    lo, hi = -5000.0, 5000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        given = (sizes * np.minimum(cap, np.exp(np.minimum(mid * x, 50)))).sum()
        lo, hi = (mid, hi) if given < target else (lo, mid)
    return np.minimum(cap, np.exp(np.minimum(lo * x, 50)))


def _check_mix(df, weights=(5, 2, 1), cap=3):
    rows = [tuple(r) for r in df.select("doc_id", "source", "size").collect()]
    got = [r.asDict() for r in mixing.mix(df, list(weights), cap).collect()]
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(rows)
    totals = Counter()
    for _, s, n in rows:
        totals[s] += n
    want = _targets(dict(totals), weights, cap)
    taken = Counter()
    for r in got:
        assert r["source_size"] == totals[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-12, abs_tol=1e-9)
        assert math.floor(r["rate"]) <= r["copies"] <= min(cap, math.ceil(r["rate"]))
        taken[r["source"]] += r["copies"] * r["size"]
    for s in totals:
        of = sorted((r["size"], r["rate"]) for r in got if r["source"] == s and r["size"])
        if of:
            assert abs(sum(n * r for n, r in of) - want[s]) <= max(1.0, 1e-6 * want[s])
            assert np.allclose([r for _, r in of], _tilt([n for n, _ in of], want[s], cap), atol=max(1e-4, 2 / want[s]))
            assert abs(taken[s] - want[s]) <= max(n for n, _ in of)
    return got, taken, want


def test_mix_of_the_documents(spark):
    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    sized = docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"))
    words = {r.doc_id: len(H.SPACED.findall(r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in sized.collect()} == words
    got, taken, want = _check_mix(sized)
    for s, t in want.items():
        assert abs(taken[s] - t) < 0.01 * t
    again = mixing.mix(sized.repartition(7), [5, 2, 1], 3).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in got) == sorted((r.doc_id, r.copies) for r in again)


@pytest.mark.parametrize("seed", range(2))
def test_mix_of_uneven_sources(spark, seed):
    """A hot source, sources far below their share, empty ones, null, repeated rows."""
    rng = random.Random(seed)
    rows = [(k, "hot", rng.choice([1, 5, 40, 900, 30_000])) for k in range(3000)]
    rows += [(k, s, rng.randint(0, 60)) for s in ("a", "Z", "é", "tiny", None) for k in range(rng.randint(1, 40))]
    rows += [(k, "none", 0) for k in range(5)] + [(None, "b", 7)] * 9 + [(3, "b", 7)] * 500 + [(1, "one", 12)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, size long, target string").repartition(6)
    got, _, want = _check_mix(df)
    assert {r["copies"] for r in got if r["source"] == "tiny" and r["size"]} == {3}  # stopped at three times its size
    assert all(r["copies"] == 1 for r in got if not r["size"])


def test_mix_of_nothing_and_of_rows(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string, size long"), [5, 2, 1]).count() == 0
    blank = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert sorted((r.doc_id, r.target, r.copies) for r in mixing.mix(blank, [5, 2, 1]).collect()) == [(1, 0.0, 1), (2, 0.0, 1)]
    docs = H.edge_docs(spark)
    mixed = mixing.mix_documents(docs, [1, 4], 3)
    assert mixed.columns == docs.columns
    sized = docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"))
    plan = Counter()
    for r in mixing.mix(sized, [1, 4], 3).collect():
        plan[r.doc_id, r.source, r["size"]] += r.copies
    taken = Counter((r.doc_id, r.source, len(H.SPACED.findall(r.text or ""))) for r in mixed.collect())
    assert taken == +plan


# -- 12 --------------------------------------------------------------------------

def _trie(rows, block=100, most=6):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            mark = hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).digest()
            convs[c].append(((t is not None, t), r, mark, x))
    own = {c: [(r, x) for _, r, _, x in sorted(turns)] for c, turns in convs.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        path = tuple(own.get(c - int(math.fmod(c, block)), [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return H.in_order((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends.get(p, [])))
                      for p, m in members.items())


def _check_trie(df, **parameters):
    want = _trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    got = H.rows_of(prefixtrie.block_trie(df, **parameters), "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    "saved_tokens", "ends_sha256")
    assert got == want
    return got


def test_trie_of_the_conversations(spark):
    _check_trie(spark.read.parquet(f"{H.SF}/conversations.parquet"))


@pytest.mark.parametrize("local_turns", [200_000, 150, 0])
def test_trie_edges(spark, local_turns):
    """Long conversations, one opening shared by all, copies, turnless ones."""
    rng = random.Random(5)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a", "b", "é" * t])) for c in range(100, 260) for t in range(rng.randint(1, 9))]
    rows += [(c, t, "user", "same") for c in range(300, 360) for t in range(3)]  # copies
    rows += [(c, t, "system", f"turn {t}" if t < 14 else f"{c}") for c in range(400, 408) for t in range(19)]
    rows += [(7, 0, None, None), (7, None, "user", "first"), (7, 0, None, None), (-3, 1, "x", "y"), (None, 0, "user", "nobody"), (5_000_000_000, 2, "", "")]
    rows += [(c, 0, "user", "only one") for c in range(501, 540)]  # block without its first: many lose it
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(5)
    got = _check_trie(df, local_turns=local_turns, band=4, part=7)
    assert max(r[1] for r in got) == 19


def test_trie_of_nothing_and_of_turnless(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefixtrie.block_trie(spark.createDataFrame([], schema)).count() == 0
    lost = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    _check_trie(spark.createDataFrame([(lost, 0, "user", "hello")], schema))


# -- 13 --------------------------------------------------------------------------

def _phrases(docs, longest, least, covered, top):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(H.LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                if 100 * a >= covered * f[p[i:i + k]]}
        rows = []
        for p in found.keys() - gone:
            score, _, l, r = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -f[p], " ".join(p).encode(), l, r))
        out += [(lang, k, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return H.in_order(out)


def _check_phrases(df, longest=4, least=30, covered=80, top=2000, **parameters):
    want = _phrases([tuple(r) for r in df.select("lang", "text").collect()], longest, least, covered, top)
    assert H.rows_of(collocations.collocations(df, longest, least, covered, top, **parameters)) == want
    return want


@pytest.mark.parametrize("shard_words", [collocations.SHARD_WORDS, 3000])
def test_phrases_of_the_documents(spark, shard_words):
    assert _check_phrases(spark.read.parquet(f"{H.SF}/documents.parquet"), shard_words=shard_words)


@pytest.mark.parametrize("longest,least,top,shard_words", [(4, 2, 50, 40), (4, 2, 2000, 1 << 21), (2, 3, 10, 100), (3, 1, 2000, 64)])
def test_phrases_on_edges(spark, longest, least, top, shard_words):
    assert _check_phrases(H.edge_docs(spark), longest, least, 80, top, shard_words=shard_words)


def test_phrases_of_few_words(spark):
    """Runs of one word, ties in score, count and place, pieces cut everywhere."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "B", "b", "a.", "c,", "\t", "d\n", "a\x00", "é!"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += ["a " * 500, "...", "x\x0by\x0cz", None, "É é", " \t "]
    langs = ["en", "und", None, "de"]
    df = spark.createDataFrame([(langs[k % 4], t, k) for k, t in enumerate(texts)], "lang string, text string, n int").repartition(6)
    for least, top in ((5, 2000), (1, 7)):
        _check_phrases(df, 4, least, 80, top, shard_words=97, bucket=300, fan=3)


def test_phrases_of_nothing(spark):
    assert collocations.collocations(H.empty_docs(spark)).count() == 0


def test_interval_extension_on_both_sides():
    rng = random.Random(1)
    codes = [0]
    for _ in range(400):
        codes += [rng.randint(1, 4) for _ in range(rng.randint(1, 6))] + [0]
    codes = np.array(codes)
    after = collocations.successors(collocations.transform(codes, 4))
    sizes = np.bincount(codes)
    lo, n = np.concatenate([[0], np.cumsum(sizes)[:-1]])[1:], sizes[1:]
    phrases = [(int(w),) for w in range(1, 5)]
    for size in range(2, 5):
        lo, n, head, tail = collocations.extend(after, lo, n)
        phrases = [phrases[h] + phrases[t][-1:] for h, t in zip(head, tail)]
        want = Counter(tuple(codes[i:i + size].tolist()) for i in range(len(codes) - size + 1) if 0 not in codes[i:i + size])
        assert dict(zip(phrases, n.tolist())) == dict(want)
