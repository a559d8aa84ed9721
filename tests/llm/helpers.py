"""Edge tables and brute-force versions for the tests of tidemark.llm."""

import hashlib
import random
import re
from collections import Counter

SF = "/root/testdata/sf0.01"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Other columns whose names the operators use inside.
CLASHES = ("id", "key", "fp", "bucket", "part", "hits", "items", "row", "row_hash", "gk", "kind", "start", "prefix", "root",
           "_id", "_hash", "_row", "component_id", "kept", "gone", "ranges", "wanted", "first", "shard")


def edge_texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = prose(80)
    out = [None, "", "   ", "\n\t \r\x0b", "one", "Two  words", "a" * 700, "ab " * 400, "é" * 130, prose(30_000),
           "日本語 テキスト\u2003x\u00a0y", "\x1c\x1f odd \x00 bytes", "line\nline\nline\n\n", "<|endoftext|> [INST] </s>"]
    for k in range(30):
        text = prose(rng.randint(3, 150))
        if k % 3 == 0:
            text = f"{text} {shared}. {prose(40)}"
        out.append(text)
    out += [out[20], out[23], out[23] + " x", out[26].upper(), out[29][:-3]]
    return out


def edge_docs(spark):
    """Null ids, an id with several texts, repeated rows, clashing columns."""
    texts = edge_texts()
    rows = [(k * 7 % 1000, t) for k, t in enumerate(texts)]
    rows += [(None, texts[20]), (None, None), (7, "another text of one id"), rows[21], rows[21], rows[1], (-5, texts[24])]
    lang = ["en", "de", None]
    data = [(i, t, lang[k % 3], f"s{k % 2}" if k % 5 else None, len(t or "")) + (k,) * len(CLASHES) for k, (i, t) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHES)
    return spark.createDataFrame(data, schema).repartition(5)


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def rows_of(df, *cols):
    """Sorted rows, nulls first."""
    rows = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def statistics(text):
    words = SPACED.findall(text or "")
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def fingerprint(text, width=4):
    import xxhash

    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def removals(docs, length):
    """(id, text) rows in any order to each distinct one's digests; order is
    by id (null first), then by what ``tie`` of the text says."""
    seen, out = set(), {}
    for key, data in docs:
        mask = bytearray(len(data))
        for i in range(len(data) - length + 1):
            w = data[i:i + length]
            if w in seen:
                mask[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, m in zip(data, mask) if not m)
        spans = len(re.findall(rb"\x01+", bytes(mask)))
        out[key] = (len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest())
    return out


WORD13 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, bench, window=13):
    words = lambda t: WORD13.findall((t or "").translate(LOWER))
    windows = {}
    for i, t in bench:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + window]), set()).add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    items |= found
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def clusters(fps, ids, bits=4):
    """Least non-null id of each row's component."""
    distinct = sorted(set(fps))
    parent = {f: f for f in distinct}

    def find(f):
        while parent[f] != f:
            f = parent[f] = parent[parent[f]]
        return f

    for a in range(len(distinct)):
        for b in range(a):
            if (distinct[a] ^ distinct[b]).bit_count() <= bits:
                parent[max(find(distinct[a]), find(distinct[b]))] = min(find(distinct[a]), find(distinct[b]))
    least = {}
    for f, i in zip(fps, ids):
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [least.get(find(f)) for f in fps]
