"""Registered queries of the numbered operators: each applies one operator,
with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, chat, collocations, decontaminate, htmltext, mixing, prefixtrie, quality, sharding, simhash, suffix,
    tokenfiles, urlrules,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary_file(name: str) -> bytes:
    """A public vocabulary file, read by the driver."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def vocabulary_pattern() -> str:
    return public_tokenizers.PATTERN


def op1_token_files(spark, sf):
    return tokenfiles.token_digests(_table(spark, sf, "documents"), vocabulary_file("word_bpe_49k.json"), end_id=2)


def op2_html_extraction(spark, sf):
    return htmltext.main_text(_table(spark, sf, "pages"))


def op3_suffix_array_dedup(spark, sf):
    return suffix.removal_digests(_table(spark, sf, "documents"), length=100)


def op4_quality_rules(spark, sf):
    return quality.judge(_table(spark, sf, "documents"))


def op5_benchmark_decontamination(spark, sf):
    return decontaminate.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"),
                                       window=13, percent=5).drop("row_hash")


#: A conversation that imitates the template's control strings.
_IMITATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_formatting(spark, sf):
    more = spark.createDataFrame(_IMITATION, "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.conversation_digests(rows)


def op7_byte_bpe(spark, sf):
    return bpe.token_digests(_table(spark, sf, "documents"), vocabulary_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_simhash_near_dedup(spark, sf):
    rows = simhash.near_duplicates(_table(spark, sf, "documents"), width=4, max_bits=4, seed=42)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: (host, path, verdict), fixed by the query's contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op9_url_filters(spark, sf):
    return urlrules.judge(_table(spark, sf, "pages"), urlrules.rule_table(spark, URL_RULES))


SHARDS = [f"shard-{k:02d}" for k in range(32)]
#: Prime, over a hundred slots for each shard.
SLOTS = 4099


def op10_sharding(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", SHARDS, SLOTS)


def op11_source_mixing(spark, sf):
    docs = _table(spark, sf, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(sized, weights=[5, 2, 1], cap=3)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "rate", "copies")


def op12_prefix_trie(spark, sf):
    return prefixtrie.block_trie(_table(spark, sf, "conversations"), block=100, most=6)


def op13_phrase_collocations(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents"), longest=4, least=30, covered=80, top=2000)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_html_extraction": op2_html_extraction,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_sharding": op10_sharding,
    "op11_source_mixing": op11_source_mixing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op9_url_filters"] = """
WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
after_scheme AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM after_scheme),
best AS (
  SELECT s.page_id, s.host, s.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
  FROM split s LEFT JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best WHERE k = 1"""

ORACLE_SQL["op10_sharding"] = f"""
WITH RECURSIVE shards AS (
  SELECT i::BIGINT AS i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS shard FROM range({len(SHARDS)}) t(i)),
preferences AS (
  SELECT i, shard, ('0x' || substr(md5('offset:' || shard), 1, 15))::BIGINT % {SLOTS} AS first_slot,
         ('0x' || substr(md5('skip:' || shard), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS skip FROM shards),
turns AS (
  SELECT 0::BIGINT AS turn, [-1::BIGINT for j in range({SLOTS})] AS owner
  UNION ALL
  SELECT turn + 1, owner[1:slot] || [i] || owner[slot + 2:]
  FROM (SELECT t.turn, t.owner, p.i,
               ([(p.first_slot + j * p.skip) % {SLOTS} for j in range({SLOTS})
                 if t.owner[(p.first_slot + j * p.skip) % {SLOTS} + 1] = -1])[1] AS slot
        FROM turns t JOIN preferences p ON p.i = t.turn % {len(SHARDS)} WHERE t.turn < {SLOTS})),
slots AS (
  SELECT unnest(range({SLOTS})) AS slot, unnest(owner) AS i FROM turns WHERE turn = {SLOTS}),
keys AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT k.doc_id, k.slot::INTEGER AS slot, s.shard FROM keys k JOIN slots l ON l.slot = k.slot JOIN shards s ON s.i = l.i"""

ORACLE_SQL["op5_benchmark_decontamination"] = r"""
WITH split AS (
  SELECT 'document' AS side, doc_id AS id, row_number() OVER () AS row_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT 'item', item_id, row_number() OVER (),
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
items AS (
  SELECT id, words, least(13, len(words)) AS size FROM split WHERE side = 'item' AND len(words) > 0),
item_windows AS (
  SELECT DISTINCT coalesce(id::VARCHAR, 'null') AS item, size, words[k:k + size - 1] AS part
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS k FROM items)),
sizes AS (SELECT DISTINCT size FROM item_windows),
document_windows AS (
  SELECT row_id, k, size, words[k:k + size - 1] AS part
  FROM (SELECT row_id, words, size, unnest(range(1, len(words) - size + 2)) AS k
        FROM split, sizes WHERE side = 'document' AND len(words) >= size)),
found AS (SELECT d.row_id, d.k, d.size, i.item FROM document_windows d JOIN item_windows i ON d.size = i.size AND d.part = i.part),
hits AS (
  SELECT row_id, count(DISTINCT p) AS n_hit
  FROM (SELECT row_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY row_id),
named AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row_id, item FROM found) GROUP BY row_id)
SELECT s.id AS doc_id, len(s.words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(s.words), false) AS contaminated
FROM split s LEFT JOIN hits USING (row_id) LEFT JOIN named USING (row_id) WHERE s.side = 'document'"""

ORACLE_SQL["op6_chat_formatting"] = r"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL
  VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER w AS place, lag(coalesce(role, '')) OVER w AS before
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
marked AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\|<<SYS>>|<</SYS>>|</?s>|\[/?INST\]|\[ROLE:|\[/ROLE\]')) AS text_size,
         CASE role WHEN 'system' THEN 8 + 11 WHEN 'user' THEN 10 + 8 WHEN 'assistant' THEN 1 + 5
              ELSE 6 + length(role) + len(regexp_extract_all(role, '\\|<<SYS>>|<</SYS>>|</?s>|\[/?INST\]|\[ROLE:|\[/ROLE\]'))
                   + len(regexp_extract_all(role, '\]')) + 2 + 7 END AS mark_size,
         CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user'
              WHEN before = 'user' THEN role = 'assistant' WHEN before = 'assistant' THEN role = 'user' ELSE false END AS ok
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(text_size + mark_size)::BIGINT AS formatted_chars, bool_and(ok) AS valid
FROM marked GROUP BY conv_id"""

ORACLE_SQL["op3_suffix_array_dedup"] = """
WITH texts AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (SELECT doc_id, s, b[s + 1:s + 100] AS part FROM (SELECT doc_id, b, unnest(range(0, n - 99)) AS s FROM texts)),
again AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY part ORDER BY doc_id, s) AS k FROM windows) WHERE k > 1),
islands AS (
  SELECT doc_id, s, sum(CASE WHEN s <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS island
  FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM again)),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS e FROM islands GROUP BY doc_id, island),
pieces AS (
  SELECT doc_id, a AS place, hex(b[coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1:a]) AS piece
  FROM spans JOIN texts USING (doc_id)
  UNION ALL
  SELECT doc_id, n, hex(b[coalesce(max(e), 0) + 1:any_value(n)]) FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id, b, n),
counts AS (SELECT doc_id, sum(e - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, t.n::BIGINT AS n_bytes, coalesce(c.n_removed, 0)::BIGINT AS n_removed, coalesce(c.n_spans, 0) AS n_spans, p.kept_sha256
FROM texts t LEFT JOIN counts c USING (doc_id)
JOIN (SELECT doc_id, sha256(unhex(string_agg(piece, '' ORDER BY place))) AS kept_sha256 FROM pieces GROUP BY doc_id) p USING (doc_id)"""


ORACLE_SQL["op13_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM split GROUP BY lang),
counts AS (
  SELECT lang, size, part, count(*) AS f
  FROM (SELECT lang, size, words[i:i + size - 1] AS part
        FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
              FROM split, (VALUES (1), (2), (3), (4)) s(size) WHERE len(words) >= size))
  GROUP BY lang, size, part),
candidates AS (SELECT * FROM counts WHERE size > 1 AND f >= 30),
inside AS (
  SELECT lang, f, part[i:i + k - 1] AS part
  FROM (SELECT lang, f, part, size, k, unnest(range(1, size - k + 2)) AS i
        FROM candidates, (VALUES (2), (3)) s(k) WHERE k < size)),
longer AS (SELECT lang, part, max(f) AS f FROM inside GROUP BY lang, part),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer g ON g.lang = c.lang AND g.part = c.part
  WHERE g.f IS NULL OR 100 * g.f < 80 * c.f),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.part, c.f AS a, c.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.f) // (l.f + r.f))::BIGINT AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.part = c.part[1:c.k]
  JOIN counts r ON r.lang = c.lang AND r.part = c.part[c.k + 1:]),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, part ORDER BY score, k) AS place FROM scored),
ranked AS (
  SELECT lang, array_to_string(part, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(part, ' ')) AS rank
  FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

#: The checksum, bit by bit: crc32 of the decimal id.
ORACLE_SQL["op12_prefix_trie"] = r"""
WITH given AS (
  SELECT conv_id, octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS turn_text,
         length(coalesce(text, '')) AS size, turn, coalesce(role, '') AS role
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, md5(turn_text) AS mark, size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(turn_text)) AS place FROM given),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')]),
                         lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT for i in range(8)]),
                                                  lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))),
             4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT i.conv_id, 0 AS part, o.place, o.mark, o.size FROM ids i JOIN own o ON o.conv_id = i.base WHERE o.place <= i.h
  UNION ALL
  SELECT i.conv_id, 1, o.place, o.mark, o.size FROM ids i JOIN own o ON o.conv_id = i.conv_id WHERE o.place > i.h),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, size, string_agg(mark, '') OVER w AS name
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
members AS (SELECT conv_id, depth, size, name FROM prefixes UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
lengths AS (SELECT conv_id, max(depth) AS n FROM members GROUP BY conv_id),
nodes AS (
  SELECT name, min(conv_id) AS conv_id, any_value(depth)::BIGINT AS depth, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = n), '')) AS ends_sha256
  FROM members JOIN lengths USING (conv_id) GROUP BY name),
children AS (SELECT left(name, length(name) - 32) AS name, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (name)),
below AS (
  SELECT left(name, 32 * d::INTEGER) AS name, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM counted n JOIN below b USING (name) LEFT JOIN nodes p ON n.depth > 0 AND p.name = left(n.name, length(n.name) - 32)"""
