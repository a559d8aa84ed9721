"""Pages, conversations, URLs, sharding, registered queries and the pipeline."""

import hashlib
import random
import re

import duckdb
import pytest

from tests.llm import helpers as H
from tidemark.llm import chat, htmltext, queries, sharding, urlrules

# -- 2 -------------------------------------------------------------------------

PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1><a href=x>Home</a></header>
<div id="cookie-notice">We use cookies</div><div class="content"><h2>Title here</h2><p>First para with some more words in it
and <a href=y>link</a> text.<p>Second   para&nbsp;one &lt;ok&gt;<br>next line.<form><input name=q><button>Go</button></form>
<blockquote>Quote.</blockquote><table><tr><td>a</td><td>b</td></tr></table></div><section class="comments"><p>A reader's comment
that is quite as long as any paragraph of the article itself is.</p></section><aside>Side</aside><footer>(c) me</footer></body></html>"""


def test_main_text_without_an_article_element():
    assert htmltext.extract(PAGE) == ("Title here\n\nFirst para with some more words in it and link text.\n\n"
                                      "Second para one <ok> next line.\n\nQuote.\n\na b")


@pytest.mark.parametrize("html,text", [
    ("", ""), ("plain  text", "plain text"), ("<p>x", "x"), ("<div>a</div><div>b", "a\n\nb"), ("<script>x", ""), ("<nav>only</nav>", ""),
    ("<article><p>a&amp;b &#233;</article>", "a&b é"), ("<article><h1>T</h1><p>x<br>y</p><aside>no</aside></article>", "T\n\nx y"),
    ("<div class='layout sidebar-right'><article><p>kept</p></article></div>", "kept"),
    ("<article><p>one</p><div class=ad>buy</div><p>two</p></article><p>out", "one\n\ntwo"), ("</p></b><", "<"),
])
def test_main_text_cases(html, text):
    assert htmltext.extract(html) == text


@pytest.mark.parametrize("before", ["", "<nav><a href=x>Home</a></nav>"])
def test_main_text_keeps_text_beside_the_longest_block(before):
    short, long = ("word " * 20).strip(), ("word " * 40).strip()
    two = f"<body>{before}<p>{long}</p><p>{short}</p></body>"
    assert htmltext.extract(two) == f"{long}\n\n{short}"
    many = f"<body>{before}<div><p>{long * 40}</p>" + f"<p>{short}</p>" * 10 + "</div></body>"
    assert htmltext.extract(many) == "\n\n".join([long * 40] + [short] * 10)
    lead = f"<body>{before}<h1>Headline</h1><p>Lead.</p><div><p>{long}</p><p>{long}</p></div></body>"
    assert htmltext.extract(lead) == f"Headline\n\nLead.\n\n{long}\n\n{long}"


_LONG = [("word %d of the text that the page is about, " % k) * 6 + "end." for k in range(4)]


@pytest.mark.parametrize("opened,closed", [
    ('<div class="page has-sidebar">', "</div>"), ('<div class="site header-fixed">', "</div>"), ('<form action="/">', "</form>"),
    ('<form id="aspnetForm"><div class="content">', "</div></form>"), ('<form><article>', "</article></form>"),
    ('<div class="wrapper with-nav no-comments">', "</div>"), ('<div class="sidebar">', "</div>"), ('<div id="header-content">', "</div>"),
    ('<div class="layout sidebar-right"><main>', "</main></div>"), ("<article>", "</article>"), ("", "")])
@pytest.mark.parametrize("around", ["", '<nav><a href=x>Home</a> <a href=y>All news</a></nav><div class="cookie-notice">We use cookies.</div>'])
def test_main_text_inside_layout(opened, closed, around):
    body = "".join(f"<p>{p}</p>" for p in _LONG)
    page = f'<body>{around}{opened}{body}{closed}<footer>(c) me</footer><div class="site-footer">Imprint</div></body>'
    assert htmltext.extract(page) == "\n\n".join(_LONG)


@pytest.mark.parametrize("opened,name", [
    ('<section id="search-algorithms">', "section"), ('<h2 id="related-work">', "h2"), ('<div class="social-history">', "div"),
    ('<p class="share-price">', "p"), ('<section id="search">', "section"), ('<h2 id="legal">', "h2"), ('<div class="entry-header">', "div"),
    ('<p class="promotion-to-premier">', "p"), ('<div id="alert-levels">', "div")])
@pytest.mark.parametrize("region", ["article", "div"])
def test_main_text_keeps_sections_of_their_titles_name(opened, name, region):
    page = f"<body><{region}><p>{_LONG[0]}</p>{opened}Some more of it.</{name}><p>{_LONG[1]}</p></{region}></body>"
    assert htmltext.extract(page) == f"{_LONG[0]}\n\nSome more of it.\n\n{_LONG[1]}"


@pytest.mark.parametrize("opened,name", [
    ('<div class="related-posts">', "div"), ('<ul class="share-buttons">', "ul"), ('<div class="newsletter">', "div"), ('<div class="adSlot">', "div"),
    ('<section class="comments"><article class="comment">', "article></section"), ('<form class="x">', "form"), ('<div role="alert">', "div"),
    ('<div id="cookie-consent">', "div"), ('<div class="left menu">', "div")])
@pytest.mark.parametrize("region", ["article", "div"])
def test_main_text_drops_what_is_apart(opened, name, region):
    page = f"<body><{region}><p>{_LONG[0]}</p><p>{_LONG[1]}</p>{opened}<span>Not the article's.</span></{name}><p>{_LONG[2]}</p></{region}></body>"
    assert htmltext.extract(page) == "\n\n".join(_LONG[:3])


def _brute_region(blocks):
    """Of pages whose blocks are (text, whether it is linked, class): those that
    no class sets apart."""
    return [t for t, _, c in blocks if c not in ("menu", "site-footer", "comments")]


def test_main_text_of_pages_without_articles():
    rng = random.Random(12)
    for _ in range(300):
        inner = [(f"{' '.join(rng.choice(['alpha', 'beta', 'gamma', 'delta']) for _ in range(rng.randint(30, 200)))}.", False, "text-block") for _ in range(rng.randint(1, 6))]
        outer = [("Home News All", True, "menu"), ("Imprint and terms", False, "site-footer"), ("I liked it a lot, said a reader.", False, "comments")]
        wrapper = rng.choice(['<div class="page has-sidebar">', '<form>', '<div class="content">', '<div class="site header-fixed">'])
        end = "</form>" if "form" in wrapper else "</div>"
        block = lambda b: f'<div class="{b[2]}">' + (f"<a href=x>{b[0]}</a>" if b[1] else f"<p>{b[0]}</p>") + "</div>"
        page = f"<body>{block(outer[0])}{wrapper}{''.join(map(block, inner))}{end}{block(outer[2])}{block(outer[1])}</body>"
        assert htmltext.extract(page).split("\n\n") == _brute_region([outer[0], *inner, outer[2], outer[1]])


def test_main_text_of_the_pages(spark):
    import html as entities

    def article(page):
        found = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", found[1])]
        return "\n\n".join(b for b in blocks if b)

    pages = spark.read.parquet(f"{H.SF}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in htmltext.main_text(pages).collect()}
    assert got == {r.page_id: (article(r.html), len(article(r.html))) for r in pages.collect()}


def test_main_text_edges(spark):
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", "", 2), (2, None, "<p>" + "word " * 50_000, 3)]
    got = htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int"))
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, 0, 249_999]
    assert htmltext.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_clusters_and_smoothing():
    import numpy as np

    assert 2 < htmltext.two_means(np.array([0.0, 1, 2, 50, 51, 49])) < 49
    assert htmltext.two_means(np.array([3.0, 3.0])) == 3
    assert np.allclose(htmltext.smooth(np.full(9, 4.0), 1.0), 4.0)


# -- 6 ---------------------------------------------------------------------------

def test_template_round_trip():
    rng = random.Random(2)
    parts = ["</s>", "[INST]", "<s>", "\\", "\\\\", "<", "/s>", "[ROLE:", "]\n", "]", " ", "[/INST]", "<<SYS>>", "<</SYS>>", "x", "[",
             "s>", "[/ROLE]", "é\n"]
    roles = ["user", "assistant", "system", "", "tool", "a]\n[ROLE:b\\"]
    for _ in range(5000):
        turns = [(rng.choice(roles), "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for _ in range(rng.randint(1, 5))]
        formatted = "".join(t for r, x in turns for t, _ in chat.INSTRUCT.segments(r, x))
        assert chat.INSTRUCT.parse(formatted) == turns


def _digest(turns):
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    text = "".join(s for r, t in turns for s, _ in chat.INSTRUCT.segments(r, t))
    valid, state = True, None
    for r, _ in turns:
        valid &= r in chat.INSTRUCT.allowed(state)
        state = r
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text), valid


def _check_conversations(df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    by_conv = {}
    for r in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r)):
        by_conv.setdefault(r[0], []).append(r[2:])
    got = {r[0]: tuple(r)[1:] for r in chat.conversation_digests(df).collect()}
    assert got == {c: _digest(t) for c, t in by_conv.items()}
    return got


def test_conversations(spark):
    got = _check_conversations(spark.read.parquet(f"{H.SF}/conversations.parquet"))
    assert all(g[-1] for g in got.values())


def test_conversation_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "</s>"), (1, 1, "assistant", "</s>"), (2, None, None, "x"), (2, 3, "tool", "[/ROLE]"),
            (None, 0, "user", "q"), (None, 1, "assistant", "y" * 200_000), (3, 0, "assistant", "first"), (4, 5, "system", ""), (4, 5, "user", "")]
    rows += [(9, k, "user" if k % 2 == 0 else "assistant", f"turn {k}") for k in range(3000)]
    df = spark.createDataFrame([r + (0,) for r in rows], "conv_id long, turn long, role string, text string, place int").repartition(7)
    got = _check_conversations(df)
    assert [got[c][-1] for c in (1, 2, 3, 4, 9, None)] == [False, False, False, True, True, True]
    assert chat.conversation_digests(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# -- 9 ----------------------------------------------------------------------------

def _verdict(url, rules):
    low = lambda x: x.translate(H.LOWER)
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        host, path = low(raw), re.match(r"[^?#]*", rest[len(raw):])[0]
    best = None
    for rule_host, rule_path, verdict in rules:
        h = low(rule_host or "")
        if h and rule_path is not None and host and (host == h or host.endswith("." + h)) and path.startswith(rule_path):
            new = (len(h + rule_path), len(h), verdict == "block", h + rule_path, verdict)
            best = max(best or new, new, key=lambda x: x[:3])
    return host, path, best and best[3], best[4] if best else "allow"


@pytest.mark.parametrize("partitions", [1, 7])
def test_url_rules(spark, partitions):
    rng = random.Random(partitions)
    labels = ["a", "b", "c", "net", "org", "Ex", "é"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "".join(rng.choice(["x/", "y", "z/"]) for _ in range(rng.randint(0, 3)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(60)] + [("", "/", "block"), (None, "/", "block"), ("a", None, "block")]
    urls = [(k, rng.choice(["http://", "HTTPS://", "", "x://y://"]) + host() + rng.choice(["", ":80", path(), path()])
             + rng.choice(["", "?q://x", "#f", "/"])) for k in range(800)]
    urls += [(None, None), (-1, ""), (-2, "://"), (-3, "http:///p"), (-3, "http://net/x\ny"), (-3, "http://net/x\ny")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        pages = spark.createDataFrame([u + (1, 2) for u in urls], "page_id long, url string, key int, stack int")
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        assert H.rows_of(urlrules.judge(pages, table)) == H.in_order((i, *_verdict(u, rules)) for i, u in urls)
        assert urlrules.judge(pages, table.limit(0)).where("verdict <> 'allow'").count() == 0
        assert urlrules.judge(pages.limit(0), table).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_url_filters_run_no_python(spark):
    plan = queries.QUERIES["op9_url_filters"](spark, H.SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Cartesian" not in plan


# -- 10 ----------------------------------------------------------------------------

def test_lookup_table_is_even_and_stable():
    shards = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(shards, 1021)
    counts = [int((table == k).sum()) for k in range(7)]
    assert max(counts) - min(counts) <= 1
    after = sharding.lookup_table(shards[:-1], 1021)
    kept = table != 6
    assert (table[kept] == after[kept]).mean() > 0.75
    assert (sharding.lookup_table(["only"], 3) == 0).all()
    for bad in ((shards, 1000), ([], 7), (["a", "a"], 7), (shards, 5)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_place_and_write(spark, tmp):
    docs = H.edge_docs(spark)
    shards = [f"s{k}" for k in range(5)]
    table = sharding.lookup_table(shards, 101)
    placed = sharding.place(docs.drop("shard"), "doc_id", shards, 101)
    assert placed.count() == docs.count()
    for r in placed.select("doc_id", "slot", "shard").collect():
        want = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (want, shards[table[want]])
    sharding.write_shards(docs.drop("shard"), "doc_id", shards, tmp, 101, files_per_shard=3)
    back = spark.read.parquet(tmp)
    assert H.rows_of(back, "doc_id", "text", "shard") == H.rows_of(placed, "doc_id", "text", "shard")
    assert sharding.place(H.empty_docs(spark), "doc_id", shards, 101).count() == 0


# -- queries ---------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{H.SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, H.SF)
    assert H.rows_of(df) == H.in_order(con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall())


CONTRACT = {
    "op11_source_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op12_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op13_phrase_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op1_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op2_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op3_suffix_array_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op4_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op5_benchmark_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op6_chat_formatting": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op7_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op8_simhash_near_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op9_url_filters": "page_id bigint, host string, path string, rule string, verdict string",
    "op10_sharding": "doc_id bigint, slot int, shard string",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_columns(spark, name):
    assert set(CONTRACT) == set(queries.QUERIES)
    kinds = dict(queries.QUERIES[name](spark, "/root/testdata/sf0.001").dtypes)
    for c in CONTRACT[name].split(", "):
        column, kind = c.split(" ")
        assert kinds[column] == kind


def test_pipeline(spark):
    """Each stage against brute force on its own input; columns stay."""
    import corpus_pipeline as P
    from tidemark.llm import quality, suffix
    from tidemark.session import materialize

    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{H.SF}/benchmark.parquet").collect()]
    columns = docs.columns
    read = lambda d: {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    before = read(docs)
    for name, stage in P.STAGES[:4]:
        given = docs
        docs, _ = materialize(stage(spark, given, H.SF), "stage")
        assert docs.columns == columns
        after = read(docs)
        if name == "quality rules":
            assert set(after) == {r.doc_id for r in quality.judge(given).where("kept").collect()}
        elif name == "simhash near-dedup":
            ids = sorted(before)
            assert set(after) == set(H.clusters([H.fingerprint(before[i]) for i in ids], ids))
        elif name == "suffix-array dedup":
            keyed = {(r.id, r.key): (r.text or "").encode() for r in suffix._keyed(given).collect()}
            want = H.removals(sorted(keyed.items()), 100)
            for (i, k), (n, removed, spans, _) in want.items():
                assert removed or after[i] == before[i]
                assert not removed or i not in after or n - removed - 6 * spans <= len(after[i].encode()) <= n - removed
        else:
            assert set(after) == {r[0] for r in H.contamination(before.items(), bench) if not r[5]}
            assert all(after[i] == before[i] for i in after)
        before = after
    last = P.STAGES[4][1](spark, docs, H.SF)
    assert {r.doc_id: r.decoded_sha256 for r in last.collect()} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in before.items()}


def test_pipeline_stages_on_edges(spark):
    import corpus_pipeline as P

    for make in (H.edge_docs, H.empty_docs):
        for name, stage in P.STAGES:
            docs = make(spark)
            out = stage(spark, docs, H.SF)
            assert out.count() <= docs.count()
            if name != P.STAGES[-1][0]:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
