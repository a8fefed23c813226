"""Periodic runs, ranked search and HTML extraction: brute force, odd inputs, and the hot paths."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tabkit.llm import dom, extract, layouts, lexical, ngramjoin, packing, periodic
from tabkit.llm.queries import QUERIES
from tests.llm.support import documents, linked, odd_documents, words


@pytest.fixture(scope="module")
def odd(spark):
    return odd_documents(spark).cache()


# n-gram join: entries of equal members

def test_entries_of_equal_members_are_one(spark):
    members = {1: [5, 6, 7], 2: [5, 6, 7], 3: [5, 6], 4: [5, 6, 7], 5: [9]}
    rows = [(s, -1, m, 10) for s, ms in members.items() for m in ms]
    rows += [(s, -1, 6, 10) for s, ms in members.items() if 6 in ms]  # a copy of 6 in another task
    rows += [(s, salt, m, 10) for s in (8, 9) for salt, m in ((0, 5), (1, 6), (1, 7))]  # dealt over salts
    got = ngramjoin.shared_entries(spark.createDataFrame(rows, "sig bigint, salt int, node bigint, n int")).collect()
    held = {}
    for r in got:
        held.setdefault(r.sig, []).append((r.node, r.low))
    assert {s: sorted(x) for s, x in held.items()} == {
        1: [(5, 5), (6, 5), (7, 5)], 3: [(5, 5), (6, 5)], 8: [(5, 5), (6, 6), (7, 6)], 9: [(5, 5), (6, 6), (7, 6)]}


def test_pairs_meet_in_one_entry(spark):
    """However many entries two nodes share, they are one row of the pair join, and every two that share one meet."""
    rng = random.Random(4)
    held = {node: set(rng.sample(range(60), rng.choice([3, 20, 32]))) for node in range(40)}
    rows = [(s, node, 100, node // 2) for node, sigs in held.items() for s in sigs]
    entries = spark.createDataFrame(rows, "sig bigint, node bigint, n int, label bigint")
    nodes = spark.createDataFrame([(node, *[0] * len(ngramjoin.MAP)) for node in held], ", ".join(["node bigint", *[f"{w} bigint" for w in ngramjoin.MAP]]))
    wide = entries.join(ngramjoin._carried(entries, nodes), "node")
    expected = sorted((a, b) for a in held for b in held if a < b and a // 2 != b // 2 and held[a] & held[b])
    assert {r.node: r.firsts for r in wide.collect()} == {node: sorted(s)[:ngramjoin.FIRSTS] for node, s in held.items()}
    assert sorted(map(tuple, ngramjoin.meetings(wide, wide, 85).collect())) == expected
    # none of the least entries in common: they meet in every entry they share, but they meet
    k = ngramjoin.FIRSTS
    held = {1: [*range(k), 900, 901], 2: [*range(100, 100 + k), 900, 901]}
    rows = [(s, node, 100, node) for node, sigs in held.items() for s in sigs]
    entries = spark.createDataFrame(rows, "sig bigint, node bigint, n int, label bigint")
    wide = entries.join(ngramjoin._carried(entries, nodes), "node")
    assert {tuple(r) for r in ngramjoin.meetings(wide, wide, 85).collect()} == {(1, 2)}


def test_rows_of_the_pair_join(spark, monkeypatch):
    """Unlike classes that share many entries: the rounds make a row a pair in all, and the components are those of all pairs."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for k in range(30):  # a part of each is its own, so that few reach the similarity
        t = base + [f"o{k}x{i}" for i in range(rng.choice([10, 35, 40]))]
        texts.append(" ".join(t))
    real, made = ngramjoin.meetings, []
    monkeypatch.setattr(ngramjoin, "meetings", lambda *a: made.append(real(*a).cache()) or made[-1])
    counted = []
    verified = ngramjoin.verified
    monkeypatch.setattr(ngramjoin, "verified", lambda *a: made and counted.append([tuple(r) for r in made[-1].collect()]) or verified(*a))
    got = {r.doc_id: r.component_id for r in ngramjoin.link_documents(documents(spark, texts), 4, 85, rare=0, hot=4096, rounds=4).collect()}
    assert got == linked(dict(enumerate(texts, 1)), 4, 85)
    rows = [pair for call in counted for pair in call]
    assert rows and len(rows) == len(set(rows)) <= 30 * 29 / 2


# packing: ids by merges and by the library

def test_packing_ids_of_random_texts(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(1)
    letters = "abcdehilnorst' !?.,0129éßΣİ中ªº²¼ÀÿŁ\U0001F600#*\n\x1c\x85\xa0\u0301\u01c4"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(1000)] + ["don't 'tis ''s 're x's", "ab " * 300_000]
    monkeypatch.setattr(packing, "CACHE_PIECES", 2000)  # both generations are in use
    ids = packing.WordIds(path)
    for t in texts:
        assert np.frombuffer(ids.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


# periodic runs

def runs_by_hand(w):
    """(start, length, period) of every run, by trying all periods at all places."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # the same stretch with a shorter period came first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def order(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_texts(rng):
    texts = [None, "", " ", "a", "a a a a a", "a a a a a a", "a b " * 9, "x " * 300]
    for _ in range(60):
        w = []
        while len(w) < rng.randrange(1, 160):
            unit = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
            w += unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit))]
        texts.append("\n ".join(w))
    return texts


def test_runs_by_brute_force(spark):
    texts = periodic_texts(random.Random(11))
    expected = [runs_by_hand(words(t)) for t in texts]
    assert sum(map(len, expected)) > 100
    # whole texts at once, small tiles inside one task, and tiles dealt over tasks
    for tile, long_bytes in ((1 << 16, 1 << 22), (8, 1 << 22), (16, 10)):
        got = {r.doc_id: r for r in periodic.collapse_runs(documents(spark, texts), tile=tile, long_bytes=long_bytes).collect()}
        for i, (t, runs) in enumerate(zip(texts, expected), 1):
            assert [(r.start, r.length, r.period) for r in got[i].runs] == order(runs)
            assert got[i].collapsed == collapsed(words(t), runs)


def test_runs_of_large_periods_cross_tiles():
    rng = np.random.default_rng(5)
    for n, q in ((5000, 1), (5000, 700), (5000, 1250), (4097, 64)):
        unit = rng.integers(0, 50, q)
        w = np.concatenate([rng.integers(50, 99, 300), np.resize(unit, n), rng.integers(50, 99, 77)]).astype(np.int32)
        for tile in (64, 1024):
            parts = []
            for first, last, start, end in periodic.tiles(len(w), tile):
                lo, hi = periodic.margins(last, start, end, len(w))
                parts += periodic.solve(w[lo:hi], first, last, start, end, lo, len(w)).tolist()
            own = sorted((a, b) for p, a, b in parts if p == q)
            reach = own[0][0]
            for a, b in own:
                assert a <= reach or a == own[0][0]
                reach = max(reach, b)
            assert (own[0][0], reach) == (300, 300 + n - q)


def test_runs_odd(odd):
    got = periodic.run_digest(periodic.collapse_runs(odd)).toPandas()
    assert len(got) == odd.count()
    null = got[got.doc_id == 1]
    assert (null.n_runs == 0).all() and null.start.isna().all() and null.exponent_milli.isna().all()
    assert (null.collapsed_sha256 == hashlib.sha256(b"").hexdigest()).all() and (null.runs_sha256 == hashlib.sha256(b"").hexdigest()).all()
    assert periodic.collapse_runs(odd.limit(0)).count() == 0


def test_periodic_query(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for i, text in docs:
        w = words(text)
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
        if n > 3000:  # the plain version is quadratic
            continue
        runs = runs_by_hand(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (got[i].n_runs, got[i].start, got[i].length, got[i].period) == (len(runs), *best)
        assert got[i].exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert got[i].runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in order(runs)).encode()).hexdigest()
        assert got[i].collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()


# ranked search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or "")]


def ranked_by_hand(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("block", [3, 7, 10**6])
def test_ranked_search_by_brute_force(spark, monkeypatch, block):
    rng = random.Random(block)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) for _ in range(150)]
    texts += texts[:20] + [None, "", "...", "Ünï-Code É w1", "w1"]
    items = [(j, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 15)))) for j in range(25)] + [(90, None), (91, "!!"), (92, "ünï code É")]
    monkeypatch.setattr(lexical, "BLOCK_DOCUMENTS", block)
    docs = list(enumerate(texts))
    got = lexical.ranked_search(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), k=5)
    assert sorted(map(tuple, got.collect())) == sorted(ranked_by_hand(docs, items, 5))


def test_accumulators_are_limited():
    """Once a rare term has filled the best, a frequent one only updates what is there."""
    places, parts = np.array([0, 1, 0, 1, 2, 3, 4], np.int32), np.array([900, 800, 10, 10, 10, 10, 10], np.int64)
    starts, weight, most = {0: (0, 2), 1: (2, 7)}, np.array([1000, 5]), np.array([900, 10])
    at, score = lexical.best_of_block(np.array([0, 1]), weight, starts, places, parts, most, 5, 2)
    assert at.tolist() == [0, 1] and score.tolist() == [900_050, 800_050]
    # a bound equal to the k-th score may still tie, so accumulators are made
    at, _ = lexical.best_of_block(np.array([0, 1]), np.array([1, 80]), starts, places, parts, most, 5, 2)
    assert at.tolist() == [0, 1]


def test_ranked_search_in_item_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"t{i % 5} common") for i in range(20)], "doc_id bigint, text string")
    items = spark.createDataFrame([(j, f"t{j}") for j in range(4)], "item_id bigint, text string")
    whole = sorted(map(tuple, lexical.ranked_search(docs, items, k=3).collect()))
    monkeypatch.setattr(lexical, "ITEM_BYTES", 1)
    blocks = list(lexical.item_blocks(items, "item_id", "text", 1))
    assert len(blocks) == 4 and sorted(map(tuple, lexical.ranked_search(docs, items, k=3).collect())) == whole


def test_ranked_search_odd(spark, odd):
    items = spark.createDataFrame([(1, "words ünïcode a", 5), (None, "text here", 6), (2, None, 7)], "item_id bigint, text string, score int")
    got = lexical.ranked_search(odd, items).toPandas()
    assert set(got.columns) == {"item_id", "rank", "doc_id", "score"} and got.item_id.isna().sum() == 1
    assert got[got.item_id.isna()].doc_id.isna().all()
    assert lexical.ranked_search(odd.limit(0), items).count() == 0 and lexical.ranked_search(odd, items.limit(0)).count() == 0


# HTML extraction

@pytest.fixture(scope="module")
def forest(spark, sf):
    return extract.fit_extractor(spark.read.parquet(f"{sf}/pages.parquet"))


def text_of(page, forest):
    nodes = dom.parse(page)
    return dom.decode(nodes, forest.score(dom.features(nodes, extract.TOKEN_NUMBER)))


def test_extraction_of_whole_articles(spark, sf):
    """The pages of the table mark their article by a tag; by it alone the expected text can be read."""
    got = {r.page_id: r for r in QUERIES["op12_html_extraction"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        article = re.search("<article>(.*?)(?:</article>|$)", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        expected = "\n".join(b for b in blocks if b)
        assert (got[page.page_id].text, got[page.page_id].url, got[page.page_id].n_chars) == (expected, page.url, len(expected))


def test_extraction_on_held_out_layouts(spark, sf, forest):
    """Layouts of other seeds and other texts than the fit has seen."""
    rng = random.Random(99)
    blocks = [t for p in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(120).collect() for n in dom.parse(p.html) for _, t in n.blocks]
    expected_n = lost = extra = 0
    for _ in range(300):
        page = layouts.Layout(rng, rng.sample(blocks, 30)).page()
        expected = Counter(t for n in dom.parse(page, labelled=True) if n.label == 1 and not n.hidden for _, t in n.blocks)
        found = Counter(text_of(page, forest).split("\n"))
        both = sum((expected & found).values())
        expected_n, lost, extra = expected_n + sum(expected.values()), lost + sum(expected.values()) - both, extra + sum(found.values()) - both
    assert lost < 0.04 * expected_n and extra < 0.05 * expected_n


def test_extraction_leaves_out_what_is_no_article(forest):
    words = "One sentence of the article that says something longer than a link does. And another one follows it here."
    page = f"""<body><header class="site-header"><a href="/">Home</a> Tagline of the site</header><nav><a href="/a">A</a> <a href="/b">B</a></nav>
    <div class="cookie-notice"><p>We use cookies on this site, please accept them all.</p><button>OK</button></div>
    <main><article><h1>Title &amp; more</h1><p>{words}<p>{words} <b>bold&nbsp;x</b> &lt;tag&gt; {words}
    <div class="ad">Buy this now.</div><ul><li>{words}</li></ul></article>
    <section class="comments"><h3>Comments</h3><p>{words}</p></section></main>
    <aside class="sidebar"><ul><li><a href="/c">Related one</a></li><li><a href="/d">Related two</a></li></ul></aside>
    <form class="newsletter"><p>Subscribe to our letter</p><input></form><footer>&copy; site</footer><script>var x = "<p>no</p>"</script></body>"""
    assert text_of(page, forest).split("\n") == ["Title & more", words, f"{words} bold x <tag> {words}", words]


def test_decoding_is_consistent():
    """Nothing below a node that is out is kept, whatever its own score; the choice has the greatest sum."""
    rng = random.Random(3)
    for _ in range(200):
        nodes = [dom.Node("body", None, (), False, None)]
        for i in range(1, 7):
            up = rng.choice(nodes)
            n = dom.Node("div", up, (), False, None)
            up.children.append(n)
            n.blocks = [(i, str(i))]
            nodes.append(n)
        nodes = in_page_order(nodes[0])
        for k, n in enumerate(nodes[1:]):
            n.blocks = [(k, str(k))]
        score = [rng.uniform(-3.9, 3.9) for _ in nodes]
        kept = {int(x) + 1 for x in dom.decode(nodes, np.array(score)).split("\n") if x}
        assert kept == best_choice(nodes, score)


def in_page_order(node):
    return [node, *[m for c in node.children for m in in_page_order(c)]]


def best_choice(nodes, score):
    """By trying every consistent choice of states."""
    place = {id(n): i for i, n in enumerate(nodes)}
    best, kept = -math.inf, None
    states = [["above"]]
    for n in nodes[1:]:
        up = place[id(n.parent)]
        states = [[*s, t] for s in states for t in {"above": ("above", "in", "out"), "in": ("in", "out"), "out": ("out",)}[s[up]]]
    for s in states:
        total = sum({"above": 0.0, "in": score[i], "out": -score[i]}[t] for i, t in enumerate(s) if i)
        if total > best:
            best, kept = total, {i for i, t in enumerate(s) if t == "in"}
    return kept


def test_parsing_of_broken_pages():
    texts = lambda page: [t for _, t in sorted(b for n in dom.parse(page) for b in n.blocks)]
    assert texts("<p>a<p>b<b>c</p>d</b>e") == ["a", "bc", "de"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    assert texts("1 < 2 &amp; 3 &gt 2 <!-- <p>no</p> --> x<br>y <a href='>'>z</a>") == ["1 < 2 & 3 > 2 x y z"]
    assert texts("<script>if (a < b) '</p>'</script><style>x</style><title>t</title>a &am") == ["a &am"]
    assert texts("<p>a <!-- never ends") == ["a"] and texts("</div></p>") == [] and texts("<script>open") == []
    assert texts("<div>" * 3000 + "deep") == ["deep"]


def test_extraction_odd(spark, forest):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "plain text"), (2, "u", "plain text"), (3, None, "<article><p>" + "Long text here. " * 60000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "page_id AS text", "1 AS n_chars", "2 AS x")
    got = extract.extract_text(pages, forest).toPandas()
    assert list(got.columns) == ["page_id", "url", "text", "n_chars"] and len(got) == 5
    assert (got[got.page_id == 1].text == "").all() and (got[got.page_id == 3].n_chars == 16 * 60000 - 1).all()
    assert extract.extract_text(pages.limit(0), forest).count() == 0
    assert extract.fit_extractor(pages.limit(0)) is None and (extract.extract_text(pages, None).toPandas().text == "").all()


@pytest.mark.parametrize("many", [3, 63, 64, 65, 300])
def test_siblings_alike_are_counted_at_any_width(many):
    nodes = dom.parse("<div>" + "<p>word</p>" * many + "<ul><li>item</li></ul></div>")
    alike = dom.features(nodes, {})[:, dom.NUMBERS.index("alike")]
    got = {(n.tag, int(x)) for n, x in zip(nodes, alike) if n.parent and n.parent.tag == "div"}
    assert got == {("p", many), ("ul", 1)}
