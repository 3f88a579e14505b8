import html
import re
import time

import numpy as np
from pyspark.sql import functions as F

from duetlog.llm import maintext, queries
from duetlog.llm.common import read
from .conftest import SF01


def gold(page):
    """The article of this table's one template, by plain patterns."""
    m = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    body = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", m.group(1))) if m else ""
    return " ".join(html.unescape(body).split())


def test_whole_table(spark):
    got = queries.QUERIES["op10_main_text"](spark, SF01)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: r for r in got.collect()}
    pages = read(spark, SF01, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == gold(p.html) and got[p.page_id].n_chars == len(gold(p.html))


def test_held_out_pages_with_other_parts(spark):
    pages = [r.html for r in read(spark, SF01, "pages").orderBy("page_id").collect()]
    model = maintext.train(pages[:150])
    sentences = [t[:200] for s in pages[150:200] for t in maintext.parse(s).text if t and len(t) > 20]
    right = 0
    for n, s in enumerate(pages[150:]):
        varied = maintext._varied(s, 99 + n, sentences)
        parsed = maintext.parse(varied)
        want = maintext.written(parsed, maintext.labels(parsed) == 1)
        right += maintext.main_texts([re.sub(r' data-y="\d"', "", varied)], model)[0] == want
    assert right >= 0.95 * len(pages[150:])


def test_no_kept_node_under_a_dropped_one():
    rng = np.random.default_rng(0)
    page = maintext.Page()
    for _ in range(200):
        page.add("div", int(rng.integers(0, len(page.tag))))
    for _ in range(20):
        odds = rng.normal(0, 2, len(page.tag))
        kept = maintext.keep(page, odds)
        assert all(kept[page.parent[i]] or not kept[i] for i in range(1, len(kept)))
        best = odds[kept][1:].sum()

        def top(i):      # the best gain below i, by recursion
            return odds[i] + sum(max(0.0, top(j)) for j in range(1, len(odds)) if page.parent[j] == i)
        assert abs(best - sum(max(0.0, top(j)) for j in range(1, len(odds)) if page.parent[j] == 0)) < 1e-9


def test_broken_markup_and_references():
    def text(s):
        p = maintext.parse(s)
        return maintext.written(p, np.ones(len(p.tag), dtype=bool))
    assert text("a &amp; b &lt;c&gt; &#233;&nbsp;x &copy") == "a & b <c> é x ©"
    assert text("<p>one<p>two<ul><li>x<li>y</ul>z") == "one two x y z"
    assert text("<script>var t='</p>';</script>q<style>p{}</style> <!-- no -->r") == "q r"
    assert text("wo<b>rd</b>s and a<br>break 1 < 2 <p class='x") == "words and a break 1 < 2"
    assert text("<div title='a > b' class=\"x>y\">in</div></div></p>out") == "in out"
    t0 = time.time()
    assert text("<div>" * 30000 + "deep") == "deep"
    assert text("<" * 100000).count("<") == 100000
    text("<a " + "\"'" * 50000)
    assert time.time() - t0 < 10


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, "u", ""), (2, "u", ""), (None, None, "<p>no id, but a text</p>"), (3, "v", "plain"),
            (4, "w", "<nav>menu</nav>"), (5, "x", "<p>" + "long words " * 50000)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r.text for r in maintext.main_text(pages).collect()}
    assert got[1] == got[2] == got[4] == "" and got[3] == "plain" and got[None] == "no id, but a text"
    assert len(got[5]) == 50000 * 11 - 1
    assert maintext.main_text(pages).count() == len(rows) and maintext.main_text(pages.limit(0)).count() == 0
    assert maintext.main_text(pages).where(F.col("n_chars") != F.length("text")).count() == 0


def test_raw_elements_without_end_tag():
    def text(s):
        p = maintext.parse(s)
        return maintext.written(p, np.ones(len(p.tag), dtype=bool))
    assert text("<html><head><title>t</title><body><article><p>one</p></article>") == "one"
    assert text("<head><meta charset=x><title>t<script>a</script><p>one") == "one"
    assert text("<head><title>t</title><div>one</div></head>two") == "one two"
    assert text("<head><title>t</title>plain") == "plain"
    assert text("<head><noscript><link></noscript><style>x</style><body>one") == "one"
    assert text("<head><noscript><body><p>one") == "one"
    for name in "noscript template svg math select canvas object video audio iframe".split():
        assert text(f"<p>a</p><{name}>x<p>one</p><p>two</p>") == "a one two", name
        assert text(f"<div><{name}>x</div><p>one</p><{name}>y</{name}><p>two</p>") == "one two", name
        assert text(f"<p>a <{name}><div>x</div><p>y</p></{name}> b</p>") == "a b", name
        assert text(f"<{name}><{name}><div>x</div></{name}>y</{name}>one") == "one", name
    assert text("<select><option>x<option>y<p>one") == "one"
    t0 = time.time()
    text("<svg>" * 30000 + "<svg><div></svg>" * 30000)
    assert time.time() - t0 < 10


def test_rare_self_labelled_pages_are_found(spark, monkeypatch):
    ids = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"))
    order = [r.page_id for r in ids.orderBy(F.xxhash64("page_id", "url")).collect()]
    body = "<body><nav><a>menu</a></nav><{0}><p>Some words, and more of them in a sentence {1}.</p></{0}></body>"
    rows = [(i, "u", body.format("article" if n >= 380 else "div", n)) for n, i in enumerate(order)]
    seen = []
    train, schema = maintext.train, "page_id long, url string, html string"
    monkeypatch.setattr(maintext, "train", lambda pages: seen.append(pages) or train(pages[:20]))
    maintext.fit(spark.createDataFrame(rows, schema))
    assert len(seen[0]) == 20 and all("<article>" in p for p in seen[0])
    model = maintext.fit(spark.createDataFrame(rows[:380], schema))            # learned from made pages
    assert maintext.main_texts([body.format("div", 7)], model) == ["Some words, and more of them in a sentence 7."]


def _text(s):
    p = maintext.parse(s)
    return maintext.written(p, np.ones(len(p.tag), dtype=bool))


def test_quotes_open_values_only_behind_an_equals_sign():
    assert _text("<p>one</p><p title=don't>It's here now.</p><p>two's</p>") == "one It's here now. two's"
    assert _text("""<p data-x='a>b' title=say"hi">x</p>y""") == "x y"
    assert _text("""<p ' " class=z>x</p>'y'""") == "x 'y'"
    assert _text("""<p title = "a > b">x<p title= 'c > d'>y""") == "x y"
    assert maintext.parse('<div title="class=ad" class=post id=a-b>x</div>').tokens[1] == ("post", "a-b")
    assert maintext.parse('<html class=ad><body class="menu-open">x').tokens[1:3] == [(), ()]
    t0 = time.time()
    _text("<a ='" * 30000), _text("<a =" + "\"'=" * 30000), _text("<p x=" * 50000)
    assert time.time() - t0 < 10


STORY = ("<h1>A title</h1><p>The council met on Monday, and it talked for three hours about the bridge. Nobody left early.</p>"
         "<p>The bridge was built in 1901; it has carried trams, carts and, of late, many bicycles over the river.</p>"
         "<p>A vote is due in May. Until then, the old railings stay, said the mayor, who crosses it every day.</p>"
         "<p>Work would start in autumn, when the river is low, and last for about two years.</p>")
MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li></ul></nav>'
FOOT = "<footer>&copy; 2024 The Paper. All rights reserved.</footer>"
KEPT = [f'<body>{MENU}<article class="{w}">{STORY}</article>{FOOT}</body>' for w in (
    "post", "page", "entry featured", "post share-post", "single has-sidebar", "post comment-open", "content-alert", "no-comments", "x12",
    "story with-newsletter", "sidebar", "menu-open main")]
KEPT += [f'<body class="has-sidebar menu-open">{MENU}<article>{STORY}</article>{FOOT}</body>',
         f'<html class="no-js modal-open"><body class="single comment-open ad-free">{MENU}<main>{STORY}</main>{FOOT}</body></html>',
         f'<body>{MENU}<div class="wrap has-sidebar"><div class="col7">{STORY}</div><div class="sidebar"><p>Most read today</p></div></div>{FOOT}',
         f'<body>{MENU}<div id="content">{STORY}</div>{FOOT}', f"<body>{MENU}<div>{STORY}</div>{FOOT}", f"<body>{MENU}{STORY}{FOOT}", STORY]
DROPPED = ['<div class="c2"><p>Subscribe to our letter</p></div>', '<div class="cookie-bar"><p>We use cookies to serve you.</p></div>',
           '<div class="notice">The site is closed on Sunday night.</div>', "<aside><p>Read our new series on bridges.</p></aside>",
           '<section id="comments"><div class="comment"><p>I liked that bridge a lot.</p></div><div class="comment"><p>Me too, really.</p></div></section>',
           '<form><label>Search the site</label><input name=q></form>', '<div class="advert">Buy one, get one, only today!</div>',
           '<header><div>The Paper, since 1880</div></header>']


def test_pages_with_all_kinds_of_names(spark):
    """Kept nodes may be called anything; pieces around them go."""
    model = maintext.train([r.html for r in read(spark, SF01, "pages").collect()])
    want = _text(STORY)
    got = maintext.main_texts(KEPT, model)
    assert [t == want for t in got] == [True] * len(KEPT), [(k, t[:80]) for k, t in zip(KEPT, got) if t != want]
    pages = [f"<body>{MENU}{d}<article>{STORY}</article>{FOOT}" for d in DROPPED]
    pages += [f'<body>{MENU}<div class="post">{STORY}</div>{d}{FOOT}' for d in DROPPED]
    got = maintext.main_texts(pages, model)
    assert [t == want for t in got] == [True] * len(pages), [(k[:120], t[:80]) for k, t in zip(pages, got) if t != want]


def test_decoding_equals_enumeration():
    """Every labelling without a kept node under a dropped one, tried."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        page = maintext.Page()
        for _ in range(9):
            page.add("div", int(rng.integers(0, len(page.tag))))
        odds = rng.normal(0, 2, len(page.tag))
        best = max(((sum(odds[i] for i in range(1, 10) if m >> i & 1)) for m in range(0, 1 << 10, 2)
                    if all(not m >> i & 1 or page.parent[i] == 0 or m >> page.parent[i] & 1 for i in range(1, 10))))
        kept = maintext.keep(page, odds)
        assert abs(odds[kept][1:].sum() - best) < 1e-9 if kept[1:].any() else best == 0
