"""Main texts: what a site repeats goes by entropy, what HTML names goes by name, and all of an article stays."""

import html as library
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from obsframe.llm import site_tree
from obsframe.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def texts(spark, rows, parts=3):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)
    return {r.page_id: r.text for r in site_tree.extract(pages).collect()}


def test_what_a_site_repeats_goes(spark):
    rows = [
        (k, f"http://one.example.com/{k}", f"<body><div class=a{k}><p>All rights on one.example.com</p><p>Number {k % 2}</p></div>"
         f"<div class=b><h1>Title {k}</h1><p>Story {k} goes on.</p></div><div>Read more on one.example.com</div></body>")
        for k in range(40)
    ]
    assert texts(spark, rows) == {k: f"Title {k} Story {k} goes on." for k in range(40)}


def test_few_pages_of_a_site_lean_on_other_sites(spark):
    rows = [
        (k, f"http://s{k}.example.com/", f"<body><div class=x>Welcome to s{k}.example.com, sign here</div><div class=y><p>Tale {k}, and only {k}.</p></div></body>")
        for k in range(60)
    ]
    assert texts(spark, rows) == {k: f"Tale {k}, and only {k}." for k in range(60)}


def test_copies_of_an_article_stay(spark):
    page = "<nav><a href=/>Home</a></nav><article><h1>Same</h1><p>Text that all pages share.</p></article><footer>End</footer>"
    assert set(texts(spark, [(k, "http://h/", page) for k in range(50)]).values()) == {"Same Text that all pages share."}


def test_branches_of_an_article(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>"; a<b</script></head>
    <body class="has-sidebar"><header><h2>Site</h2></header><div id="cookieNotice">We use cookies</div>
    <ul class='menu'><li>Home<li>About</ul><!-- <article>no</article> --><div>beside</div>
    <main><article class="post related"><header><h1>A &amp; B&nbsp;&lt;C&gt; &eacute;&#33;</h1></header>
    <p>One <b>two<i>three</i>\n\t four<br>five<p>six</b> 5 < 6 &amp;amp; AT&T<div class="ad">Buy</div>tail
    <table><tr><td>c1<td>c2</table><form>Name <input value=x> <select><option>o</select></form>
    <section><h2>More</h2><ul><li>l1<li>l2 <a href="/x">link</a></ul></section>
    <div class=share-buttons><p>Share</p></div><aside>side</aside><footer>by me</footer><p hidden>h</p><p style="display: none">n</p>
    </article><section id="comments"><p>First!</p></section></main><aside>Rail</aside><footer>&copy; me</footer></body></html>"""
    assert texts(spark, [(1, "http://h/", page)]) == {
        1: "A & B <C> é! One twothree four five six 5 < 6 &amp; AT&T tail c1 c2 More l1 l2 link"
    }


def test_the_tree_decides_on_what_no_name_marks_in_an_article(spark):
    rows = [
        (k, "http://h.example/", f"<nav>Menu {k}</nav><article><h1>Title {k}</h1><p>Story {k}.</p><div class=x>Read us every day</div><div class=y>Note {k}</div></article>")
        for k in range(40)
    ]
    assert texts(spark, rows) == {k: f"Title {k} Story {k}. Note {k}" for k in range(40)}
    paths = site_tree.Paths()
    without = [" ".join(site_tree.main_text(site_tree.parse(page, paths), site_tree.Tree([]))) for _, _, page in rows]
    assert without == [f"Title {k} Story {k}. Read us every day Note {k}" for k in range(40)]


def test_no_text_goes_for_what_stands_beside_it(spark):
    """Menus and adverts in an element are no reason to drop the element's own text, in an article or without any."""
    pages = [(k, "http://a.example/", f"<body><div class=menu>Menu</div>Story {k} goes on.<ul class=nav><li>Home</ul></body>") for k in range(40)]
    assert texts(spark, pages) == {k: f"Story {k} goes on." for k in range(40)}
    copies = [(k, "http://b.example/", "<nav>Home</nav><article>Text that all pages share.<div class=ad>Buy</div></article>") for k in range(50)]
    assert set(texts(spark, copies).values()) == {"Text that all pages share."}


def test_copies_of_an_article_in_boxes_stay(spark):
    """Wherever they lie: on one site, or one on each of many. What all articles of a site repeat goes all the same."""
    page = "<nav><a href=/>Home</a></nav><article><div class=body><p>Same</p><div>Text that all pages share.</div></div></article><footer>End</footer>"
    assert set(texts(spark, [(k, "http://h/", page) for k in range(60)]).values()) == {"Same Text that all pages share."}
    assert set(texts(spark, [(k, f"http://h{k}/", page) for k in range(60)]).values()) == {"Same Text that all pages share."}
    rows = [
        (k, "http://h.example/", f"<article><div class=body><p>Story {k // 2}.</p></div><div class=x>Read us every day<hr></div></article>{'<p>beside</p>' * (k % 2)}")
        for k in range(60)
    ]
    assert texts(spark, rows) == {k: f"Story {k // 2}." for k in range(60)}


def test_an_article_counts_in_full(spark):
    """Lines that some articles share, and texts between the parts of an important branch, are text of the article."""
    rows = [
        (k, "http://h.example/", f"<article><h1>Title {k}</h1><div class=by>By author {k % 4}</div><div>In short: <p>Story {k}.</p></div></article>") for k in range(40)
    ]
    assert texts(spark, rows) == {k: f"Title {k} By author {k % 4} In short: Story {k}." for k in range(40)}


def test_an_empty_article_frames_nothing(spark):
    rows = [(k, "http://h.example/", f"<nav>Menu</nav><article><div></div></article><div><p>Story {k}.</p></div>") for k in range(20)]
    assert texts(spark, rows) == {k: f"Story {k}." for k in range(20)}


def test_the_tree_holds_plain_entropies(spark):
    rows = [(k, "http://Host.example:80/x", f"<body><div><p>p{k % 3}</p>{'<p>extra</p>' * (k % 2)}</div></body>") for k in range(12)]
    rows += [(20, None, "<body><div><p>p0</p></div></body>"), (21, "http://z/", "<body><div><p>q</p></div></body>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.host: r.nodes for r in site_tree.style_tree(pages.select(site_tree.host_of("url").alias("host"), "html")).collect()}
    assert set(found) == {"host.example", "", "z"}
    seen = defaultdict(lambda: defaultdict(set))
    for k, _, page in rows[:12]:
        for node, kind, feature in site_tree.evidence(site_tree.parse(page, site_tree.Paths()), "host.example"):
            seen[node][kind, feature].add(k)
    for n in found["host.example"]:
        m = len(seen[n.node][0, 0])
        features = [len(v) for (kind, _), v in seen[n.node].items() if kind == 2]
        styles = [len(v) / m for (kind, _), v in seen[n.node].items() if kind == 1]
        assert n.pages == m == 12
        assert n.content == pytest.approx(1 - sum(math.log(c, m) for c in features) / len(features) if features else 1)
        assert n.presentation == pytest.approx(-sum(p * math.log(p, m) for p in styles))
    assert {n.all_pages for n in found["z"]} == {14} and {n.content for n in found["z"]} == {1.0}


def test_query(spark):
    found = {r.page_id: r for r in QUERIES["op11_html_text"](spark, DATA).collect()}
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    assert set(found) == {p.page_id for p in pages}
    for p in pages:
        article = re.search("<article>(.*)</article>", p.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(library.unescape(re.sub("<[^>]*>", "", part)).split()) for part in re.split("</?(?:p|h1)>", article)]
        r = found[p.page_id]
        assert (r.url, r.text, r.n_chars) == (p.url, " ".join(filter(None, parts)), len(r.text))


def test_odd_rows(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    long = "<article>" + "<p>word &amp; word</p>" * 20000 + "</article>"
    rows = [
        (1, "u", None), (2, None, ""), (3, "http://", "plain text"), (3, "http://", "plain text"), (None, "x", "<p>a</p>"), (4, "x", "<article><p>cut <a href='"),
        (5, "x", deep), (6, "x", long), (7, "x", "</div></p><<>&lt;<3 <!--> <!-- x"), (8, "x", "<p " * 3000), (9, "x", "<a '" * 3000),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit(1) for c in ("key", "host", "nodes", "node", "text")})
    out = site_tree.extract(pages)
    assert out.columns == ["page_id", "url", "text"]
    got = Counter((r.page_id, r.url, r.text) for r in out.collect())
    assert {k: n for k, n in got.items() if k[0] not in (7, 9)} == {
        (1, "u", ""): 1, (2, None, ""): 1, (3, "http://", "plain text"): 2, (None, "x", "a"): 1, (4, "x", "cut"): 1, (5, "x", "deep"): 1,
        (6, "x", " ".join(["word & word"] * 20000)): 1, (8, "x", ""): 1,
    }
    assert sum(got.values()) == len(rows) and site_tree.extract(pages.where("false")).collect() == []
