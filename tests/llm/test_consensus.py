"""op9: article text against hand-made pages and the test data's template."""

import html
import random
import re
import time

import pytest

from meterflow.llm import consensus, markup
from tests.llm import tables

PAGE = """<html><body class="nav-open"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
<div class="main"><aside>side</aside><div class="post-12"><h2>Title &amp; more</h2><p>Para one<p>Para <b>two</b> x<br>y
<ul><li>a<li>b</ul><form>Q<input></form><script>var a="</p>"</script><!-- c --><div class="comments"><p>reader</p></div>
<pre>code  here</pre>&eacute;nd</div></div><footer>f</footer>"""


def test_article_without_furniture():
    assert consensus.vote(PAGE)[0] == "html/body.nav-open/div.main/div.post-#"
    assert consensus.extract(PAGE, None) == "Title & more\n\nPara one\n\nPara two x y\n\na\n\nb\n\ncode here\n\nénd"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a &lt;b&gt; &#233;&nbsp;c</p>", "a <b> é c"),
        ("<article><p>cut off <b>here", "cut off here"),
        ("<article><p>x</p></div></div><p>y</p></article>", "x\n\ny"),
        ("<article><p>a<script>if (1<2) '</article>'</script>b</p></article>", "ab"),
        ("<p title='a>b'>c</p>", "c"),
        ("<nav>only a menu</nav>", ""),
        ("<article><header><h1>T</h1></header><p>b</p><footer>f</footer></article>", "T\n\nb"),
        ("<main><p>a</p><div class='share-buttons'>s</div><section id=comments><p>r</p></section></main>", "a"),
        ("<div class='ad'>x</div><div class='adult-education'><p>kept</p></div>", "kept"),
        ("<div class='has-sidebar page'><p>a</p><div class='sidebar-left'>s</div></div>", "a"),
        ("<article><div class='post-header'><h1>T</h1></div><p>b</p></article>", "T\n\nb"),
        ("<div class='site-header'><h1>T</h1></div><div><p>b c</p></div>", "b c"),
        ("<article><div class='a'><p>long part of it</p></div><div class='b'><p>rest</p></div></article>", "long part of it\n\nrest"),
        ("<article><p>a text</p><article class='comment'><p>reader</p></article></article>", "a text"),
        ("<table><tr><td>one<td>two</table>", "one\n\ntwo"),
        # inline elements: an advert goes, the rest of its line stays
        ("<p>one <span class='ad'>buy</span> two three</p>", "one two three"),
        ("<p>one <span class='ad'>buy <span>now</span></span> two</p><p>three</p>", "one two\n\nthree"),
        ("<p>one <span class='ads'>never closed</p><p>two</p>", "one\n\ntwo"),
        ("<article>Search <span class='search-term'>spark</span> is quick</article>", "Search spark is quick"),
        ("<p>a <ins id='related'>b</ins> c</span></p>", "a b c"),
        # broken attributes
        ("<article><p title=don't>hello</p></article>", "hello"),
        ("<article><p title=don't>hello</p><p>it's <b title='x'>there</b></p></article>", "hello\n\nit's there"),
        ("<article><p>don't <a title='x>y' href=z>go</a> on</p></article>", "don't go on"),
        ("<p a=>x</p><p =y>z</p>", "x\n\nz"),
        # a head that nothing ends
        ("<html><head><meta charset=utf-8><p>text", "text"),
        ("<head><title>t</title><div><b>a</b> b</div>", "a b"),
        ("<head><script>x</script><body><p>text</p>", "text"),
    ],
)
def test_small_pages(source, text):
    assert consensus.extract(source, None) == text


@pytest.mark.parametrize("name", ["discussion", "related-work", "search-algorithms", "legal-status", "navigation", "form", "comments-on-x"])
def test_sections_of_an_article_stay(name):
    page = f"<article><p>a</p><section id='{name}'><h2 id='{name}'>b</h2><p id='{name}'>c</p></section></article>"
    assert consensus.extract(page, None) == "a\n\nb\n\nc"
    assert consensus.extract("<article><p>a</p><div id='share'>s</div><section id='comments'>r</section></article>", None) == "a"
    assert consensus.extract("<article><p>a <math><mi>x</mi></math> b</p></article>", None) == "a x b"


def test_template_of_the_test_data(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in consensus.query(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == rows.count()
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [re.sub("<[^>]*>", "", re.sub("<br>", " ", p)) for p in re.split("</?(?:p|h1)>", inner)]
        parts = [re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts]
        want = "\n\n".join(p for p in parts if p)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_the_host_outvotes_a_page(spark):
    good = "<body><div class='story'><p>" + "article words here " * 20 + "</p></div><div class='extra-1'><p>{}</p></div></body>"
    rows = [(i, "http://Host.com/a", good.format("short")) for i in range(5)]
    rows += [(9, "http://host.com/b", good.format("long filler text " * 60)), (10, "http://other.com/", good.format("long filler text " * 60))]
    rows += [(11, None, "<p>no host</p>"), (12, "http://host.com/c", None), (13, "http://host.com/d", "<td>odd one</td>")]
    got = {r.page_id: r.text for r in consensus.main_text(tables.pages(spark, rows)).collect()}
    assert got[9].startswith("article words") and "filler" not in got[9]
    assert "filler" in got[10] and got[11] == "no host" and got[12] == "" and got[13] == "odd one"
    winners = {r.host: r for r in consensus.winning_paths(tables.pages(spark, rows)).collect()}
    assert winners["host.com"].path == "html/body/div.story" and winners["host.com"].votes == 5


def test_columns_and_empty_table(spark):
    rows = tables.pages(spark, [(1, "http://a/", PAGE), (1, "http://a/", PAGE)]).withColumnRenamed("extra", "text")
    got = consensus.main_text(rows)
    assert sorted(got.columns) == sorted([*rows.columns, "n_chars"]) and got.count() == 2
    assert consensus.main_text(tables.no_rows(spark, tables.PAGES)).count() == 0


def test_deep_and_long_pages():
    deep = "<div>" * 50_000 + "words " * 50 + "</div>" * 50_000
    assert consensus.extract(deep, None) == ("words " * 50).strip()
    assert consensus.extract("<div>" * 20_000 + "a" + "</section>" * 20_000, None) == "a"
    assert len(markup.parse("<p>a " * 20_000).blocks) == 20_000


def test_broken_tags_cost_no_search():
    began = time.process_time()
    for piece in ["<p>don't <a title='x>", '<p class="', "<a href='x' b=\"", "<!--", "<script ", "<span class=ad>x"]:
        markup.parse(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 30


def plain_vote(pages):
    """The vote by its definition: per host the path of most pages, then of most score, then the smallest."""
    tally = {}
    for host, source in pages:
        path, score = consensus.vote(source)
        if path is not None:
            votes, total = tally.setdefault(host, {}).get(path, (0, 0.0))
            tally[host][path] = (votes + 1, total + score)
    return {host: min(found, key=lambda p: (-found[p][0], -found[p][1], p)) for host, found in tally.items()}


def test_votes_against_a_plain_count(spark):
    rng = random.Random(9)
    shapes = ["<div class='post-%d'><p>%s</p></div>", "<main><p>%d %s</p></main>", "<section class=b><p>%d %s</p></section><nav>x</nav>"]
    rows = []
    for i in range(120):
        host = rng.choice(["a.org", "b.org", "c.org"])
        shape = rng.choice(shapes[: 1 + "abc".index(host[0])])
        rows.append((i, f"http://{host}/{i}", rng.choice([shape % (i, "word " * rng.randint(1, 40)), "", None])))
    got = {r.host: r.path for r in consensus.winning_paths(tables.pages(spark, rows)).collect()}
    assert got == plain_vote([(u.split("/")[2], h) for _, u, h in rows])
