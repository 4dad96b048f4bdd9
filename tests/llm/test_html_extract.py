import html
import re

import pytest

from ledgerlark.llm.html_extract import Page, extract, op10_html_extract


def simple(source):
    """The article of pages as the test tables have them: nothing but inline `b` inside blocks."""
    inner = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", source, re.S)[1])
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    want = sorted((r.page_id, r.url, simple(r.html), len(simple(r.html))) for r in spark.read.parquet(f"{d}/pages.parquet").collect())
    assert sorted(map(tuple, op10_html_extract(spark, d).collect())) == want


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("just  text &amp; more", "just text & more"), ("<p>a<b>b</b>c<p>d", "abc d"), ("<html><body><nav>menu</nav>x<footer>f</footer></body>", "x"),
    ("<article><h1>T</h1><p>one<br>two &#233;&eacute;&#x41; &lt;b&gt;</p><aside>s</aside><form>f<input></form></article><div>out</div>", "T one two ééA <b>"),
    ("<main><p>m</main>", "m"), ("<article><p>a</p><div class='comments'><p>c</p></div><div id=\"cookie-notice\">n</div><div class=adBanner>z</div><section role='navigation'>q</section></article>", "a"),
    ("<article><header><h1>Head</h1></header><p>x</article>", "Head x"), ("<body><header>site</header><div>x</div>", "x"), ("<article><div class='article-header'>T</div><div class='page-header'>S</div>x</article>", "T x"),
    ("<article>a<!-- <p>no</p> -->b<script>if (a<b) '</p>'</script><style>p{}</style><noscript>n</noscript></article>", "ab"), ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a b c d e"),
    ("<article>short</article><article>the longer one</article>", "short the longer one"), ("<article>story<article class='comment'>c</article></article><article class=comments>d</article>", "story"),
    ("<main>a long story around it, far longer than the box<article>box</article></main>", "a long story around it, far longer than the box box"), ("<main>x<article>the article is most of it</article></main>", "the article is most of it"),
    ("<article><h2 class='section-header'>H</h2><p class='share-price'>P</p><p id='related-work'>R</p><div class='search-results-discussion'>D</div><div class='comments box'>C</div></article>", "H P R D"),
    ("<body><div><a href=/a>one</a> <a href=/b>two</a> <a href=/c>three</a></div><p>text with <a href=/d>a link</a></p></body>", "text with a link"),
    ("<article><ul><li><a href=/a>one</a><li><a href=/b>two</a><li><a href=/c>three</a></ul></article>", "one two three"), ("<div hidden>h</div><div style='display: none'>i</div><p>x", "x"), ("<article>a < b and <3</article>", "a < b and <3"), ("<article>cut <a href='x", "cut"),
    *((f"<article><p>a</p>{box}<p>z</p></article>", "a z") for box in (
        '<p class="advert">buy</p>', '<ul><li class="advertisement">buy</ul>', '<div id="disqus_thread"><p>first!</div>', '<section id="reader-comments"><p>hm</section>', '<div class="user-comments">u</div>', '<div class="post-comments">u</div>',
        '<div class="related-posts"><p>more</div>', '<div class="social-share-buttons">tell</div>', '<div class="newsletter-signup-form">mail</div>', '<p id="sponsored_box">s</p>',
        '<section id="related"><ul><li><a href=/x>one more</a><li><a href=/y>and one</a></ul></section>', '<div class="share">Share: <a href=/t>this page here</a></div>', '<div class="cookies">We use them. <button>Fine</button></div>')),
    *((f"<article><p>a</p>{box}<p>z</p></article>", f"a {kept} z") for box, kept in (
        ('<div class="cookies"><h3>Cookies</h3><p>Mix flour and <a href=/b>butter</a> well.</p></div>', "Cookies Mix flour and butter well."), ('<section id="related">Work by others came first.</section>', "Work by others came first."),
        ('<section class="sharing"><p>Sharing a memory is hard.</p></section>', "Sharing a memory is hard."), ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", "so x=1 holds"), ('<p class="advertising-history">p</p>', "p"))),
    ('<body><div class="related">else</div><p>x</p>', "x"), ("<article><p>a</b>b</p></article>", "ab"), ("<article>x" + "<div>" * 3000 + "deep", "x deep"), ("<article>&nbsp; a &nbsp;b</article>", "a b"), ("<script>never closed <p>x", ""),
])
def test_pages(source, text):
    assert Page(source).text() == text


def test_templates_go_and_shared_sentences_stay(spark):
    share = '<div class="box"><span>Read more at our site</span><ul><li>one</ul></div>'
    rows = [(i, f"http://a.org/{i}", f"<body><div><b>Welcome</b></div><article><p>Same line.</p><p>own {i}</p>{share}</article>") for i in range(30)]
    rows += [(100 + i, f"http://b.org/{i}", f"<body><div><b>Welcome</b></div><div><p>Same line.</p><p>own {i}</p></div>") for i in range(30)]
    rows += [(200, "http://c.org/", f"<body><article><p>x</p>{share}</article>"), (201, None, None), (202, "http://c.org/", "<p>" + "w " * 200_000), (202, "http://c.org/", "<p>" + "w " * 200_000)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    for limit in (1_000_000, 0):
        got = {r.page_id: r for r in extract(pages, most_templates=limit).collect()}
        assert got[3].text == "Same line. own 3" and got[103].text == "own 3"  # inside an article a line may recur, outside it is the site's
        assert got[200].text == "x Read more at our site one" and got[201].text == "" and got[201].n_chars == 0 and got[202].n_chars == 399_999
    assert extract(pages.limit(0)).count() == 0 and extract(pages).count() == len(rows)


def test_templates_of_part_of_a_large_host_and_of_small_hosts(spark):
    box = "<div><span>Site notice</span></div>"
    page = lambda i, more: f"<article><p>own {i}</p>{more}</article>"
    rows = [(i, f"http://large.org/{i}", page(i, box if i < 12 else "<div>rare</div>" if i < 21 else "")) for i in range(200)]
    rows += [(1000 + i, f"http://small.org/{i}", page(i, box)) for i in range(3)] + [(1010 + i, f"http://half.org/{i}", page(i, box if i == 0 else "")) for i in range(3)]
    rows += [(1020, "http://one.org/", page(0, box))] + [(1100 + i, f"http://copies.org/{i}", page(0, box)) for i in range(30)] + [(1130 + i, f"http://copies.org/other{i}", page(i, "")) for i in range(1, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (1_000_000, 0):
        got = {r.page_id: r.text for r in extract(pages, most_templates=limit).collect()}
        assert [got[i] for i in (0, 11, 12, 20, 199)] == ["own 0", "own 11", "own 12 rare", "own 20 rare", "own 199"]  # on 12 and on 9 pages of 200
        assert [got[1000 + i] for i in range(3)] == ["own 0", "own 1", "own 2"]
        assert got[1010] == got[1020] == got[1100] == got[1129] == "own 0 Site notice"  # on one page, or on copies of one


def test_boilerplate_without_telling_names_goes_by_templates_alone(spark):
    """No tag, class or id says what is boilerplate; only recurrence does."""
    def page(i):
        top = "<div class='x1'><span>The Daily</span> <span>Since 1890</span></div><h1>All the news</h1>"
        end = "<table><tr><td>Imprint and terms</td></tr></table><p>Printed in town.</p>"
        return f"<html><body>{top}<div class='x2'><h2>Story {i}</h2><p>Words of story {i}.</p><div><p>More of {i}.</p></div></div>{end}</body></html>"

    rows = [(i, f"http://daily.example/{i}", page(i)) for i in range(10)] + [(50, "http://lone.example/", page(50))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (1_000_000, 0):
        got = {r.page_id: r.text for r in extract(pages, most_templates=limit).collect()}
        assert all(got[i] == f"Story {i} Words of story {i}. More of {i}." for i in range(10))
        assert got[50].startswith("The Daily Since 1890 All the news Story 50") and got[50].endswith("Printed in town.")
    off = {r.page_id: r.text for r in extract(pages, templates=False).collect()}
    assert off[3].startswith("The Daily") and off[3].endswith("Printed in town.")


def test_a_template_of_a_hot_host_and_columns_that_clash(spark):
    box = "<section><span>Same box</span></section>"
    rows = [(i, "http://hot.example/p", f"<article><p>own {i % 40}</p>{box}</article>", "old", "x") for i in range(120)] + [(900, "http://hot.example/q", "", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, site string")
    for limit in (1_000_000, 0):
        got = extract(pages, most_templates=limit).collect()
        assert len(got) == 121 and {r.text for r in got if r.page_id < 900} == {f"own {i}" for i in range(40)} and {r.site for r in got} == {"x", None}
