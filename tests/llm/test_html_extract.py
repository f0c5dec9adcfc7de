import html
import re

from pyspark.sql import functions as F

from pennant.llm import html_extract as X
from pennant.llm.common import table


def plain(source):
    """Blocks of the one article of a page, for pages without nested blocks."""
    m = re.search(r"<article>(.*?)(</article>|$)", source, re.DOTALL)
    blocks = re.split(r"</?(?:p|h1)[^>]*>", m[1]) if m else []
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b)))).strip() for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_pages(spark, sf):
    pages = table(spark, sf, "pages")
    source = {r.page_id: r.html for r in pages.collect()}
    got = X.extract(pages).collect()
    assert len(got) == len(source)
    assert all(r.text == plain(source[r.page_id]) and r.n_chars == len(r.text) for r in got)


def test_template_without_article(spark):
    """Hosts whose pages have no article: the slot that holds the text is found."""
    page = "<html><body><div class='top'>{0}<ul class='menu'><li>Home</ul></div><div class='x9'><p>{1} first</p><p>{1} second</p></div><div class='foot'>f{0}</div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i, f"text {i} " * 20)) for i in range(12)]
    got = {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = ("text 3 " * 20).strip()
    assert got[3] == f"{text} first\n\n{text} second"


def test_parts_that_go():
    source = (
        '<body><div class="menu"><a>x</a></div><div class="content"><h2>T &amp; U</h2><p>a<br>b <i>c</i><p>d\n e<div class="comments"><p>bad</div><form>f<p>g</form></div>'
        '<aside>z</aside><div id="cookie-notice">n</div><script>if (a < b) "</p>"</script><footer>q</footer>'
    )
    assert X.Page(source).text(None) == "T & U\n\na b c\n\nd e"


def test_edges(spark):
    rows = [(1, None, None), (2, "http://a/", "plain text"), (2, "http://a/", "plain text"), (None, "http://b", "<p>x</p><"), (3, "", "<!-- x"), (4, "q", "<script>1"), (5, "http://c", "<p>" + "y " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("slot", F.lit(2))
    got = sorted(((r.page_id, r.text[:20], r.n_chars) for r in X.extract(df).collect()), key=repr)
    want = [(1, "", 0), (2, "plain text", 10), (2, "plain text", 10), (None, "x\n\n<", 4), (3, "", 0), (4, "", 0), (5, "y " * 10, 99_999)]
    assert got == sorted(want, key=repr)
    assert X.extract(df.limit(0)).count() == 0


def test_template_text_in_the_slot(spark):
    """Text that a host's template has inside the slot goes; text of some pages' own stays, as does a host's only article."""
    page = "<html><body><article><h1>Title {0}</h1><p>Read our offers.</p>{1}<p>Text {0} of its own.</p></article></body></html>"
    parts = ["<div><p>Notice of the host.</p></div>" if i < 8 else "<p>Filler.</p>" for i in range(12)]
    rows = [(i, f"http://h.example/{i}", page.format(i, part + ("<p>Introduction</p>" if i % 4 else ""))) for i, part in enumerate(parts)]
    rows += [(100 + i, f"http://one.example/{i}", page.format(7, "")) for i in range(6)]
    got = {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4] == "Title 4\n\nText 4 of its own."
    assert got[5] == "Title 5\n\nIntroduction\n\nText 5 of its own."
    assert got[9] == "Title 9\n\nFiller.\n\nIntroduction\n\nText 9 of its own."
    assert all(got[100 + i] == "Title 7\n\nRead our offers.\n\nText 7 of its own." for i in range(6))


def test_parts_of_an_article_that_stay():
    source = (
        '<body><div id="cookie-notice">n</div><article><h1 id="legal">T</h1><section id="discussion"><p>a</p></section><section id="related-work"><p class="notice">b</p></section>'
        '<div class="social promotion"><p>c</p></div><div class="market-share">d</div><figure><svg><text>e</text></svg><figcaption>f</figcaption></figure><p>g <math><mi>x</mi></math> <noscript>h</noscript></p>'
        '<div class="comments-list"><p>bad</p></div><nav>bad</nav></article><noscript>bad</noscript>'
    )
    assert X.Page(source).text(None) == "T\n\na\n\nb\n\nc\n\nd\n\ne\n\nf\n\ng x h"
    assert X.Page('<div class="paper"><section id="discussion"><p>a</p></section><h2 id="related">b</h2></div>').text(None) == "a\n\nb"


def test_stray_quotes():
    assert X.Page('<a href="x"">one</a><p>two three</p><p class="y">four</p>').text(None) == "one\n\ntwo three\n\nfour"
    assert X.Page("<p title=it's>one</p><p title=\"open>two</p><p>three > 2</p>").text(None) == "one\n\ntwo\n\nthree > 2"
    assert X.Page('<p title="a > b" class=\'c"d\'>one</p><p').text(None) == "one"


def of_host(spark, page, n=8, url="http://h.example/{0}", values=lambda i: {}):
    rows = [(i, url.format(i), page.format(i, f"body {i} " * 30, **values(i))) for i in range(n)]
    return {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_headings_leads_and_lists_beside_the_body(spark):
    """Without an article the slot is where own text stands beside own text; names alone take nothing out."""
    page = (
        "<html><body><div class='bar'><ul><li>Home</li><li>News</li><li>About us</li><li>Visits: {0}</li></ul></div><div class='wrap'><h1>Title {0}</h1><div class='lead'><p>Lead {0}</p></div>"
        "<div class='text'><p>{1}</p><p>More of {0}</p><h2>Part {0}</h2><ul class='share'><li>Share {0} of it</li><li>rest {0}</li></ul></div></div><div class='imprint'>All rights of the host</div></body></html>"
    )
    got = of_host(spark, page)
    assert got[3] == "\n\n".join(["Title 3", "Lead 3", ("body 3 " * 30).strip(), "More of 3", "Part 3", "Share 3 of it", "rest 3"])


def test_one_paragraph_without_article(spark):
    page = "<html><body><div class='links'><a>Home</a> <a>About us</a></div><div class='x'><h1>Title {0}</h1><p>{1}</p><p class='share-note'>Note {0}</p><section class='related-work'><p>Work {0}</p></section></div></body></html>"
    assert of_host(spark, page)[5] == "\n\n".join(["Title 5", ("body 5 " * 30).strip(), "Note 5", "Work 5"])


def test_an_article_keeps_its_header_and_odd_names(spark):
    page = (
        "<html><body><header><h2>Site {0}</h2></header><article><header><h1>Title {0}</h1></header><p>{1}</p><div class='ad-hoc'><p>Ad hoc {0}</p></div><div class='comment-worthy'><p>Worthy {0}</p></div>"
        "<div class='ad-slot'><p>Buy {0}</p></div><div class='comments'><p>First! {0}</p></div></article></body></html>"
    )
    assert of_host(spark, page)[2] == "\n\n".join(["Title 2", ("body 2 " * 30).strip(), "Ad hoc 2", "Worthy 2"])


def test_classes_take_the_template_out(spark, monkeypatch):
    """An independent reading of made hosts: own texts of a page are those that no other page of its host has. Without classes the template's texts would stay."""
    parts = ["<div class='a'><p>Always here</p></div>", "<div class='b'>Menu <a>one</a></div>", "<div class='c'><h1>T{0}</h1><p>{1}</p><ul><li>L{0}</li></ul></div>", "<div class='d'><p>Same below</p></div>"]
    for order in ((0, 1, 2, 3), (2, 3, 0, 1), (1, 2, 0, 3)):
        for frame in ("<html><body>{}</body></html>", "<html><body><div class='all'>{}</div></body></html>", "<html><body><article>{}</article></body></html>"):
            page = frame.replace("{}", "".join(parts[k] for k in order))
            assert of_host(spark, page, 6)[4] == "\n\n".join(["T4", ("body 4 " * 30).strip(), "L4"])
    monkeypatch.setattr(X, "SUPPORT", 2.0)
    assert "Always here" in of_host(spark, page, 6)[4]
