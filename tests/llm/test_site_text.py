"""Main text of pages: what stays, what goes, and what a site's repeats decide."""

import re
from collections import Counter
from html import unescape

import pytest

from toolgauge.llm import site_text

SCHEMA = "page_id long, url string, html string, text string, hash long, place string, host string, n_chars string"


def extracted(spark, pages, **settings):
    frame = spark.createDataFrame([(*page, "t", 3, "p", "h", None) for page in pages], SCHEMA)
    return site_text.extract(frame.repartition(3), **settings).collect()


def texts(spark, *pages, url="http://h.example/1", **settings):
    found = extracted(spark, [(i, url, page) for i, page in enumerate(pages)], **settings)
    return [row["text"] for row in sorted(found, key=lambda row: row["page_id"])]


CASES = {
    "plain": ("<article><h1>A &amp; B</h1><p>one\n two<p>three<br>four</article>", "A & B\none two\nthree four"),
    "inline": ("<article><p>a<b>b</b> <i>c</i>&lt;d&gt;&nbsp;&eacute;&#x41;&amp e</p></article>", "ab c<d> éA& e"),
    "furniture": (
        "<html><head><title>T</title><style>p{}</style><script>var x='</p><article>';</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>ok?</div>"
        "<main><article><header><h1>Title</h1></header><div class=body><p>Text</p><aside>side</aside>"
        "<div class='ad-slot-3'>buy</div><form><p>q</p></form><ul><li>i</li><li>j</ul><footer>by me</footer></div>"
        "</article><section id=comments><article><p>first!</p></article></section></main>"
        "<div id='left-sidebar'>links</div><footer>&copy; us</footer></body></html>",
        "Title\nText\ni\nj",
    ),
    "comments in article": (
        "<article><p>a</p><section class='comments'><article class='comment'><p>b</p></article></section><p>c</p></article>",
        "a\nc",
    ),
    "layout names": ("<body class='has-sidebar'><div class='with-sidebar'><article class='with-ads'><p>a</p></article></div>", "a"),
    "form around": ("<body><form id=f><article><p>a</p></article><p>b</p></form>", "a"),
    "two articles": ("<article><p>a</p></article><p>x</p><article><p>b</p></article>", "a\nb"),
    "main only": ("<p>x</p><main><p>a</p><div role=navigation>n</div></main>", "a"),
    "body only": ("<body><ul><li><a href=/>Home</a><li><a>More</a></ul><div>a</div>b<p>c</p><p hidden>d</p>", "a\nb\nc"),
    "no markup": ("just  text &amp; more", "just text & more"),
    "empty": ("", ""),
    "null": (None, ""),
    "blank": ("<article> &nbsp; </article>", ""),
    "cut off": ("<article><p>a</p><p>b <a hre", "a\nb"),
    "cut comment": ("<article><p>a</p><!-- b </article>", "a"),
    "cut script": ("<article><p>a</p><script>b</article>", "a"),
    "odd signs": ("<article><p>1 < 2 <3 & 4 </nothing> <![CDATA[x]]>5</p></article>", "1 < 2 <3 & 4 5"),
    "quotes": ("<article><p title='a > b' class=\"x\">c</p><p title=\"d>e</p></article>", "c\ne"),
    "upper case": ("<ARTICLE><P>a<SCRIPT>x</Script>b</P><NAV>n</NAV></ARTICLE>", "ab"),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl><pre>f\n g</pre></article>", "a\nb\nc\nd\ne\nf g"),
    "open inline": ("<article><p><b>a<br><p>b</p></article><footer>f</footer>", "a\nb"),
    "control": ("<article><p>a\x00b\x0bc d</p></article>", "a\x00b c d"),
}


@pytest.mark.parametrize("name", CASES)
def test_page(name):
    html, want = CASES[name]
    page = site_text.Page(html or "")
    assert "\n".join(text for text, _ in page.blocks) == want


def test_cases_through_spark(spark):
    found = extracted(spark, [(i, None, html) for i, (html, _) in enumerate(CASES.values())])
    want = Counter((i, None, text, len(text)) for i, (_, text) in enumerate(CASES.values()))
    assert Counter(map(tuple, found)) == want


def test_template_of_a_body(spark):
    """Without an article, blocks that recur on the host go, on other hosts they stay."""
    pages = [(i, "http://h.example/x", f"<body><div>Welcome <b>all</b></div><p>page {i} has a text of its own</p>") for i in range(8)]
    pages += [(100, "https://H.example:80/y", "<p>no welcome here but words</p><div>Welcome <b>all</b></div>")]
    pages += [(200, "http://other.example/x", pages[0][2])]
    found = {row["page_id"]: row["text"] for row in extracted(spark, pages)}
    assert [found[i] for i in range(8)] == [f"page {i} has a text of its own" for i in range(8)]
    assert found[100] == "no welcome here but words"
    assert found[200] == "Welcome all\npage 0 has a text of its own"
    assert "Welcome all" in extracted(spark, pages, min_pages=10)[0]["text"]


def test_copies_of_a_page_are_no_template(spark):
    """The same article under many addresses stays, with and without an article element."""
    bodies = "<div><p>one text that many copy</p></div><div>and more</div>", "<article><p>one text</p><div>box</div></article>"
    for body in bodies:
        found = texts(spark, *[f"<nav>menu {i}</nav>{body}" for i in range(20)])
        assert len(set(found)) == 1 and found[0] == "\n".join(re.findall(r">([^<]+)</(?:p|div)", body))


def test_boxes_and_prose_in_articles(spark):
    """A passage that many articles quote stays; a box that many have goes."""
    pages = [f"<article><h1>T{i}</h1><p>shared passage</p><p>own words {i}</p><div><p>Follow us</p></div></article>" for i in range(9)]
    assert texts(spark, *pages) == [f"T{i}\nshared passage\nown words {i}" for i in range(9)]


def test_counts_are_exact(spark):
    """templates() against counting by hand; one host holds nearly all rows."""
    pages = [(i, "http://hot/" if i % 5 else "http://cold/", f"<nav>{i % 3}</nav><p>{i % 40} words here</p>") for i in range(200)]
    frame = spark.createDataFrame([(*p, "t", 3, "p", "h", None) for p in pages], SCHEMA)
    found = {(r["host"], r["hash"]): r["pages"] for r in site_text.templates(site_text.parse(frame), 1).collect()}
    seen = {}
    for _, url, html in pages:
        page = site_text.Page(html)
        for one in page.hashes:
            seen.setdefault((url[7:-1], one), set()).add(page.digest)
    assert found == {key: len(digests) for key, digests in seen.items()}


def test_given_pages(spark):
    """Pages of the given tables: their article, by plain pattern matching."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {row["page_id"]: row["text"] for row in site_text.extract(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?(b|br)>", "", part)).split()) for part in re.split(r"</?(?:p|h1)>", article)]
        assert found[page["page_id"]] == "\n".join(filter(None, blocks))


def test_long_and_deep_pages(spark):
    deep = "<div>" * 30_000 + "x" + "</div>" * 30_000
    long = "<article>" + "<p>word &amp; word</p>" * 100_000 + "</article>"
    found = texts(spark, deep, long, "<" * 10_000, "<a " * 10_000)
    assert found[0] == "x" and found[1] == "\n".join(["word & word"] * 100_000)
    assert found[2] == "<" * 10_000 and found[3] == ""


def test_no_pages(spark):
    assert extracted(spark, []) == []
