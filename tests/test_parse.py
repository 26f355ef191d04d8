import time

import pytest
from pyspark.sql import functions as F

from docpipe import schemas
from docpipe.operators import metadata, parse

PAGE = """<!DOCTYPE html><html><HEAD><title>T &amp; &quot;U&quot;</title>
<style>p{}</style><script>var t="</p>";</script></HEAD><body>
<nav><a href="/x">no</a></nav><!-- <p>no</p> --><div class="ad">no</div>
<header>also no</header>
<h1 class="c">Head&amp;lt;</h1><p>one<br/>two <b>bold<p>  three&nbsp;</p>
<P id='4'></P><script>"<p>no</p>"</script><p>&copy; &middot; end
<a HREF="/y">link</a></article>tail<footer><p>no</p></footer></body></html>"""

ELEMENTS = [
    ("0", "text", "also no"),
    ("1", "title", "Head&lt;"),
    ("2", "text", "one\ntwo bold"),
    ("3", "text", "three\u00a0"),
    ("4", "text", "© · end\nlink"),
    ("5", "text", "tail"),
]

# Pages as they come, and what is to be read from them: (type, content).
SHAPES = {
    "<h1>A</h1><h2 id=x>B</h2>c<H6>D</H6>e": [
        ("title", "A"), ("heading", "B"), ("text", "c"), ("heading", "D"), ("text", "e"),
    ],
    "<ul><li>one<li>two</li></ul>after": [("text", "one"), ("text", "two"), ("text", "after")],
    "<table><tr><th>k</th><td>v</td></tr><tr><td>k2<td>v2</table>": [
        ("text", "k"), ("text", "v"), ("text", "k2"), ("text", "v2"),
    ],
    "<pre>a\n  b</pre><div>bare <i>div</i></div>": [("text", "a\n  b"), ("text", "bare div")],
    "<title>no</title>loose": [("text", "loose")],
    "plain text": [("text", "plain text")],
    "<p>it&#8217;s &ndash; caf&eacute; &#x1F600; &nosuch; &#0; a&b AT&T; &amp;lt; &notin;</p>": [
        ("text", "it\u2019s \u2013 caf\u00e9 \U0001f600 &nosuch; \ufffd a&b AT&T; &lt; \u2209"),
    ],
    "<section><blockquote>q</blockquote><dl><dt>t<dd>d</dl></section>": [
        ("text", "q"), ("text", "t"), ("text", "d"),
    ],
}


def one(spark, html, expr):
    return spark.createDataFrame([(html,)], "html string").select(expr).first()[0]


def test_elements(spark):
    got = one(spark, PAGE, parse.html_elements(F.col("html")))
    assert [tuple(e) for e in got] == ELEMENTS


def test_shapes(spark):
    for html, want in SHAPES.items():
        got = one(spark, html, parse.html_elements(F.col("html")))
        assert [(e.type, e.content) for e in got] == want, html


def test_links(spark):
    page = """<a href='/x'>1</a><a data-href="no" class="c" HREF = "/y?a=1&amp;b=2">2</a><a href=/z>3</a>
    <a\nhref="">4</a><a title="href='q'">5</a>"""
    row = metadata.extract(spark.createDataFrame([(page,)], "html string")).first()
    assert row.links == ["/x", "/y?a=1&b=2", "/z", ""]


def test_no_elements(spark):
    for html in ("", "<p> \n </p>", "<!-- <p>x</p> -->", "<nav>x</nav><footer>y</footer>"):
        assert one(spark, html, parse.html_elements(F.col("html"))) == []
    assert one(spark, None, parse.html_elements(F.col("html"))) is None


LONG = 30_000


@pytest.mark.parametrize(
    ("page", "sizes"),
    [
        ("<p>a" + "<!-- " * LONG, [1]),
        ("<p>a" + "<script " * LONG + "<p>b", [1]),
        ("<p>a<nav>n</nav>" + "<nav " * LONG + "<footer>f</footer><p>b", [5 * LONG, 1]),
        ("<p>a" + "< " * LONG + "<p>b", [2 * LONG, 1]),
        ("<p>" + "x\n \n" * LONG + "y", [4 * LONG + 1]),
        ("<p>x" + " " * LONG * 10 + "y" + "<br" * LONG, [2 + 13 * LONG]),
        ('<p>a' + '<div class="ad">' * LONG, [1]),
        ("<title>" * LONG + "<p>b", [1]),
        ('<p>a<script>var t="</p>";</script>b<head>no</head>', [2]),
    ],
)
def test_long_broken_pages_take_linear_time(spark, page, sizes):
    row = metadata.extract(spark.createDataFrame([(page,)], "html string")).select(
        F.transform(parse.html_elements(F.col("html")), lambda e: F.length(e["content"])), "links"
    )
    start = time.monotonic()
    assert row.first()[0] == sizes
    assert time.monotonic() - start < 20


def test_mark_in_page_is_harmless(spark):
    got = one(spark, "<p>a\x02pb</p>", parse.html_elements(F.col("html")))
    assert [e.content for e in got] == ["apb"]


def test_markdown(spark):
    got = one(spark, PAGE, parse.to_markdown(parse.html_elements(F.col("html"))))
    assert got == "also no\n\n# Head&lt;\n\none\ntwo bold\n\nthree\u00a0\n\n© · end\nlink\n\ntail"


def test_bad_bytes_do_not_stop_the_job(spark):
    files = spark.createDataFrame(
        [("/a", bytearray(b"<p>ok \xff</p>")), ("/b", None)], "path string, content binary"
    )
    rows = {
        r.path: r.parsed_content for r in parse.to_parsed_docs(files).collect()
    }
    assert "ok �" in rows["/a"]


def test_parsed_content_reads_back(spark):
    files = spark.createDataFrame([("/a", bytearray(PAGE.encode()))], "path string, content binary")
    read = parse.to_parsed_docs(files).select(
        F.inline(F.from_json("parsed_content", schemas.PARSED_CONTENT)["document"]["elements"])
    )
    assert [tuple(r) for r in read.collect()] == ELEMENTS


def test_metadata(spark):
    row = metadata.extract(spark.createDataFrame([(PAGE,)], "html string")).first()
    assert row.title == 'T & "U"'
    assert row.summary == "also no"
    assert row.links == ["/x", "/y"]
    empty = metadata.extract(spark.createDataFrame([("",)], "html string")).first()
    assert (empty.title, empty.summary, empty.links) == (None, "", [])
