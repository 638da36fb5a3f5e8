import html
import re

import pytest

from tallyloft.llm import html_text
from tallyloft.llm.html_text import extract, lines_of, main_text

CASES = [
    (None, ""), ("", ""), ("plain", "plain"), ("   \n ", ""), ("<p></p>", ""),
    ("<article><h1>T &amp; U</h1><p>a&nbsp;<b>b</b>c<br>d\n\te</p><p>x</article>", "T & U\n\na bc d e\n\nx"),
    ("<nav><li>m</nav><article>one<div class='ad'>buy</div>two</article><footer>f", "one\n\ntwo"),
    ("<article><p>a<script>if (a<b) {x='</p>'}</script>b</p><style>p{}</style><!-- <p>no</p> -->c</article>", "ab\n\nc"),
    ("<article><p>a &lt;p&gt; b</p><p>1 < 2</p></article>", "a <p> b\n\n1 < 2"),
    ("<main><p>a</p><form><label>name</label><input><button>ok</button></form><p>b</p><section id=comments><article><p>nice</p></article></section></main>", "a\n\nb"),
    ("<header><h1>Site</h1></header><article>a</article><aside>s</aside>", "a"),
    ("<div class='cookie-notice'>We use</div><article>a<div role='alert'>n</div></article>", "a"),
    ("<article><p>open <i>tags<p>next", "open tags\n\nnext"),
    ("<article><p title='a > b \"c'>x</p></article>", "x"),
    ("<article>a</article><div class=sidebar><div>b</div></div><article>c</article>", "a\n\nc"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"),
    ("<ARTICLE><P>A</P></ARTICLE>", "A"), ("<article>a<script>open", "a"), ("<article>a<!-- open", "a"),
    ("<article><p>&eacute;&#233;&#xe9; &bogus; &amp;amp;</p></article>", "ééé &bogus; &amp;"),
    ("<article><p><a href=x>only a link</a></p></article>", "only a link"),
    ("<div class='page has-sidebar'><article>a<div id=cookieNotice>n</div><div class='x side-bar'>s</div></article></div>", "a"),
    ("<article>a<div class='reader-comments'><p>c</p></div><div class=READER-COMMENT>d</div>b</article>", "a\n\nb"),
    ("<article><p>repeated</p><p>repeated</p></article>", "repeated\n\nrepeated"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_cases(page, text):
    assert main_text(page) == text


def test_surge_and_dive_without_a_marked_article():
    long = "A sentence of the article that is long enough to count. " * 3
    page = ("<div><a href=1>Home</a> <a href=2>News</a></div><div><a href=3>More</a></div><div><a href=4>More</a></div><div><a href=5>More</a></div>"
            f"<div><h2>Head</h2><p>{long}</p><p>Short.</p><p>{long}</p></div><div><a href=6>Next</a></div><div><a href=6>Last</a></div>")
    assert main_text(page) == "\n\n".join(["Head", long.strip(), "Short.", long.strip()])


def test_very_long_pages_stay_whole_and_linear():
    page = "<article>" + "".join(f"<p>line {i}</p>" for i in range(40_000)) + "<" * 20_000 + "</article>"
    text = main_text(page)
    assert text.startswith("line 0\n\nline 1\n\n") and "line 39999" in text


def test_pages_against_their_paragraphs(spark):
    """The pages of the test data mark their article; its paragraphs can be cut out by hand."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in pages.select("html", extract(pages["html"]).alias("text")).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?\w+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(filter(None, blocks))


def test_nulls_and_lines(spark):
    pages = spark.createDataFrame([(1, None), (1, None), (None, "<p>x")], "page_id long, html string")
    assert sorted(r.text for r in pages.select(extract(pages["html"]).alias("text")).collect()) == ["", "", "x"]
    assert pages.limit(0).select(extract(pages["html"])).count() == 0
    assert lines_of("<p>a<p>b")[0] == [("a", 1), ("b", 1)]


LONG = "A sentence of the article that is long enough to count. " * 3


@pytest.mark.parametrize("page, text", [
    # An unmarked page keeps its title, byline and date.
    (f"<nav><a href=1>Home</a></nav><h1>Title</h1><p>By A. Writer</p><p>1 May</p><p>{LONG}</p><p>{LONG}</p>", ["Title", "By A. Writer", "1 May", LONG, LONG]),
    # A short end behind an advert of several lines.
    (f"<div><p>{LONG}</p><div class=ad><p>Buy</p><p>this</p><p>now</p><p>!</p></div><p>The end.</p></div>", [LONG, "The end."]),
    (f"<article><p>{LONG}</p><div class=ad><p>Buy</p><p>this</p><p>now</p><p>!</p></div><p>The end.</p></article>", [LONG, "The end."]),
    # Custom elements, and elements left open.
    (f"<article><title-card>Card</title-card><p>{LONG}</p><svg-icon></svg-icon><p>b</p></article>", ["Card", LONG, "b"]),
    (f"<article><p>{LONG}</p><select><option>x<p>b</p></article>", [LONG, "x", "b"]),
    (f"<article><p>a <math><mi>x</mi></math> b</p><svg><title>no</title></svg><p>{LONG}</p></article>", ["a x b", LONG]),
    # Words of a slug are no names of parts; headings and the article's own header stay.
    (f"<article><p class=market-share>m</p><section id=discussion>d</section><h2 id=related-work>r</h2><p>{LONG}</p></article>", ["m", "d", "r", LONG]),
    (f"<article><header><h1>Head</h1><nav>n</nav></header><p>{LONG}</p><footer>f</footer></article>", ["Head", LONG]),
    (f"<div class=market-share><p>{LONG}</p></div><div class=site-footer-legal>c</div><div id=related-posts>r</div>", [LONG]),
    # Several articles, long and short.
    (f"<article><p>{LONG}</p></article><div>between</div><article>short</article>", [LONG, "short"]),
    # The sums decide: a marked teaser loses to a text that is far longer.
    (f"<article>Read more</article><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>", [LONG] * 3),
])
def test_probed_pages(page, text):
    assert main_text(page) == "\n\n".join(t.strip() for t in text)


def test_without_sums_the_result_is_another(monkeypatch):
    page = f"<article>Read more</article><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    with_sums = main_text(page)
    monkeypatch.setattr(html_text, "region", lambda lines, marked: [i for i, x in enumerate(lines) if x.length and x.inside == marked])
    assert main_text(page) == "Read more" != with_sums
