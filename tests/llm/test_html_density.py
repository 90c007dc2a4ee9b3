"""Main text of pages: made pages of known text, a plain count of densities, odd and long pages."""

import random
import time

import pytest

from brightmere.llm import html_density, queries
from brightmere.llm.html_density import main_text

SF = "/root/testdata/sf0.001"
LONG = [
    "The river rose for three days before the first boats left the old harbour at dawn.",
    "Nobody in the village had seen such a flood, and nobody knew what the spring would bring.",
    "By evening the bridge was gone, the road to the north was closed and the mill stood in water.",
    "It took the council nine weeks to raise the money for the new dam above the quarry.",
]
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>World</a></li><li><a href='/c'>Sport</a></li></ul>"
CHATTER = " ".join(f"I read this and think that point {i} is very much worth a long answer." for i in range(30))


def paragraphs(lines):
    return "".join(f"<p>{x}</p>" for x in lines)


PAGES = {
    "article": f"<body><nav>{MENU}</nav><article><h1>Flood</h1>{paragraphs(LONG)}</article><footer>(c) us</footer>",
    "ids": f"<div id='top-nav'>{MENU}</div><div id=sidebar><p>{CHATTER}</p></div><div class='post-body'><h1>Flood</h1>"
    f"{paragraphs(LONG)}</div><div class=comments><p>{CHATTER}</p></div><div class='footerLinks footer'>{MENU}</div>",
    "bare divisions": f"<div>{MENU}</div><div><h1>Flood</h1>{paragraphs(LONG)}</div><div>{MENU}</div>",
    "heading apart": f"<div>{MENU}</div><div><h1>Flood</h1></div><div>{paragraphs(LONG)}</div><div>{MENU}</div>",
    "short article, long comments": f"<main><article><h1>Flood</h1>{paragraphs(LONG)}<section id='comments'><p>{CHATTER}</p>"
    f"</section></article></main>",
    "comments as articles": f"<article><h1>Flood</h1>{paragraphs(LONG)}<article><p>{CHATTER}</p></article></article>",
    "notices": f"<div class='cookie-notice'><p>{CHATTER}</p></div><div role=alert>{CHATTER}</div><form><p>{CHATTER}</p></form>"
    f"<main><h1>Flood</h1><div class='ad-slot'>{CHATTER}</div>{paragraphs(LONG[:2])}<aside><p>{CHATTER}</p></aside>"
    f"{paragraphs(LONG[2:])}<div hidden>x</div><div style='display: none'>{CHATTER}</div></main>",
    "upper case, no ends": "<BODY><NAV>" + MENU + "</NAV><ARTICLE><H1>Flood</H1>" + "".join(f"<P>{x}" for x in LONG) + "</ARTICLE>",
    "scripts": f"<script>if (a < b) document.write('<p>no</p>')</script><style>p > b {{}}</style><article><h1>Flood</h1>"
    f"<!-- <p>no</p> > -->{paragraphs(LONG)}<noscript>no</noscript><template><p>no</p></template></article>",
    "one form around": f"<form id=all><div id=menu>{MENU}</div><div id=text><h1>Flood</h1>{paragraphs(LONG)}</div></form>",
    "sections": f"<main><section><h1>Flood</h1>{paragraphs(LONG[:2])}</section><section>{paragraphs(LONG[2:])}</section></main>",
    "misnested": f"<article><h1><b>Flood</h1></b>{''.join(f'<p><i>{x}</p></i>' for x in LONG)}</div></article><p>",
    "header with names": f"<header>Daily News {MENU}</header><div class='story'><header class='story-header'><h1>Flood</h1>"
    f"</header>{paragraphs(LONG)}</div>",
    "layout classes": f"<body class='has-sidebar comments-open'><div class='page with-sidebar'><article class='post comments-open'>"
    f"<h1>Flood</h1>{paragraphs(LONG)}</article></div>",
    "teasers": f"<article><h1>Flood</h1>{paragraphs(LONG)}</article><article><h2>Other</h2><p>{LONG[0]}</p></article>",
    "quoted signs": f"<article title='a > b'><h1 data-x=\"</h1>\">Flood</h1>{paragraphs(LONG)}</article>",
    "list of links": f"<article><h1>Flood</h1>{paragraphs(LONG)}<div>{MENU}</div></article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_article_and_nothing_else(name):
    assert main_text(PAGES[name]) == "\n".join(["Flood", *LONG])


def test_blocks_white_space_and_references():
    page = (
        "<article><h1> A &amp; B </h1><p>one\n two<br>three <b>bo</b>ld &eacute;&#233;&#xE9; &lt;p&gt; &nbsp; &copy</p>"
        "<ul><li>first<li>second <ul><li>inner</ul></ul><table><tr><td>a<td>b<tr><td>c</table>"
        "<pre>x\n   y</pre>tail <span>text</span><blockquote>quoted <a href='/q'>link</a></blockquote>1 < 2</article>"
    )
    assert main_text(page).split("\n") == [
        "A & B", "one two three bold ééé <p> ©", "first", "second", "inner", "a", "b", "c", "x y",
        "tail text", "quoted link", "1 < 2",
    ]


def test_densities():
    """Two divisions by hand: one of text, one of links."""
    page = html_density.Page("<div>" + "<p>abcdefghij klmno</p>" * 6 + "</div><div><a href='/'>abcd</a> <a href='/'>efgh</a></div>")
    assert page.tags == ["body", "div", *["p"] * 6, "div"]
    assert [page.parents[i] for i in (1, 2, 8)] == [0, 1, 0]
    assert page.runs[-1] == (8, "abcd efgh", 8, 2, 2)
    assert page.select() == set(range(1, 8))


def test_odd_pages():
    for page in (None, "", "   ", "<", "<>", "</", "<!", "<!--", "<p", "<script>", "<title>x</title>", "<a href='", "\x00"):
        assert main_text(page) in ("", "<", "<>", "\x00")
    assert main_text("just text") == "just text"
    assert main_text("<p>kept</p><p title='never ends>kept too") == "kept\nkept too"
    assert main_text("<p>kept</p><p title='never ends") == "kept"
    assert main_text(f"<nav>{MENU}</nav>") == ""


def test_any_bytes_give_a_text():
    random.seed(4)
    parts = ["<p>", "</p>", "<div class='ad'>", "</div>", "<a href='", "'>", "<table><tr><td>", "</table>", "text ", "&amp", "<!--",
             "-->", "<li>", "<b>", "</b>", "</a>", "<h1>", "<script>", "</script>", "<article>", "</article>", "\"", "<br/>", "<nav>"]
    for _ in range(2000):
        page = "".join(random.choice(parts) for _ in range(random.randint(1, 60)))
        text = main_text(page)
        assert text == "\n".join(" ".join(line.split()) for line in text.split("\n") if line.strip())


@pytest.mark.parametrize("part", ["<div>", "<p>text", "<b>", "<a href='x", "<article><p>text", "<", "<li>a", "</p>", "<table><td>x", "<!--"])
def test_long_pages_take_time_in_proportion(part):
    def took(n):
        begin = time.perf_counter()
        main_text(part * n)
        return time.perf_counter() - begin

    took(100)
    assert took(40_000) < 20 * took(4_000) + 0.5


def test_extract(spark):
    rows = [(1, "u", PAGES["article"], "t", 1), (1, "u", PAGES["article"], "t", 1), (2, None, None, "t", 1), (None, "v", "", "", 0),
            (3, "w", "<p>" + "word " * 200_000, None, None)]
    found = html_density.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int"))
    assert found.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    got = sorted(map(tuple, found.collect()), key=str)
    flood = "\n".join(["Flood", *LONG])
    long = ("word " * 200_000).strip()
    assert got == sorted(
        [(1, "u", flood, len(flood))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", long, len(long))], key=str
    )
    assert html_density.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_every_page_of_the_table(spark):
    """What lies between the article's tags, read line by line, is the main text."""
    import re
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.QUERIES["op11_text_density"](spark, SF).collect()
    assert len(found) == len(pages)
    for row in found:
        inner = re.search("<article>(.*)</article>", pages[row["page_id"]], re.S)[1]
        lines = [" ".join(unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert row["text"] == "\n".join(x for x in lines if x) and row["n_chars"] == len(row["text"])
