import html as references
import time

import pytest

from hourgrid.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this now.</div>
<article><h1>Title &amp; more</h1>{body}</article><aside>side text</aside>
<div id="comments"><p>A reader says so and so, at length, again and again.</p></div>
<form><label>Name</label><input></form><footer>&copy; site</footer></body></html>"""


def text_of(body):
    return html_text.main_text(PAGE.format(body=body))


@pytest.mark.parametrize(
    "body,want",
    [
        ("<p>One two.</p><p>Three.</p>", "One two.\nThree."),
        ("<p><b>One two.<br><p>Three</p>", "One two.\nThree"),
        ("<p>a\n  b\t c&nbsp;d</p>", "a b c d"),
        ("<p>x &lt;b&gt; &eacute;&#233;&#xe9; &unknown; &amp;amp;</p>", "x <b> éé\u00e9 &unknown; &amp;"),
        ("<ul><li>one<li>two</ul>tail", "one\ntwo\ntail"),
        ("<p>see <a href='x>y'>this</a> and <i>that</i></p>", "see this and that"),
        ("<p>a<script>if (1<2) { x('</p>') }</script>b</p>", "ab"),
        ("<div class='cookie-notice'>We use cookies</div><p>text</p>", "text"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<div><div>deep <span>text</span></div> after</div>", "deep text\nafter"),
        ("<p>open <b>bold <i>both</b> end</p><p>next", "open bold both end\nnext"),
    ],
)
def test_article_text(body, want):
    assert text_of(body) == f"Title & more\n{want}"


def test_pages_of_the_given_tables_give_their_article(spark):
    folder = "/root/testdata/sf0.01"
    rows = html_text.extract(spark.read.parquet(f"{folder}/pages.parquet")).collect()
    sources = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in rows:
        article = sources[r.page_id].split("<article>")[1].split("</article>")[0]
        for tag in ("<br>", "<b>", "</b>", "</p>", "</h1>"):
            article = article.replace(tag, "")
        blocks = article.replace("<h1>", "<p>").split("<p>")
        want = "\n".join(t for b in blocks if (t := " ".join(references.unescape(b).split())))
        assert r.text == want and r.n_chars == len(want)


def test_without_article_the_densest_element_wins():
    links = "".join(f"<li><a href='/{i}'>link number {i}</a></li>" for i in range(40))
    text = "<p>" + "words of a paragraph " * 30 + "</p>"
    page = f"<html><body><div><ul>{links}</ul></div><div><div>{text * 3}</div></div><div><a href=x>more</a></div></body></html>"
    got = html_text.main_text(page)
    assert got.split("\n") == [("words of a paragraph " * 30).strip()] * 3


def test_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain text"), (3, "u", "<p"), (4, "u", "<b>x"), (4, "u", "<b>x")]
    rows += [(5, "u", "<div>" * 5000 + "deep"), (6, "u", "<html><body></body></html>"), (7, "u", "<p a=\"x>y</p>z")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id bigint, url string, html string, text string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(pages).collect()]
    assert got[:3] == [(1, "u", "", 0), (2, None, "", 0), (None, "u", "plain text", 10)]
    assert got[4] == got[5] == (4, "u", "x", 1) and got[6][2] == "deep" and got[7][2] == ""
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


@pytest.mark.parametrize("source", ["<" * 20_000, "<a b='" * 5_000, "<p>" * 20_000, "<b>" * 20_000 + "</i>" * 20_000, "<script>" * 5_000, "&" * 50_000, "<!--" * 20_000, "<div><b>" * 8_000])
def test_odd_markup_takes_no_long_time(source):
    start = time.process_time()
    html_text.main_text(source)
    assert time.process_time() - start < 10


LINKS = "<div><ul>" + "".join(f"<li><a href='/{i}'>link number {i}</a></li>" for i in range(40)) + "</ul></div>"


@pytest.mark.parametrize("tag", ["div", "section", "article"])
@pytest.mark.parametrize("inner", ["{}", "<div>{}</div>"])
@pytest.mark.parametrize("around", ["", LINKS])
@pytest.mark.parametrize("start", ["<html><body>", ""])
def test_text_in_several_elements_of_the_body(tag, inner, around, start):
    paragraphs = [f"{i} " + "words of a paragraph " * 19 + "end" for i in range(8)]
    halves = ["".join(f"<p>{p}</p>" for p in half) for half in (paragraphs[:4], paragraphs[4:])]
    page = start + around + "".join(f"<{tag}>{inner.format(half)}</{tag}>" for half in halves) + around
    assert html_text.main_text(page).split("\n") == paragraphs


def test_text_between_the_elements_of_the_body():
    paragraph = "words of a paragraph " * 20
    block = f"<div>{f'<p>{paragraph}</p>' * 4}</div>"
    got = html_text.main_text(f"<html><body>{block}Loose text.{block}</body></html>")
    assert got.split("\n") == [paragraph.strip()] * 4 + ["Loose text."] + [paragraph.strip()] * 4


PARAGRAPH = ("A paragraph of the article says what happened, when it did and why. " * 6).strip()


def page(*parts):
    return "<html><body>" + "".join(parts) + "</body></html>"


@pytest.mark.parametrize(
    "parts,want",
    [
        # One paragraph in the article and a notice of its length beside it.
        ([f"<article><p>{PARAGRAPH}</p></article>", f"<div class='legal'><p>{PARAGRAPH[::-1]}</p></div>"], [PARAGRAPH]),
        ([f"<div class='text'><p>{PARAGRAPH}</p></div>", f"<div class='legal'><p>{PARAGRAPH[:-1]}</p></div>"][:1], [PARAGRAPH]),
        # Comments and teasers as articles.
        ([f"<article><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></article>", "<section id='reader-opinions'><article><p>I think so too.</p></article></section>"], [PARAGRAPH] * 2),
        ([f"<main><article><p>{PARAGRAPH}</p></article>", "<article class='card'><a href=x>More news of today</a></article>" * 5, "</main>"], [PARAGRAPH]),
        ([f"<article><p>{PARAGRAPH}</p><article><p>A reader was there.</p></article></article>"], [PARAGRAPH]),
        ([f"<article><p>{PARAGRAPH}</p><div class='usercomments'><p>{PARAGRAPH}</p></div></article>"], [PARAGRAPH]),
        (["<article><a href=1>Card one of two</a></article>" * 2, f"<div><p>{PARAGRAPH}</p>" * 3, "</div>" * 3], [PARAGRAPH] * 3),
        # Named sections of the article.
        ([f"<article><p>{PARAGRAPH}</p><section id='related-work'><p>Others tried it.</p></section></article>"], [PARAGRAPH, "Others tried it."]),
        ([f"<article><p>{PARAGRAPH}</p><div class='share prices'><p>Shares fell.</p></div></article>"], [PARAGRAPH, "Shares fell."]),
        ([f"<article><section class='menu'><p>Soup, bread.</p></section><p>{PARAGRAPH}</p></article>"], ["Soup, bread.", PARAGRAPH]),
        ([f"<article><p>{PARAGRAPH}</p><ul class='related'><li><a href=1>Read this</a><li><a href=2>And that</a></ul></article>"], [PARAGRAPH]),
        # No article: what stands beside the text.
        (["<h1>The title</h1>", f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>", "<p>The last words.</p>"], ["The title", PARAGRAPH, PARAGRAPH, "The last words."]),
        (["<div><h1>The title</h1>", f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div></div>"], ["The title", PARAGRAPH, PARAGRAPH]),
        ([f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>", "<div>© 2024 The company. All rights reserved.</div>"], [PARAGRAPH] * 2),
        ([f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>", "<div><p>By reading this site, which is long and has many words to say it, you accept our terms of use and all else.</p></div>"], [PARAGRAPH] * 2),
    ],
)
def test_density_decides_and_names_are_evidence(parts, want):
    assert html_text.main_text(page(*parts)).split("\n") == want
