"""HTML extraction: driver pages against their article, hand-made pages, the density formula."""
import html
import math
import re

import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from tessera.llm import htmltext
from tessera.llm.htmltext import main_text


def test_driver_pages():
    pages = ds.dataset("/root/testdata/sf0.01/pages.parquet").to_table().to_pylist()
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert main_text(p["html"]) == "\n".join(b for b in blocks if b)


LONG = "This is a sentence of the article that is long enough to count as running text, with commas and all."
CASES = {
    "plain divs, no article element": (
        f'<body><div id="top"><a href="/">Home</a> <a href="/n">News</a></div><div class="story"><h1>Title</h1><p>{LONG}</p>'
        f'<p>Short.</p><p>{LONG} <a href="x">More</a></p></div><div class="zz"><ul><li><a href="1">One link</a></li>'
        '<li><a href="2">Two link</a></li></ul></div></body>', f"Title\n{LONG}\nShort.\n{LONG} More"),
    "comments, notices, adverts and forms are cut": (
        f'<article><h1>T</h1><p>{LONG}</p><div class="ad-slot">Buy now!</div><p>B &amp; C&nbsp;&lt;d&gt;</p></article>'
        f'<section id="comments"><p>{LONG} {LONG} {LONG}</p></section><form><p>{LONG}</p></form>'
        f'<div class="cookie-notice">{LONG}</div><aside><p>{LONG}</p></aside>', f"T\n{LONG}\nB & C <d>"),
    "unclosed tags and stray ends": (
        f"<div><p>{LONG}<p><b>Two<br>lines</p></b></i><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></div>",
        f"{LONG}\nTwo lines\na\nb\nc\nd\ne"),
    "scripts, styles, comments and CDATA": (
        f"<body><script>if (a<b) '<p>x</p>'</script><style>p>b{{}}</style><!-- <p>no</p> --><p>{LONG}</p><![CDATA[raw & <x>]]></body>",
        f"{LONG}\nraw & <x>"),
    "no markup at all": ("just text\n over lines", "just text over lines"),
    "white space inside a block": (f"<p>  a \n b\t<i>c</i>d </p><p>\n</p><p>{LONG}</p>", f"a b cd\n{LONG}"),
    "header inside an article stays": (
        f"<header><h2>Site</h2></header><article><header><h1>T</h1></header><p>{LONG}</p></article>", f"T\n{LONG}"),
    "hidden elements": (f'<p>{LONG}</p><p hidden>no</p><div style="display: none">no</div><p aria-hidden="true">no</p>', LONG),
    "quotes with angle brackets": (f'<p title="a > b">{LONG}</p><a href="x>y">z', f"{LONG}\nz"),
    "nothing but menus": ('<body><nav><a href="1">a</a></nav><footer>x</footer></body>', ""),
    "empty": ("", ""), "null": (None, ""), "broken": ("<", "<"), "broken tag": ("<p", "<p"), "only tags": ("<p><div></p>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    page, want = CASES[name]
    assert main_text(page) == want


WRAPPERS = ["content has-sidebar", "no-sidebar", "with-comments", "layout_sidebar_left", "entry-content legal"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_wrappers_with_hint_words_stay(name):
    inner = f'<p>{LONG}</p><p>{LONG}</p><div class="sidebar"><p>{LONG}</p></div>'
    side = f'<div class="related"><article><p>{LONG[:40]}</p></article></div><div id="comments"><p>{LONG}</p></div>'
    assert main_text(f'<body><div class="{name}"><h1>T</h1>{inner}</div></body>') == f"T\n{LONG}\n{LONG}"
    assert main_text(f'<body><main><h1>T</h1><div class="{name}">{inner}</div></main></body>') == f"T\n{LONG}\n{LONG}"
    assert main_text(f'<body><div class="{name}"><article><h1>T</h1>{inner}</article>{side}</div></body>') == f"T\n{LONG}\n{LONG}"


def test_density_is_the_papers_formula():
    page = "<body><div><p>0123456789</p><p>01234<a href=x>56789</a></p></div></body>"
    order = htmltext._measure(htmltext.parse(page))
    div = next(n for n in order if n.tag == "div")
    assert (div.chars, div.tags, div.link_chars, div.link_tags) == (20, 3, 5, 1)
    base = math.log(20 / 15 * 5 + 5 / 20 * 20 + math.e)
    assert div.density == pytest.approx(20 / 3 * math.log(20 / 5 * 3 / 1, base))
    assert div.total == pytest.approx(sum(p.density for p in div.parts))


def test_deep_wide_and_long_pages():
    assert main_text("<div>" * 30000 + LONG + "</div>" * 30000) == LONG
    assert main_text("<p>x</p>" * 20000).count("\n") == 19999
    assert main_text(f"<p>{'word ' * 200000}</p>") == ("word " * 200000).strip()


def test_dataframe(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", "c"), (2, None, None, "c"), (None, "u", "", "c"), (1, "u", f"<p>{LONG}</p>", "c"),
            (3, "u", "<p>é日</p>", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmltext.extract(df)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [
        (0, "", 0), (1, LONG, len(LONG)), (1, LONG, len(LONG)), (2, "", 0), (3, "é日", 2)]
    assert htmltext.extract(df.where(F.lit(False))).count() == 0


SENTENCE = "A sentence of the article that is long enough to count as its text, with several words in it. " * 3


@pytest.mark.parametrize("tag", [
    '<p title="The hidden cost">{}</p>', '<p data-hidden="false">{}</p>', '<p data-id="share-1">{}</p>',
    '<p><a href="/x?id=menu">{}</a></p>', '<h2 id="legal">{}</h2>', '<section id="social">{}</section>',
    '<p id="search-results">{}</p>', "<p data-x='class=\"ad\"'>{}</p>", '<p title="a > b, style=display:none">{}</p>'])
def test_words_inside_attribute_values_cut_nothing(tag):
    page = f"<html><body><article><h1>Head</h1><p>{SENTENCE}</p>{tag.format('kept words')}<p>{SENTENCE}</p></article></body></html>"
    assert "kept words" in htmltext.main_text(page).split("\n")


def test_comments_and_adverts_inside_the_article_go():
    page = (f"<body><article><h1>Head</h1><p>{SENTENCE}</p><div class='ad'>buy</div><div id=comments><p>first!</p></div>"
            f"<p>{SENTENCE}</p><article class=x><p>a reader's words</p></article><article><h2>Part</h2><p>own part</p></article></article>")
    assert htmltext.main_text(page).split("\n") == ["Head", SENTENCE.strip(), SENTENCE.strip(), "Part", "own part"]


@pytest.mark.parametrize("unit", ["<a ", "<a x=\"> ", "<a x='> <b y=\"", '<a x=">" ', "</p ", "<!-", "<div>", "<b></i>", "<p><i>"])
def test_hostile_markup_takes_linear_time(unit):
    import time
    spent = []
    for size in (60_000, 240_000):
        start = time.process_time()
        htmltext.main_text(unit * (size // len(unit)))
        spent.append(time.process_time() - start)
    assert spent[1] < 10 * max(spent[0], 0.2)
