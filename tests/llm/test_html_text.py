import random
import re
import time
from html import unescape

import pytest

from strandweave.llm.html_text import extract_pages, visible_text

CASES = [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>one<p>two", "one\n\ntwo"), ("a<br>b<div>c</div>d", "a\nb\nc\nd"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"), ("<ol start=3><li>a<li>b</ol>", "3. a\n4. b"),
    ("<table><tr><th>name<th>n<tr><td>ab<td>1<tr><td>c<td>23</table>", "name  n\nab    1\nc     23"),
    ("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide     z\na     b  c"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<pre>a  b\n  c</pre>x", "a  b\n  c\n\nx"), ("<p>a &amp; b&nbsp;c &#233;</p>", "a & b\xa0c é"),
    ("<style>.no{display:none} p.x , #i{visibility:hidden}</style><p class='y no'>1<p class=x>2<p id=i>3<div class=x>4</div><p>5", "4\n\n5"),
    ("<div hidden>no</div><div style='color:red; display : none'>no</div><span style='display:block'>yes</span>", "yes"),
    ("<head><title>t</title></head><script>var a='</p>';</script><!-- c --><noscript>n</noscript><template>t</template>x", "x"),
    ("<b>bold</b>text <i> it </i> .", "boldtext it ."), ("<h1>t</h1>x<h2>u</h2>", "t\n\nx\n\nu"), ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
    ("<p>a<table><tr><td>b</table>c", "a\n\nb\n\nc"), ("<td>lone</td> <li>item", "lone\n- item"), ("</p></div>x</b>", "x"), ("<a href='x>y'>l", "l"),
    ("<table><tr><td><ul><li>a<li>b</ul><td>c</table>", "- a  c\n- b"), ("<div>" * 5000 + "deep", "deep"), ("<b>" * 3000 + "deep", "deep"), ("<", "<"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", None), ("x" * 300000, "x" * 300000), ("<p>1</p>\n\n<p>2</p>", "1\n\n2"),
]


@pytest.mark.parametrize("html, wanted", CASES, ids=range(len(CASES)))
def test_layout(html, wanted):
    text = visible_text(html)
    assert text == wanted if wanted is not None else text.split() == ["a", "b", "in", "ner"]


def plain_words(html):
    """All words outside tags and unseen elements, in order; a block's edge separates words."""
    html = re.sub(r"<!--.*?-->|<(head|script|style)\b.*?</\1>", " ", html, flags=re.S)
    html = re.sub(r"</?(?:b|a)\b[^>]*>", "", html)
    return unescape(re.sub(r"<[^>]*>", " ", html)).split()


def test_given_pages_lose_no_word(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = extract_pages(pages).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(rows) == pages.count()
    for row in rows:
        assert [w for w in row.text.split() if w != "-"] == [w for w in plain_words(row.html) if w != "-"]


def test_edge_pages(spark):
    schema = "page_id bigint, url string, html string, text string, lang int"
    pages = spark.createDataFrame([(1, None, None, "t", 1), (None, "u", "<p>x", None, None), (2, "u", "", "", 2), (2, "u", "", "", 2)], schema)
    assert sorted((r.page_id or 0, r.text) for r in extract_pages(pages).collect()) == [(0, "x"), (1, ""), (2, ""), (2, "")]
    assert extract_pages(pages.where("false")).collect() == []


STYLED = [
    ("@media print { body, nav { display:none } }", "<body><nav>a</nav><p class=x>b", "a\n\nb"), ("@media screen and (max-width: 600px){.x{display:none}} p{color:red}", "<p class=x>b", "b"),
    ("@media screen{@media (min-width:40em){.x{display:none}}}", "<p class=x>b<p>c", "c"), ("@import 'a{b'; @media not print{.x{display:none}}", "<p class=x>b<p>c", "c"),
    (".x{display:none} .x{display:block}", "<p class=x>b", "b"), ("#i{display:block} .x{display:none}", "<p class=x id=i>b<p class=x>c", "b"),
    (".x{display:none !important} p.x{display:block}", "<p class=x style='display:block'>b<p>c", "c"), (".x{display:none}", "<p class=x style='display:block'>b<p class=x>c", "b"),
    (".x{visibility:hidden} b{visibility:visible}", "<p class=x>a <b>b</b> c", "b"), (".x{display:none} b{display:inline}", "<p class=x>a <b>b</b></p>c", "c"),
    ("@font-face{src:x} @keyframes k{from{display:none}} .x.y{display:none}", "<p class=x>a<p class='y x'>b", "a"), ("p{display:nonesuch}", "<p hidden style='display:block'>a<p hidden>b", "a"),
]


@pytest.mark.parametrize("sheet, body, wanted", STYLED, ids=range(len(STYLED)))
def test_style_rules_as_on_a_screen(sheet, body, wanted):
    assert visible_text(f"<style>{sheet}</style>{body}") == wanted
    assert visible_text(f"<style media=print>*{{display:none}}</style><style>{sheet}</style>{body}") == wanted


HEADS = [
    ("<head><title>t</title>Hello <strong>world</strong><br>x", "Hello world\nx"), ("<html><head><meta charset=a>\n<em>a</em> b", "a b"), ("<head><title>t</title><video></video>a", "a"),
    ("<head><style>p{color:red}</style> \n <link><script>x</script></head>a", "a"), ("<head><noscript><img src=x>n</noscript><title>t</title></head>a", "a"), ("a <head> b", "a b"),
    ("<p>a<svg width=1 />b</p>c", "ab\n\nc"), ("<p>a <svg><path d=x /><circle r=1 /></svg> b", "a b"), ("<svg><title>t</title><text>one</text><g><text>two</text></g>no<defs><text>no</text></defs></svg>", "one two"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> a", "x=1 a"), ("<math/>a", "a"), ("<svg><path><p>a", "a"), ("<div/>a</div>b", "a\nb"),
    ("<svg><foreignObject><p>a</p></foreignObject></svg>b", "a\n\nb"), ("<svg><desc>d</desc><style>x</style><a><text>l</text></a></svg>", "l"),
]


@pytest.mark.parametrize("html, wanted", HEADS, ids=range(len(HEADS)))
def test_end_of_head_and_foreign_elements(html, wanted):
    assert visible_text(html) == wanted


def test_odd_numbers_and_declarations():
    assert visible_text('<ol start="--5"><li>a<li>b</ol>') == "1. a\n2. b"
    assert visible_text('<ol start="-2"><li>a<li value="7">b<li>c</ol>') == "-2. a\n7. b\n8. c"
    assert visible_text('<table><tr><td colspan="²">a<td rowspan="x">b</table>') == "a  b"
    assert visible_text("a<![foo[x]]>b<![if IE]>c<![endif]>d") == "abcd"
    assert visible_text("<details><summary>s</summary>hidden</details><details open><summary>t</summary>shown</details>").split() == ["s", "t", "shown"]


def test_wide_cells_cost_no_more():
    began = time.perf_counter()
    cells = "".join(f'<tr><td colspan=1000 rowspan={k % 3 + 1}>c{k}<td>d{k}' for k in range(4000))
    text = visible_text(f"<table>{cells}</table>")
    assert text.count("\n") == 3999 and time.perf_counter() - began < 10
    assert visible_text("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td colspan=2>d</table>") == "a  b\n   c\nd"


def test_any_markup_gives_a_text():
    draw = random.Random(8)
    parts = ["<", ">", "</", "/>", "<!", "<![", "<!--", "-->", "]]>", "<?", "&", "&#", ";", "=", '"', "'", " ", "\n", "a", "9", "²", "table", "tr", "td",
             "<td colspan=", "<ol start=", "<li>", "<svg>", "<math>", "<select>", "<script>", "<style>", "{", "}", "@media ", ".a", ":", "display:none",
             "<p class=a>", "</p>", "<details>", "<pre>", "<br>", "<![CDATA[", "\x00", "\U0001f600", "<template>", "<plaintext>", "<frameset>"]
    for _ in range(20_000):
        assert isinstance(visible_text("".join(draw.choices(parts, k=draw.randrange(1, 25)))), str)
