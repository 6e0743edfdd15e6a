import time

import pytest
from pyspark.sql import functions as F

from tillroll.llm.html_layout import render, with_text

CASES = {
    "<p>One <b>two</b>\n three<p>Four<br>five": "One two three\n\nFour\nfive",
    "a<div>b</div>c<div><div>d</div></div>": "a\nb\nc\nd",
    "<title>t</title><body>x<script>var a='</p>'</script><style>p{}</style><!-- c -->y": "xy",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": "- a\n- b\n  - c\n- d\n\ne",
    "<ol start=9><li>a<p>b</p><li value=20>c<li>d</ol>": "9. a\n\n   b\n20. c\n21. d",
    "<table><tr><th>Name<th>N<tr><td>apple pie<td>3<tr><td colspan=2>all of it</table>":
        "Name        N\napple pie   3\nall of it",
    "<table><caption>cap</caption><thead><tr><td>a</thead><tbody><tr><td>bb<br>c<td>d</table>": "cap\na\nbb   d\nc",
    "<td>a<td>b": "a\nb",
    "<div hidden>no</div><div style='display : none'>no<p>no</p></div>yes": "yes",
    "<p style='visibility:hidden'>no<i style='visibility: visible'>yes</i></p>": "yes",
    "<details>no<summary>s</summary><p>no</details><details open>yes</details>": "s\nyes",
    "<pre>\n a\n   b\n</pre>c": " a\n   b\n\nc",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "&lt;b&gt; &amp; &copy;&nbsp;x": "<b> & © x",
    "</p></td></div>text</b>": "text",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<p>a<table><tr><td><p>b<p>c</table>d": "a\n\nb\n\nc\n\nd",
    "a<hr>b": "a\n\n---\n\nb",
    "<select><option>x<option>y</select>": "x\ny",
    "": "",
    "<p></p><div></div>": "",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert render(html) == CASES[html]

HEADS_AND_SPANS = {
    "<!doctype html><html><head><title>t</title><p>text<h1>more</h1>": "text\n\nmore",
    "<html><head><meta charset=x><link rel=y><style>p{}</style>\n <div>a</div>b": "a\nb",
    "<head><title>t</title> words <b>bold</b></head><body>c": "words bold\nc",
    "<head><script>var a='<p>'</script><noscript>no<p>no</noscript><template><p>no</template><br>yes": "\nyes",
    "<head><head><title>t</title></head>a": "a",
    "<head><title>t</title></head><body><p>a": "a",
    "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td>g<td>h</table>": "a   b   c\n    d   e\nf   g   h",
    "<table><tr><td>a<td rowspan=2>b<br>bb<td>c<tr><td>d<td>e</table>": "a   b    c\nd   bb   e",
    "<table><tr><td rowspan=2>a<br>b<br>c<td>d<tr><td>e</table>": "a   d\nb   e\nc",
    "<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<tr><td>d<td>e<td>f</table>": "a       b\n        c\nd   e   f",
    "<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>": "a   b\n    c\nd   e",
    "<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>d<td>e</table>": "a   b\nd   e",
}


@pytest.mark.parametrize("html", HEADS_AND_SPANS)
def test_implied_end_of_head_and_cells_over_rows(html):
    assert render(html) == HEADS_AND_SPANS[html]


def test_every_visible_word_is_kept_whatever_the_nesting():
    page = "".join(f"<{t}>w{k} " for k, t in enumerate("div p ul li table tr td b pre dl dt dd h1 span".split() * 9))
    assert set(render(page).replace("-", " ").split()) >= {f"w{k}" for k in range(14 * 9)}


def test_deep_nesting_takes_linear_time():
    began = time.time()
    assert render("<div>" * 30_000 + "deep" + "</div>" * 30_000) == "deep"
    assert render("<p>" + "<b>" * 30_000 + "deep") == "deep"
    assert time.time() - began < 10


def test_pages(spark):
    rows = [(1, "u", "<p>a"), (None, None, None), (3, "u", ""), (1, "u", "<p>a"), (4, "u", "<p>" + "x " * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = with_text(pages.withColumn("text", F.lit("old"))).collect()
    assert got[0].asDict() == {"page_id": 1, "url": "u", "text": "a"}
    assert [r["text"] for r in got[1:4]] == ["", "", "a"] and len(got[4]["text"]) == 599_999
    assert with_text(pages.limit(0)).count() == 0
