"""Rendering of pages: fixtures for each rule, and all visible words of the given pages."""

from __future__ import annotations

import html
import random
import re

import pytest
from conftest_llm import SF_DIR
from marginlab.llm import queries
from marginlab.llm.html_text import html_texts, page_text
from pyspark.sql import functions as F

PAGES = {
    "blocks": ("<h1>A &amp; b</h1><p>One\n two<p>Three<br>four<div>five</div>six", "A & b\n\nOne two\n\nThree\nfour\n\nfive\nsix"),
    "inline": ("a<b>b</b> <i> c</i>\n<span>d</span>", "ab c d"),
    "hidden": ("<p hidden>x</p><p style='color:red; DISPLAY : none'>x</p><p data-x='hidden'>y</p><div style=visibility:hidden>x</div>", "y"),
    "unseen": ("<head><title>t</title></head><body>a<script>if (1<2) x</script><style>x</style><template>x</template>b", "ab"),
    "head": ("<html><head><meta><body>shown", "shown"),
    "lists": ("<ul><li>a<li>b<ol start=3><li>c<li value=9>d<li>e</ol><li>f</ul>", "- a\n- b\n  3. c\n  9. d\n  10. e\n- f"),
    "item lines": ("<ul><li>a<br>b<p>c</ul>", "- a\n  b\n\n  c"),
    "definitions": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    "table": ("<table><caption>C</caption><tr><th>Name<th>N<tr><td>long one<td>1<tr><td>x<td>22</table>z", "C\nName      N\nlong one  1\nx         22\n\nz"),
    "sections": ("<table><thead><tr><td>a<tbody><tr><td>b</table>", "a\nb"),
    "colspan": ("<table><tr><td colspan=2>both<td>c<tr><td>a<td>bb<td>d</table>", "both   c\na  bb  d"),
    "cells without rows": ("<table><td>a<td>b</table>", "a  b"),
    "nested table": ("<table><tr><td><table><tr><td>a<td>b</table><td>c</table>", "a  b  c"),
    "pre": ("<pre> a\n   b\n\nc</pre>d", " a\n   b\n\nc\n\nd"),
    "comments": ("a<!-- <p>x</p> -->b<!doctype html><?x y?>c", "abc"),
    "not tags": ("a < b && c > d <3", "a < b && c > d <3"),
    "quotes": ("<a title='>'>x</a><a title=\"<p>\">y</a>", "xy"),
    "open quote": ("<a href='x>y</a> z", "y z"),
    "stray ends": ("</div>a</p>b</li></table>c", "abc"),
    "details": ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details>", "s\nt\ny"),
    "open end": ("<div><p>a<b>b", "ab"),
    "unclosed script": ("a<script>x", "a"),
    "formulas and drawings": ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> <svg><title>no</title><text>b</text></svg>", "a x=1 b"),
    "fields": ("a<textarea>\n b <i>\n  c &amp;</textarea><xmp><b>d</b></xmp>e", "a\n b <i>\n  c &\n<b>d</b>\ne"),
    "closed list": ("<select><option>a<option selected>b<option>c</select><select><optgroup><option>d</optgroup><option>e</select>", "b\nd"),
    "open list": ("<select multiple><option>a<option>b</select><select size=3><option>c<option>d</select>", "a\nb\nc\nd"),
    "names of attributes": ("<p data-style='display:none'>a</p><p data-hidden>b</p><p title='hidden'>c</p><p style='x-display:none'>d</p><p HIDDEN>e</p>", "a\n\nb\n\nc\n\nd"),
    "visible again": ("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c<p style='display:none'><i style='visibility:visible'>d</i></div>", "b"),
    "rows reach down": ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    "rows reach to the end": ("<table><tbody><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    "long numbers": ("<ol start='12345'><li>a<li value=-3>b</ol>", "12345. a\n-3. b"),
    "nothing": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_fixture(name):
    page, text = PAGES[name]
    assert page_text(page) == text


def grid(rows):
    """{(row, column): text} of rows of (text, across, down), by a set of taken places."""
    taken, out = set(), {}
    for r, cells in enumerate(rows):
        c = 0
        for text, across, down in cells:
            while (r, c) in taken:
                c += 1
            out[r, c] = text
            taken |= {(r + i, c + k) for i in range(down) for k in range(across)}
            c += across
    return out


@pytest.mark.parametrize("seed", range(20))
def test_cells_of_a_column_begin_at_one_place(seed):
    """Random tables; cells are long, spanning ones short, and none reaches into another."""
    rnd = random.Random(seed)
    rows, n = [], 0
    for _ in range(rnd.randint(1, 6)):
        cells = []
        for _ in range(rnd.randint(1, 5)):
            n += 1
            across = rnd.choice([1, 1, 1, 2])
            cells.append((f"c{n}" + "x" * (rnd.choice([0, 3, 90]) if across == 1 else 0), across, rnd.choice([1, 1, 2]) if across == 1 else 1))
        rows.append(cells)
    page = "<table>" + "".join("<tr>" + "".join(f"<td colspan={a} rowspan='{d}'>{t}" for t, a, d in cells) for cells in rows) + "</table>"
    lines = page_text(page).split("\n")
    assert len(lines) == len(rows)
    begins = {}
    for (r, c), text in grid(rows).items():
        at = re.search(rf"(?<!\S){text}(?!\S)", lines[r]).start()
        begins.setdefault(c, set()).add(at)
    assert all(len(x) == 1 for x in begins.values()), (page, lines)
    assert [min(begins[c]) for c in sorted(begins)] == sorted(min(x) for x in begins.values())


def test_deep_and_long_pages():
    assert page_text("<table><tr><td>" * 3_000 + "a") == "a"
    wide = page_text("<table><tr><td>" + "w" * 500 + "<td>b<tr><td>c<td>d</table>").split("\n")
    assert wide[0].index("b") == wide[1].index("d") == 502
    nested = "<table><tr><td>" * 20 + "<table><tr><td>a<td>b</table>" + "</table>" * 20
    assert page_text(nested) == "a  b"
    assert page_text("<table>" + "<tr><td colspan=99999 rowspan=99999>a" * 50 + "</table>").split() == ["a"] * 50
    assert page_text("<div>" * 50_000 + "a") == "a"
    assert page_text("<table><tr><td>" * 300 + "a") == "a"
    assert page_text("<ul><li>" * 2000 + "a").endswith("a")
    assert page_text("<p>word " * 100_000).count("word") == 100_000
    assert page_text("<a b='" * 300) == ""


def test_query_keeps_every_visible_word(spark):
    pages = {r.page_id: r.html for r in queries.table(spark, SF_DIR, "pages").collect()}
    found = queries.QUERIES["op9_html_text"](spark, SF_DIR).collect()
    assert {r.page_id for r in found} == set(pages)
    for r in found:
        body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<(script|style)\b.*?</\1>", " ", pages[r.page_id])
        plain = html.unescape(re.sub(r"</?(?:b|i|a|em|strong|span)\b[^>]*>", "", body))
        plain = re.sub(r"<[/!a-zA-Z][^>]*>", " ", plain)
        shown = [w for w in r.text.split() if not re.fullmatch(r"-|\d+\.", w)]
        assert shown == [w for w in plain.split() if not re.fullmatch(r"-|\d+\.", w)]
        assert r.n_chars == len(r.text)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "<p>a"), (3, "<p>a"), (None, "b")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("x")).withColumn("key", F.lit(1))
    found = sorted(((r.page_id, r.text) for r in html_texts(df).collect()), key=str)
    assert found == sorted([(1, ""), (2, ""), (3, "a"), (3, "a"), (None, "b")], key=str)
    assert html_texts(df.limit(0)).collect() == []
