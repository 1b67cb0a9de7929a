import html
import re

import pytest
from llm_data import SF

from clicktide.llm import queries
from clicktide.llm.html_text import extract, page_text

CASES = {
    "implied ends": ("<p>one<p>two<ul><li>a<li>b</ul>", "one\n\ntwo\n\n- a\n- b"),
    "head without end": ("<title>t</title><meta x><h1>H</h1>x", "H\n\nx"),
    "blanks": ("a  b\n\tc<b> d</b>e <i> f</i>", "a b c de f"),
    "line break": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "hidden": ('a<div hidden>b</div><div style="display: none">c</div><script>d</script><style>e</style>f', "af"),
    "visibility": ('<p style="visibility:hidden">a<b style="visibility:visible">b</b>c</p>', "b"),
    "ordered list": ("<ol start=9><li>a<li>b<ul><li>c</ul></ol>", "9. a\n10. b\n    - c"),
    "item with paragraphs": ("<ul><li><p>a</p><p>b</p></ul>", "- a\n\n  b"),
    "pre": ("<pre>\n a\n  b </pre>c", " a\n  b\n\nc"),
    "entities": ("&lt;a&gt; &amp;amp; &eacute;&nbsp;&#x41;", "<a> &amp; é A"),
    "table": ("<table><tr><th>k<th>value<tr><td>long key<td>1</table>", "k         value\nlong key  1"),
    "spans": (
        "<table><tr><td colspan=2>wide cell<td>z<tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e</table>",
        "wide cell  z\na  b       c\n   d       e",
    ),
    "lines in cells": ("<table><tr><td>a<br>b<td>c<br>d</table>", "a  c\nb  d"),
    "cells without rows": ("<table><td>a<td>b</table>", "a  b"),
    "text in tables": ("<table>stray<tr><td>a</table>", "stray\na"),
    "quotes with marks": ('<a title="x>y">l</a><b c=\'>\'>m</b>', "lm"),
    "broken tags": ('a<b "c', "a"),
    "no tags": ("1 < 2 > 1 <3", "1 < 2 > 1 <3"),
    "comments": ("a<!-- <p> -->b<!doctype x>c<![CDATA[d]]>", "abc"),
    "stray ends": ("a</p></div></table>b", "ab"),
    "details": ("<details><summary>s</summary>x</details><details open>y</details>", "s\ny"),
    "nested tables": ("<table><tr><td><table><tr><td>a<td>b</table><td>c</table>", "a  b  c"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    page, want = CASES[name]
    assert page_text(page) == want


@pytest.mark.parametrize("part", ["<div>", "<p>", '<a b="', "<table><tr><td>", "<ul><li>", "<!--", "</", "<script>", "&amp", "<b><p>"])
def test_long_and_deep_pages(part):
    assert page_text(part * 20_000 + "x") is not None


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "<p>a"), (3, "b"), (3, "b"), (4, "<p>" + "word " * 200_000)]
    pages = spark.createDataFrame([(i, "u", h, "x", 1) for i, h in rows], "page_id bigint, url string, html string, text string, _html int")
    got = sorted(((r.page_id, r.text) for r in extract(pages).collect()), key=str)
    assert got == sorted([(1, ""), (2, ""), (None, "a"), (3, "b"), (3, "b"), (4, ("word " * 200_000).strip())], key=str)
    assert extract(pages.limit(0)).count() == 0


def test_query_shows_all_visible_words(spark):
    """Against a plain removal of hidden elements and tags."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.QUERIES["op2_html_text"](spark, SF).collect():
        page = re.sub(r"(?s)<!--.*?-->|<head>.*?</head>|<(title|script|style)[^>]*>.*?</\1>", "", pages[r.page_id])
        words = html.unescape(re.sub(r"<[^>]*>", lambda m: "" if re.match(r"</?(a|b)[ >]", m[0]) else " ", page)).split()
        shown = [w for line in r.text.split("\n") for w in re.sub(r"^- ", "", line).split()]
        assert shown == words
        assert r.n_chars == len(r.text)
