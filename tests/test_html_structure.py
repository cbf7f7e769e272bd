"""Hand-written pages whose elements are nested, unclosed or hidden, and attributes of any length.

Expected texts follow the tree that a parser builds: an end tag closes the last open
element of its name and everything inside it, and what is open at the end ends there.
"""

import time

import pytest

from posting_analytics import vocab
from posting_analytics.functions import text

NF = vocab.NOT_FOUND
LONG = "x > " * 3000

# html, page text, first h1, first link with /companies/ in its href, hrefs
PAGES = [
    (f'<a title="{LONG}" href="/companies/1">Acme</a> z', "Acme z", NF, "Acme", ["/companies/1"]),
    (f"<p data-x='{LONG}'>a</p><h1 class='{LONG}'>T</h1>", "a T", "T", NF, []),
    ("<template>a<template>b</template>c</template>d<TEMPLATE id='>'>e</template>f", "d f", NF, NF, []),
    ("a<template>b", "a", NF, NF, []),
    ("<h1>a<h1>b</h1>c</h1>d", "a b c d", "abc", NF, []),
    ("<div><h1>Title</div><p>rest</p>", "Title rest", "Title", NF, []),
    ("<div><section><h1>A <i>b</section> c</i></h1></div>", "A b c", "A b", NF, []),
    ("<h1>x<p>y</p> z</h1>w", "x y z w", "xy z", NF, []),
    ("<h1>a<br>b<img src=x>c</h1>", "a b c", "abc", NF, []),
    ("<h1>one <b>two</b></h1><h1>three</h1>", "one two three", "one two", NF, []),
    ("<h1>open <i>x</i> to the end", "open x to the end", "open x to the end", NF, []),
    ("<h1></h1><h1>b</h1>", "b", "", NF, []),
    ("<!-- <h1>no</h1> --><script>'<h1>x</h1>'</script><h1>yes</h1>", "yes", "yes", NF, []),
    ("<p title='<h1>no</h1>'>a</p><h1>yes</h1>", "a yes", "yes", NF, []),
    ("<style>p > q { content: '</p>' }</style>a", "a", NF, NF, []),
    ("a<script>if (x < y) { '</p>' }</script >b", "a b", NF, NF, []),
    ("a<!-- x -- > y -->b<!-->c<!--d--!>e", "a b c e", NF, NF, []),
    ("<!DOCTYPE html><?php x ?>a</ b>c", "a c", NF, NF, []),
    ("<p title=it's>b</p>it's", "b it's", NF, NF, []),
    ("x < y <3 > z", "x < y <3 > z", NF, NF, []),
    ("a<b/c='>'/>d", "a d", NF, NF, []),
    ("<a href = '/companies/2'\n>B</a><a href=/companies/3/>C</a>", "B C", NF, "B", ["/companies/2", "/companies/3/"]),
    ("<a data-href='/companies/1' href=/x>n</a><A HREF=\"/companies/9\">y</A>", "n y", NF, "y", ["/x", "/companies/9"]),
    ("<a href='/companies/1'><div>B<p>b</div></a>", "B b", NF, "Bb", ["/companies/1"]),
    ("<!--<a href='/companies/0'>n</a>--><a name=x>m</a><a href>k</a><a href=''>l</a>", "m k l", NF, NF, [""]),
    ("a<scripted>b</scripted><styles>c</styles>", "a b c", NF, NF, []),
    ("&amp;lt; &copy;&eacute;&Eacute; &#233;&#xE9; &amp;amp; & &unknown; &amp", "&lt; ©éÉ éé &amp; & &unknown; &amp",
     NF, NF, []),
    ("AT&<b>amp;</b>T", "AT& amp; T", NF, NF, []),
    ("a<script>b", "a", NF, NF, []), ("a<!-- b", "a", NF, NF, []), ("a<b title='", "a", NF, NF, []),
    ("", "", NF, NF, []), (None, "", NF, NF, None),
]


@pytest.fixture(scope="module")
def read(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PAGES)], "i int, h string")
    rows = df.select("i", text.html_to_text("h").alias("t"), text.first_tag_text("h").alias("h1"),
                     text.anchor_text("h").alias("a"), text.hrefs("h").alias("l")).collect()
    return {r.i: (r.t, r.h1, r.a, r.l) for r in rows}


@pytest.mark.parametrize("i", range(len(PAGES)))
def test_page(read, i):
    page, shown, h1, a, hrefs = PAGES[i]
    if hrefs == [""]:
        hrefs = ['']  # an empty value is a value
    assert read[i] == (shown, h1, a, hrefs), page


N = 50_000
HOSTILE = ["<a " * N, "<a b='" + "<a b=\"" * N, "<!--" * N, "<script>" + "</scrip" * N, "<a href='" * N,
           "<template>" * 2000, "<h1>" + "<b x='>'>" * 5000, "<h1>" + "</p><p>" * 5000 + "</h1>", "<p a=" * N + ">"]


@pytest.mark.parametrize("i", range(len(HOSTILE)))
def test_hostile_pages_end_soon(spark, i):
    df = spark.createDataFrame([(HOSTILE[i],)], "h string")
    begin = time.time()
    df.select(text.html_to_text("h"), text.first_tag_text("h"), text.anchor_text("h"), text.hrefs("h")).collect()
    assert time.time() - begin < 30
