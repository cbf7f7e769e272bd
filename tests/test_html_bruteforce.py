"""HTML extraction against a brute-force parse with Python's html.parser.

The brute force walks the real DOM events (text nodes, start/end tags) the
way a parser-based scraper sees them; the Spark side is pure regex.  Both run
over every page of the test table.
"""

import os
import re
from html.parser import HTMLParser

import pytest

from posting_analytics import vocab
from posting_analytics.functions import text
from posting_analytics.operators import extract

PAGES = "/root/testdata/sf0.01/pages.parquet"
pytestmark = pytest.mark.skipif(not os.path.exists(PAGES), reason="test tables not present")
WS = re.compile(r"\s+")


class Dom(HTMLParser):
    def __init__(self, href_sub):
        super().__init__(convert_charrefs=True)
        self.href_sub = href_sub
        self.text, self.skip = [], 0
        self.h1, self.in_h1, self.h1_done = None, 0, False
        self.anchor, self.in_a, self.a_done = None, 0, False
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag in ("script", "style"):
            self.skip += 1
        if tag == "h1" and not self.h1_done and not self.in_h1:
            self.in_h1, self.h1 = 1, []
        if tag == "a":
            href = attrs.get("href")
            if href is not None:
                self.hrefs.append(href)
            if href and self.href_sub in href and not self.a_done and not self.in_a:
                self.in_a, self.anchor = 1, []

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.skip:
            self.skip -= 1
        if tag == "h1" and self.in_h1:
            self.in_h1, self.h1_done = 0, True
        if tag == "a" and self.in_a:
            self.in_a, self.a_done = 0, True

    def handle_data(self, data):
        if self.in_h1:
            self.h1.append(data)
        if self.in_a:
            self.anchor.append(data)
        if not self.skip and data.strip():
            self.text.append(data.strip())


def clean(s):
    return WS.sub(" ", s).strip()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(PAGES)


def test_text_title_anchor_match_dom(spark, pages):
    rows = pages.select("page_id", "html", text.html_to_text("html").alias("t"),
                        text.first_tag_text("html", "h1").alias("h1"),
                        text.anchor_text("html", "/th").alias("a")).collect()
    assert rows
    for r in rows:
        dom = Dom("/th")
        dom.feed(r["html"])
        dom.close()
        assert r["t"] == " ".join(" ".join(dom.text).split()), r["page_id"]
        want_h1 = clean("".join(dom.h1)) if dom.h1 is not None else vocab.NOT_FOUND
        assert r["h1"] == want_h1, r["page_id"]
        want_a = clean("".join(dom.anchor)) if dom.anchor is not None else vocab.NOT_FOUND
        assert r["a"] == want_a, r["page_id"]


def test_link_discovery_matches_dom(spark, pages):
    got = {r["url"] for r in extract.discover_links(pages, href_substring="/th", root="").collect()}
    want = set()
    for r in pages.select("html").collect():
        dom = Dom("/th")
        dom.feed(r["html"])
        dom.close()
        want |= {h for h in dom.hrefs if "/th" in h}
    assert got == want


FIXTURES = [
    '<a title="a > b" href="/companies/x">Ac<b>me</b></a> z',
    "<a class='q>' data-x=\"<\" HREF='/companies/9' >B &amp;amp; C</a>",
    "<p title=\"x > y\" alt='<'>caf&eacute; &#8211; it&#x27;s &hearts; &copy; &#128;</p><a href=/companies/u>U</a>",
    "<h1 class=\"a>b\">T &lt;i&gt; <i>x</i></h1><p>y<style>p > q {}</style>z</p><script>var a = '<p>';</script>",
    "<p>full\n time</p>", "<div>a<br/>b</div><!-- <p>no</p> --><p>&amp;lt;</p>", "plain &unknown; text & more",
    "<h1>open <i>x</i> to the end", "<h1>one</h1><h1>two</h1>",
]


@pytest.mark.parametrize("i", range(len(FIXTURES)))
def test_fixture_pages_match_dom(spark, i):
    html = FIXTURES[i]
    r = spark.createDataFrame([(html,)], "h string").select(
        text.html_to_text("h").alias("t"), text.first_tag_text("h", "h1").alias("h1"),
        text.anchor_text("h", "/companies/").alias("a"), text.hrefs("h").alias("l")).first()
    dom = Dom("/companies/")
    dom.feed(html)
    dom.close()
    assert r["t"] == " ".join(" ".join(dom.text).split())
    assert r["h1"] == (" ".join("".join(dom.h1).split()) if dom.h1 is not None else vocab.NOT_FOUND)
    assert r["a"] == (" ".join("".join(dom.anchor).split()) if dom.anchor is not None else vocab.NOT_FOUND)
    assert r["l"] == dom.hrefs


def test_template_content_is_no_text(spark):
    r = spark.createDataFrame([("a<template><p>b</p></template>c",)], "h string").select(text.html_to_text("h")).first()
    assert r[0] == "a c"
