"""Inputs that break backtracking regex engines: long runs of tags, huge
blocks, unclosed elements.  Each must finish without a stack overflow."""

import pytest

from posting_analytics import vocab
from posting_analytics.functions import money, text
from posting_analytics.operators import extract

N = 50_000

CASES = {
    "tag_run": "<p>a</p>" + "<b> " * N + "<p>z</p>",
    "tags_no_space": "<h1>t</h1>" + "<i></i>" * N,
    "script_block": "<script>" + "x<y " * N + "</script><p>after</p>",
    "unclosed_comment": "<p>a</p><!--" + "- " * N,
    "anchor_openings": '<a href="/x">x</a>' + "<a " * N,
    "whitespace_run": "<p>a" + " \t\n" * N + "b</p>",
    "entities": "<p>" + "&amp;&nbsp;" * N + "</p>",
    "digits": "Rp " + "1." * N,
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_extraction_survives(spark, name):
    df = spark.createDataFrame([(1, "u", CASES[name])], "page_id long, url string, html string")
    out = extract.extract_postings(df, run_date="2026-06-13", company_href="/x")
    row = out.first()
    assert row is not None and row["page_id"] == 1
    links = extract.discover_links(df, href_substring="/x", root="").collect()
    assert [r["url"] for r in links] == (["/x"] if "anchor" in name else [])


def test_pathological_values(spark):
    df = spark.createDataFrame([(CASES["tag_run"], CASES["digits"])], "h string, d string")
    r = df.select(text.html_to_text("h").alias("t"), money.amount_range("d").alias("a")).first()
    assert r["t"] == "a z"
    assert r["a"].startswith("Rp. 1") and r["a"] != vocab.NOT_STATED
