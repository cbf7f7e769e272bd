"""Dictionary, pattern and amount extraction against plain Python string
semantics (str.lower, ``in``, ``re`` with Python's whitespace) over every
document of the test table."""

import os
import re

import pytest
import text_rules as rules
from pyspark.sql import functions as F

from posting_analytics import vocab
from posting_analytics.functions import match, money, text
from posting_analytics.plans import params as P

DOCS = "/root/testdata/sf0.01/documents.parquet"
pytestmark = pytest.mark.skipif(not os.path.exists(DOCS), reason="test tables not present")


def first_in_text(pattern, s):
    """The earliest match, found by trying every start."""
    for start in range(len(s)):
        m = re.compile(pattern).match(s, start)
        if m and m.group():
            return m.group()
    return vocab.NOT_FOUND


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(DOCS)
    return d.select(
        "doc_id", "text",
        text.normalize_ws("text").alias("norm"),
        match.first_listed("text", P.DOC_FIRST_WORDS).alias("first"),
        match.keyword_tags("text", P.DOC_TAG_WORDS).alias("tags"),
        match.ordered_label("text", P.DOC_LABELS, vocab.NOT_FOUND).alias("label"),
        money.amount_range("text", P.DOC_AMOUNT_PATTERN).alias("amounts"),
        match.regex_first("text", P.DOC_REF_PATTERN).alias("ref"),
        match.regex_first(F.col("text"), vocab.EDUCATION_PATTERN).alias("grade"),
    ).collect()


def test_documents_against_python(docs):
    assert len(docs) > 0
    for r in docs:
        s = r["text"]
        assert r["norm"] == rules.one_space(s), r["doc_id"]
        assert r["first"] == rules.first_rule(s, [(w, w.title()) for w in P.DOC_FIRST_WORDS]), r["doc_id"]
        assert r["tags"] == rules.listed_words(s, P.DOC_TAG_WORDS), r["doc_id"]
        assert r["label"] == rules.first_rule(s, P.DOC_LABELS), r["doc_id"]
        assert r["amounts"] == rules.amount_range(rules.AmountScanner(s, dot_first=False).amounts()), r["doc_id"]
        assert r["ref"] == first_in_text(P.DOC_REF_PATTERN, s), r["doc_id"]
        assert r["grade"] == first_in_text(vocab.EDUCATION_PATTERN, s), r["doc_id"]


def test_every_python_whitespace_collapses(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    rows = [(f"a{ch}{ch}b",) for ch in spaces] + [("a\u200bb",)]   # zero-width space is not whitespace
    got = [r["n"] for r in spark.createDataFrame(rows, "t string")
           .select(text.normalize_ws("t").alias("n")).collect()]
    assert got == ["a b"] * len(spaces) + ["a\u200bb"]
