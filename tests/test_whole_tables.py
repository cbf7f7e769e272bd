"""The registered queries read whole tables: rows without text are rows besides the real ones."""

import os

import pytest
from pyspark.sql import functions as F

from posting_analytics.plans import driver_queries as Q

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_every_page_gives_a_posting(spark):
    ids = sorted(r[0] for r in Q.table(spark, SF, "pages").select("page_id").collect())
    assert sorted(r[0] for r in Q.extract_postings(spark, SF).select("page_id").collect()) == ids


def test_rejects_are_the_copies_without_html(spark):
    ids = {r[0] for r in Q.table(spark, SF, "pages").select("page_id").collect()}
    got = sorted(r["page_id"] for r in Q.rejects(spark, SF).collect())
    assert got == sorted(i for i in ids if i % 7 < 2)


def test_every_text_passes_every_sink(spark):
    """Each real text comes back whole; empty strings and NULLs come back under ids of their own."""
    d = Q.table(spark, SF, "documents").select("doc_id", F.length("text").alias("whole"))
    out = Q.text_roundtrip(spark, SF).cache()
    real = out.join(d, "doc_id").selectExpr("doc_id", "sink", "n - whole AS more").collect()
    added = {0: 4, 3: 5}  # characters put around the text
    assert len(real) == 3 * d.count()
    assert all(r["more"] == added.get(r["doc_id"] % 5, 0) for r in real)
    bare = out.filter("doc_id < 0").groupBy("sink", "n").count().collect()
    assert {r["n"] for r in bare} == {0, -1} and len(bare) == 6
    out.unpersist()
