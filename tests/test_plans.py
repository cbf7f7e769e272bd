"""Physical-plan checks: the plans we want at scale, not just right answers."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from posting_analytics.operators import extract, report
from posting_analytics.plans import driver_queries as Q

SF = "/root/testdata/sf0.001"


def plan(df):
    """The formatted physical plan, as ``explain("formatted")`` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_semijoin_broadcasts_k_rows(spark):
    df = Q.table(spark, SF, "orders")
    p = plan(report.keep_top_k(df, "o_custkey", 5))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_share_uses_subquery_not_global_window(spark):
    p = plan(report.value_share(Q.table(spark, SF, "orders"), "o_custkey", order=False))
    assert "Window" not in p
    assert "Subquery" in p or "subquery" in p


def test_top_n_per_group_limits_before_shuffle(spark):
    p = plan(report.top_n_per_group(Q.table(spark, SF, "orders"), "o_orderstatus", "o_custkey", 5))
    # a partial limit on each map partition, the final one after the shuffle
    assert "row_number(), 5, Partial" in p and "row_number(), 5, Final" in p


def test_mode_is_plain_aggregation(spark):
    p = plan(report.group_mode(Q.table(spark, SF, "customer"), "c_nationkey", "c_mktsegment"))
    assert "Window" not in p


def test_filters_reach_parquet_scan(spark):
    p = plan(Q.required_filter(spark, SF))
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters")][0]
    for f in ("IsNotNull(o_orderstatus)", "IsNotNull(o_orderpriority)",
              "Not(EqualTo(o_orderstatus,P))", "Not(EqualTo(o_orderpriority,4-NOT SPECIFIED))"):
        assert f in pushed


def test_scan_prunes_columns(spark):
    p = plan(Q.value_share(spark, SF))
    assert "ReadSchema: struct<o_orderpriority:string>" in p


@pytest.mark.parametrize("name", ["extract_postings", "amount_range", "keyword_tags", "html_text",
                                  "cluster_summary", "topn_per_group"])
def test_no_python_udfs(spark, name):
    p = plan(Q.QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_extraction_adds_no_shuffle(spark):
    pages = Q.table(spark, SF, "pages")
    many = pages.repartition(spark.sparkContext.defaultParallelism * 2)
    p = plan(extract.extract_postings(many, run_date="2026-01-01").select("job_title"))
    # only the repartition of the test itself
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1


def test_spread_is_the_callers_choice(spark):
    from posting_analytics.operators.partitioning import spread
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert spread(docs, 5).rdd.getNumPartitions() == 5
    assert "Exchange" not in plan(Q.normalize_ws(spark, SF))


def test_cluster_summary_limits_before_shuffle(spark):
    from posting_analytics.operators import documents
    parts = Q._part_flags(spark, SF).withColumn("p_size", F.col("p_size").cast("string"))
    p = plan(documents.cluster_summary(parts, cluster="p_type", category="p_brand", location="p_name",
                                       education="p_size", flag="premium", top_categories=100))
    # limited count maps are cut on each partition first; modes need no window
    assert "row_number(), 5, Partial" in p and "row_number(), 100, Partial" in p
    assert "row_number(), 5, Partial" in plan(Q.cluster_summary(spark, SF))  # its category map is whole
    assert len(re.findall(r"^\(\d+\) Window ", p, re.M)) <= 2


def page_texts(df):
    """Replacements of a page's markup in the optimized plan: one per page text that is worked out."""
    return df._jdf.queryExecution().optimizedPlan().toString().count(",  $2 ,")


def test_cleaning_in_the_plan_reads_each_page_once(spark):
    from posting_analytics.operators import clean
    from posting_analytics.operators.partitioning import compute_once
    pages = Q.table(spark, SF, "pages")
    postings = extract.extract_postings(pages, keep=("page_id",), **Q.PAGE_PARAMS)
    share = Q.page_location_share(spark, SF)
    assert page_texts(share) == 2  # the shares and their grand total, which take the same exchange
    share.collect()
    assert "ReusedExchange" in plan(share)
    assert page_texts(clean.clean_postings(compute_once(postings))) == 1
    assert page_texts(clean.clean_postings(postings)) > 1  # what the barrier is for


def test_no_query_falls_back_from_code_generation(spark):
    """With the fallback off, a stage whose generated code fails to compile is an error."""
    key = "spark.sql.codegen.fallback"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        for name in ("page_location_share", "extract_postings", "html_text", "keyword_tags_whole_word",
                     "amount_range", "html_anchor", "cluster_summary"):
            Q.QUERIES[name](spark, SF).collect()
    finally:
        spark.conf.set(key, old)


def test_distinct_counts_column_branches(spark):
    p = plan(report.distinct_counts(Q.table(spark, SF, "orders"), ["o_custkey", "o_orderstatus"]))
    # no row expansion; each branch reads only its own column
    assert "Expand" not in p
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert sorted(set(schemas)) == ["struct<o_custkey:bigint>", "struct<o_orderstatus:string>"]


def test_percent_stays_in_codegen(spark):
    df = Q.table(spark, SF, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    from posting_analytics.functions import percent
    p = plan(df.select(percent(F.col("n"), F.lit(10), 2)))
    assert "BatchEvalPython" not in p
