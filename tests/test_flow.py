"""The whole flow written to a folder and read back."""

import datetime as dt
import os

import pytest

from fixtures import PAGES, PAGES_SCHEMA
from posting_analytics import vocab
from posting_analytics.plans import posting_flow
from posting_analytics.session import cluster_conf
from posting_analytics.sources import collections, files
from test_golden import GOLDEN, RAW


@pytest.mark.skipif(len(GOLDEN) < 3, reason="golden files not present")
def test_run_writes_every_stage(spark, scratch):
    raw = files.read_csv(spark, RAW, files.POSTING_SCHEMA).coalesce(1)
    out = os.path.join(scratch, "flow")
    paths = posting_flow.run(spark, out, raw=raw, run_ts=dt.datetime(2026, 6, 13, 8))
    assert spark.read.parquet(paths["postings"]).count() == 160
    assert spark.read.parquet(paths["cleaned"]).count() == 69
    clustered = spark.read.parquet(paths["clustered"])
    assert clustered.columns == list(vocab.CLUSTERED_COLUMNS)
    counts = {r["collection"]: r["n"] for r in collections.count_collections(
        spark, paths["collections"], ["raw_jobs", "cluster_summary", "top_companies"]).collect()}
    assert counts == {"raw_jobs": 69, "cluster_summary": 4, "top_companies": 4}
    share = files.read_csv(spark, paths["report_category_share"])
    assert share.count() == 5
    for chart in ("cluster_sizes", "category_by_cluster", "pca_scores", "pca_variance"):
        assert files.read_csv(spark, os.path.join(paths["charts"], chart)).count() > 0


def test_pages_flow_extracts_and_cleans(spark):
    pages = spark.createDataFrame(PAGES, PAGES_SCHEMA)
    from posting_analytics.operators import clean, extract
    cleaned = clean.clean_postings(extract.extract_postings(pages, run_date="2026-06-13"))
    rows = cleaned.collect()
    assert len(rows) == 1 and rows[0]["keyword_category"] == "Data"
    reports = posting_flow.analysis_reports(cleaned)
    assert reports["location_share"].first()["persentase"] == 100.0


def test_cluster_conf_scales_partitions():
    conf = cluster_conf(4000)
    assert conf["spark.sql.shuffle.partitions"] == "12000"
    assert conf["spark.sql.adaptive.enabled"] == "true"


def every_output(spark, out):
    for name in ("missing", "location_share", "salary_by_city"):
        assert os.path.isdir(f"{out}/reports/{name}")
    for name in ("sizes", "category", "location", "education", "salary"):
        assert os.path.isdir(f"{out}/profiles/{name}")
    for name in ("raw_jobs", "cluster_summary", "top_companies"):
        assert os.path.isdir(f"{out}/collections/{name}")
    for name in ("cluster_sizes", "category_by_cluster", "category_offsets", "top_locations_by_cluster",
                 "salary_split", "pca_scores", "pca_variance"):
        assert os.path.isdir(f"{out}/charts/{name}")
    return spark.read.parquet(f"{out}/clustered")


def test_run_on_one_cleaned_row_writes_every_stage(spark, scratch):
    pages = spark.createDataFrame(PAGES, PAGES_SCHEMA)
    out = os.path.join(scratch, "small")
    paths = posting_flow.run(spark, out, pages=pages, run_date="2026-06-13")
    assert spark.read.parquet(paths["postings"]).count() == 3
    assert files.read_csv(spark, paths["report_location_share"]).count() == 1
    assert every_output(spark, out).select("cluster").collect() == [(0,)]
    rejects = spark.read.parquet(paths["rejects"])
    assert rejects.count() == len(PAGES) - 3 and {r["reason"] for r in rejects.collect()} == {"no html"}
    assert set(files.POSTING_SCHEMA.fieldNames()) <= set(spark.read.parquet(paths["postings"]).columns)


def test_run_without_any_row_writes_empty_tables(spark, scratch):
    out = os.path.join(scratch, "none")
    posting_flow.run(spark, out, pages=spark.createDataFrame([], PAGES_SCHEMA), run_date="2026-06-13")
    clustered = every_output(spark, out)
    assert clustered.count() == 0 and clustered.columns == list(vocab.CLUSTERED_COLUMNS)
