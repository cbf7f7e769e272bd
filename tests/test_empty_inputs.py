"""Every operator on an empty table: no error, empty or zero results."""

import datetime as dt

import pytest

from posting_analytics.operators import clean, documents, report, tables
from posting_analytics.sources import profile

SCHEMA = ("cluster int, keyword_category string, location string, education_req string, "
          "has_salary int, company_name string")

EMPTY_RESULT = {
    "value_share": lambda e: report.value_share(e, "location"),
    "top_k_with_set": lambda e: report.top_k_with_set(e, "company_name", "location"),
    "group_mode": lambda e: report.group_mode(e, "cluster", "location"),
    "top_n_per_group": lambda e: report.top_n_per_group(e, "cluster", "location"),
    "keep_top_k": lambda e: report.keep_top_k(e, "location"),
    "contingency": lambda e: tables.contingency(e, "cluster", "location", ["Bandung"]),
    "contingency_top_k": lambda e: tables.contingency_top_k(e, "cluster", "location"),
    "binary_split": lambda e: tables.binary_split(e, "cluster", "has_salary"),
    "cluster_summary": lambda e: documents.cluster_summary(e, generated_at=dt.datetime(2026, 1, 1)),
    "top_values_document": lambda e: documents.top_values_document(e),
    "clean_postings": lambda e: clean.clean_postings(e.withColumnRenamed("company_name", "job_title")
                                                     .withColumn("company_name", e["location"])
                                                     .withColumn("job_requirements", e["location"])
                                                     .withColumn("job_responsibilities", e["location"])
                                                     .withColumn("salary_range", e["location"])
                                                     .withColumn("experience_level", e["location"])),
}


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(EMPTY_RESULT))
def test_empty_in_empty_out(empty, name):
    assert EMPTY_RESULT[name](empty).collect() == []


def test_empty_counts_are_zero(empty):
    assert tuple(report.distinct_counts(empty, ["location", "cluster"]).first()) == (0, 0)
    assert all(r["n_rows"] == 0 and r["n_distinct"] == 0 for r in profile.table_profile(empty).collect())
    assert clean.missing_report(empty, ["location"]).first()["pct_missing"] is None
