import datetime as dt

import pytest
from pyspark.sql import functions as F

from posting_analytics.operators import documents, report, tables

ROWS = [
    (0, "Software", "Jakarta", "S1", 1, "PT A"),
    (0, "Software", "Jakarta", "S1", 1, "PT A"),
    (0, "Data", "Bandung", "S1", 0, "PT B"),
    (1, "Analyst", "Surabaya", "D1", 1, "PT C"),
    (1, "Analyst", "Jakarta", "D1", 1, "PT C"),
    (1, "IT Umum", "Medan", "SMA", 0, "PT D"),
    (1, "Analyst", "Remote", "D1", 1, "PT E"),
]
SCHEMA = ("cluster int, keyword_category string, location string, education_req string, "
          "has_salary int, company_name string")
TS = dt.datetime(2026, 6, 13, 8, 0, 0)


def test_contingency_zero_filled(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = {r["cluster"]: r.asDict() for r in tables.contingency(df, "cluster", "keyword_category",
                                                             ["Analyst", "Data", "IT Umum", "Software"]).collect()}
    assert out[0] == {"cluster": 0, "Analyst": 0, "Data": 1, "IT Umum": 0, "Software": 2}
    assert out[1]["Analyst"] == 3 and out[1]["Software"] == 0


def test_contingency_top_k(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = tables.contingency_top_k(df, "cluster", "location", 2)
    # top 2 locations: Jakarta (3), then Bandung (1, smallest of the ties)
    assert out.columns == ["cluster", "rank", "location", "n"]
    assert {(r["rank"], r["location"]) for r in out.collect()} == {(1, "Jakarta"), (2, "Bandung")}
    for r in out.collect():
        assert r["n"] == df.filter((F.col("cluster") == r["cluster"]) & (F.col("location") == r["location"])).count()


def test_contingency_top_k_ignores_null(spark):
    rows = [("g", None)] * 10 + [("g", "a"), ("h", "a"), ("g", "b"), ("g", "c")]
    out = tables.contingency_top_k(spark.createDataFrame(rows, "r string, v string"), "r", "v", 2)
    assert [tuple(r) for r in out.collect()] == [("g", 1, "a", 1), ("g", 2, "b", 1), ("h", 1, "a", 1), ("h", 2, "b", 0)]


@pytest.mark.parametrize("kind", ["boolean", "double", "int", "decimal(3,1)"])
def test_flag_percentages_by_type(spark, kind):
    df = spark.createDataFrame([(0, 1), (0, 0), (1, None), (1, 1), (1, 1), (1, 0)], "cluster int, f int")
    df = df.select("cluster", F.col("f").cast(kind).alias("has_salary"), F.lit("x").alias("keyword_category"),
                   F.lit("y").alias("location"), F.lit(None).cast("string").alias("education_req"))
    got = {r["cluster_id"]: r for r in documents.cluster_summary(df, generated_at=TS).collect()}
    assert got[0]["pct_gaji_dicantumkan"] == 50.0 and got[1]["pct_gaji_dicantumkan"] == 66.7
    assert got[0]["pendidikan_dominan"] is None and got[1]["total_lowongan"] == 4
    assert {r["cluster"]: r["pct"] for r in report.mean_percent(df, "cluster", "has_salary").collect()} == {0: 50.0, 1: 66.7}
    assert {r["cluster"]: r["pct"] for r in report.flag_rate(df, "cluster", "has_salary").collect()} == {0: 50.0, 1: 50.0}


def test_binary_split_and_offsets(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    split = {(r["cluster"], r["answer"]): (r["n"], r["pct"])
             for r in tables.binary_split(df, "cluster", "has_salary").collect()}
    assert split[(1, "yes")] == (3, 75.0) and split[(1, "no")] == (1, 25.0)
    counts = report.pair_counts(df, "cluster", "keyword_category", order=False)
    offs = {(r["cluster"], r["keyword_category"]): r["offset"]
            for r in tables.stack_offsets(counts, "cluster", "keyword_category").collect()}
    assert offs == {(0, "Data"): 0, (0, "Software"): 1, (1, "Analyst"): 0, (1, "IT Umum"): 3}


def test_cluster_summary_document(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    docs = {r["cluster_id"]: r for r in documents.cluster_summary(df, generated_at=TS).collect()}
    c1 = docs[1]
    assert c1["total_lowongan"] == 4
    assert (c1["kategori_dominan"], c1["lokasi_dominan"], c1["pendidikan_dominan"]) == \
        ("Analyst", "Jakarta", "D1")
    assert c1["pct_gaji_dicantumkan"] == 75.0
    assert c1["distribusi_kategori"] == {"Analyst": 3, "IT Umum": 1}
    assert c1["distribusi_lokasi"] == {"Jakarta": 1, "Medan": 1, "Remote": 1, "Surabaya": 1}
    text = {r["cluster_id"]: r["t"] for r in documents.cluster_summary(df, generated_at=TS).select(
        "cluster_id", report.map_text(F.col("distribusi_lokasi")).alias("t")).collect()}
    assert text[1] == "Jakarta:1, Medan:1, Remote:1, Surabaya:1"
    assert c1["generated_at"] == TS
    assert docs[0]["lokasi_dominan"] == "Jakarta"


def test_cluster_summary_top_location_cut(spark):
    rows = [(0, "c", f"L{i}", "S1", 1, "x") for i in range(9)] + [(0, "c", "L8", "S1", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    doc = documents.cluster_summary(df, top_locations=5, generated_at=TS).select(
        report.map_text(F.col("distribusi_lokasi")).alias("t")).first()
    assert doc["t"] == "L8:2, L0:1, L1:1, L2:1, L3:1"


def test_top_values_document(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    docs = {r["cluster_id"]: r["t"] for r in documents.top_values_document(df, n=2, generated_at=TS)
            .select("cluster_id", report.map_text(F.col("top_companies")).alias("t")).collect()}
    assert docs == {0: "PT A:2, PT B:1", 1: "PT C:2, PT D:1"}


def test_cluster_summary_category_cut(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    text = {r["cluster_id"]: r["t"] for r in documents.cluster_summary(df, top_categories=1, generated_at=TS)
            .select("cluster_id", report.map_text(F.col("distribusi_kategori")).alias("t")).collect()}
    assert text == {0: "Software:2", 1: "Analyst:3"}
