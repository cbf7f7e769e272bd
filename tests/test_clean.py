import pytest
from pyspark.sql import functions as F

from posting_analytics import vocab
from posting_analytics.operators import clean

CLEAN_COLS = "job_title string, company_name string, location string, education_req string, " \
             "salary_range string, job_requirements string, job_responsibilities string"


def test_cleaning_order_fill_before_filter(spark):
    rows = [
        ("A", "B", None, None, "Rp. 1", "SQL", "x"),               # kept, fills applied
        (None, "B", "J", "S1", "Rp. 1", "SQL", "x"),               # NULL title: dropped
        ("A", "B", "J", "S1", None, "SQL", "x"),                   # salary filled then dropped
        ("A", "B", vocab.NOT_FOUND, "S1", "Rp. 1", "SQL", "x"),    # location sentinel: dropped
        ("A", vocab.NOT_FOUND, "J", "S1", "Rp. 1", "SQL", "x"),    # company sentinel: dropped
        ("A", "B", "J", "S1", "Rp. 1", vocab.NOT_FOUND, "x"),      # requirements missing: dropped
    ]
    df = spark.createDataFrame(rows, CLEAN_COLS)
    with pytest.raises(ValueError, match="experience_level"):
        clean.clean_postings(df)
    out = clean.clean_postings(df.withColumn("experience_level", F.lit("1 tahun"))).collect()
    assert len(out) == 1
    r = out[0]
    assert r["location"] == vocab.UNKNOWN
    assert r["education_req"] == vocab.NOT_STATED
    assert r["keyword_category"] == "IT Umum"


def test_optional_salary_filter(spark):
    rows = [("Data A", "B", "J", "S1", vocab.NOT_STATED, "SQL", "x")]
    df = spark.createDataFrame(rows, CLEAN_COLS).withColumn("experience_level", F.lit(None).cast("string"))
    assert clean.clean_postings(df).count() == 0
    assert clean.clean_postings(df, require_salary=False).count() == 1


def test_replace_and_any_present(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "a")], "p string, q string")
    assert [r["p"] for r in clean.replace_value(df, "a", "z", ["p"]).collect()] == ["z", "b", "z"]
    nulled = clean.replace_with_null(df, "a", ["p", "q"])
    assert [tuple(r) for r in nulled.collect()] == [(None, "x"), ("b", "y"), (None, None)]
    assert clean.any_present(nulled, ["p", "q"]).count() == 2


def test_missing_report(spark):
    df = spark.createDataFrame([(None, "x"), ("a", None), (None, None)], "p string, q string")
    got = {r["column_name"]: (r["n_missing"], r["n_rows"], r["pct_missing"])
           for r in clean.missing_report(df, ["p", "q"]).collect()}
    assert got == {"p": (2, 3, 66.67), "q": (2, 3, 66.67)}
    empty = spark.createDataFrame([], "p string")
    assert clean.missing_report(empty, ["p"]).first()["pct_missing"] is None


def test_add_metadata_and_flag(spark):
    df = spark.createDataFrame([(vocab.NOT_STATED,), ("Rp. 1",)], "salary_range string")
    out = clean.add_metadata(clean.add_presence_flag(df), {"source": "s"}).collect()
    assert [(r["has_salary"], r["source"]) for r in out] == [(0, "s"), (1, "s")]
