import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from posting_analytics import vocab
from posting_analytics.operators import documents
from posting_analytics.sources import collections, files, profile


def test_csv_round_trip_with_bom_and_nested(spark, scratch):
    path = os.path.join(scratch, "in.csv")
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        f.write("job_title,company_name\r\nA,B\r\nC,\r\n")
    df = files.read_csv(spark, path)
    assert df.columns == ["job_title", "company_name"]
    assert [tuple(r) for r in df.collect()] == [("A", "B"), ("C", None)]
    nested = df.withColumn("tags", F.array(F.lit("x"), F.lit("y")))
    files.write_csv(nested, os.path.join(scratch, "out_csv"))
    back = files.read_csv(spark, os.path.join(scratch, "out_csv"))
    assert sorted(r["tags"] for r in back.collect()) == ['["x","y"]', '["x","y"]']


def test_json_lines_and_array(spark, scratch):
    df = spark.createDataFrame([(1, "Jakarta/é")], "cluster int, location string")
    files.write_json(df, os.path.join(scratch, "j"))
    assert files.read_json(spark, os.path.join(scratch, "j")).first()["location"] == "Jakarta/é"
    arr = os.path.join(scratch, "arr.json")
    with open(arr, "w", encoding="utf-8") as f:
        f.write('[{"cluster":0,"location":"Jakarta\\/x"},{"cluster":1,"location":"Bandung"}]')
    back = files.read_json(spark, arr, multiline=True)
    assert back.count() == 2 and dict(back.dtypes)["cluster"] == "bigint"


def test_collections_replace_count_and_hide(spark, scratch):
    import datetime as dt
    rows = spark.createDataFrame([(0, "Data", "J", "S1", 1, "A"), (1, "Data", "B", "S1", 0, "C")],
                                 "cluster int, keyword_category string, location string, "
                                 "education_req string, has_salary int, company_name string")
    docs = {"cluster_summary": documents.cluster_summary(rows, generated_at=dt.datetime(2026, 1, 1)),
            "raw_jobs": rows.withColumn("_id", F.monotonically_increasing_id())}
    collections.write_collections(docs, scratch)
    collections.write_collections({"raw_jobs": rows.withColumn("_id", F.lit(1))}, scratch)  # replaced
    counts = {r["collection"]: r["n"] for r in
              collections.count_collections(spark, scratch, ["cluster_summary", "raw_jobs"]).collect()}
    assert counts == {"cluster_summary": 2, "raw_jobs": 2}
    back = files.read_documents(spark, collections.current_path(spark, scratch, "raw_jobs"))
    assert "_id" not in back.columns
    summary = files.read_documents(spark, collections.current_path(spark, scratch, "cluster_summary"))
    assert dict(summary.dtypes)["distribusi_kategori"] == "map<string,bigint>"


def test_table_profile(spark):
    df = spark.createDataFrame([("a", 1), (vocab.NOT_FOUND, None), ("a", 2)], "s string, n int")
    got = {r["column_name"]: tuple(r)[1:] for r in profile.table_profile(df).collect()}
    assert got == {"s": ("string", 3, 0, 1, 2), "n": ("int", 3, 1, 0, 2)}
    assert profile.head(df, 2).count() == 2


def test_register_view(spark):
    df = spark.createDataFrame([(1,)], "x int")
    files.register_view(df, "pa_view_test")
    assert spark.sql("SELECT count(*) AS c FROM pa_view_test").first()["c"] == 1


HARD = ["a\nb", " lead ", "", None, 'say "hi", ok', "a\r\nb\rc", '"', "\\", '\\"x', '""', ",", "\ttab\t", " ", "\n", "#c", "a\\\nb", ' "q" ']


def test_csv_gives_every_value_back(spark, scratch):
    df = spark.createDataFrame(list(enumerate(HARD)), "i int, t string")
    files.write_csv(df, os.path.join(scratch, "hard"))
    back = files.read_csv(spark, os.path.join(scratch, "hard"), df.schema)
    assert {r["i"]: r["t"] for r in back.collect()} == dict(enumerate(HARD)) and back.count() == len(HARD)


def test_csv_of_other_writers(spark, scratch):
    import csv
    path = os.path.join(scratch, "other.csv")
    rows = [["1", 'say ""hi""', "x\ny"], ["2", 'a "quoted", word', ""], ["3", " b ", "z"]]
    with open(path, "w", encoding="utf-8", newline="") as f:
        csv.writer(f).writerows([["i", "t", "u"], *rows])
    got = sorted(tuple(r) for r in files.read_csv(spark, path).collect())
    assert got == [("1", 'say ""hi""', "x\ny"), ("2", 'a "quoted", word', None), ("3", " b ", "z")]


def test_csv_refuses_what_it_cannot_hold(spark, scratch):
    import pytest
    with pytest.raises(ValueError):
        files.write_csv(spark.createDataFrame([(None,)], "t string"), os.path.join(scratch, "one"))


def test_json_arrays_round_trip(spark, scratch):
    df = spark.range(2500).select(F.col("id"), F.concat(F.lit('"x\n'), F.col("id")).alias("t"))
    files.write_json_arrays(df, os.path.join(scratch, "arrays"), F.floor(F.col("id") / 1000))
    back = files.read_json(spark, os.path.join(scratch, "arrays"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert spark.read.text(os.path.join(scratch, "arrays")).count() == 3


def test_checked_csv_splits_rows_and_rejects(spark, scratch):
    path = os.path.join(scratch, "checked.csv")
    bad = ["3", "4,x,1,extra", "five,e,2"]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(["id,name,n", "1,a,7", bad[0], '2,"b, ""c""",', bad[1], bad[2], "6,,0"]) + "\n")
    schema = T._parse_datatype_string("id long, name string, n int")
    rows, rejects = files.read_checked(spark, path, schema)
    assert sorted(map(tuple, rows.collect())) == [(1, "a", 7), (2, 'b, "c"', None), (6, None, 0)]
    got = rejects.collect()
    assert sorted(r["raw"] for r in got) == sorted(bad) and all(r["file"].endswith("checked.csv") for r in got)
    assert rows.count() == 3 and rejects.count() == 3
    assert sorted(r["id"] for r in rows.select("id").collect()) == [1, 2, 6]


def test_checked_json_lines(spark, scratch):
    path = os.path.join(scratch, "checked.json")
    bad = ['{"_raw": "y", "n": "no number"}', "{broken"]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(['{"_raw": "x", "n": 1}', *bad, '{"n": 2}']) + "\n")
    rows, rejects = files.read_checked(spark, path, T._parse_datatype_string("_raw string, n int"), "json")
    assert sorted(map(tuple, rows.fillna("").collect())) == [("", 2), ("x", 1)]
    assert sorted(r["raw"] for r in rejects.collect()) == sorted(bad)
