import os

from fixtures import PAGES, PAGES_SCHEMA
from posting_analytics.plans import driver_queries
from posting_analytics.streaming import postings_stream as S

SF = "/root/testdata/sf0.001"


def test_stream_extracts_same_rows_as_batch(spark, scratch):
    src = os.path.join(scratch, "pages")
    spark.createDataFrame(PAGES, PAGES_SCHEMA).write.parquet(src)
    q = S.start_postings_stream(spark, src, os.path.join(scratch, "out"),
                                checkpoint=os.path.join(scratch, "ckpt"), cleaned=False,
                                run_date="2026-06-13")
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(scratch, "out"))
    assert sorted(r["page_id"] for r in out.collect()) == [1, 2, 4]
    full = out.filter("page_id = 1").first()
    assert full["job_title"] == "Senior Data Engineer & Analyst"


def test_stream_memory_sink_cleaned(spark, scratch):
    src = os.path.join(scratch, "pages2")
    spark.createDataFrame(PAGES, PAGES_SCHEMA).write.parquet(src)
    rows = S.postings_stream(S.read_pages_stream(spark, src), run_date="2026-06-13")
    q = rows.writeStream.format("memory").queryName("pa_stream_test").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM pa_stream_test").collect()
    assert len(got) == 1 and got[0]["keyword_category"] == "Data"


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["category", "n", "pct"] and len(rows) > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    rows_only = set(driver_queries.QUERIES) - set(sql)
    # iterative fits on the embeddings; the same operators have oracles on grouped data
    assert rows_only == {"elbow", "kmeans_assign", "cluster_quality", "pca_scores", "pca_variance"}


def test_default_restart_reads_only_what_came_meanwhile(spark, scratch):
    src, out = os.path.join(scratch, "pages4"), os.path.join(scratch, "out4")
    for batch in (1, 2):
        rows = [(100 * batch + pid, url, html) for pid, url, html in PAGES]
        spark.createDataFrame(rows, PAGES_SCHEMA).write.parquet(os.path.join(src, f"batch={batch}"))
        S.start_postings_stream(spark, src, out, cleaned=False, max_files_per_trigger=1,
                                run_date="2026-06-13").awaitTermination(120)
        S.start_rejects_stream(spark, src, out + "-rejects").awaitTermination(120)
        assert spark.read.parquet(out).count() == 3 * batch
        assert spark.read.parquet(out + "-rejects").count() == (len(PAGES) - 3) * batch


def test_stream_restart_processes_only_new_files(spark, scratch):
    src = os.path.join(scratch, "pages3")
    out = os.path.join(scratch, "out3")
    ckpt = os.path.join(scratch, "ckpt3")
    spark.createDataFrame(PAGES[:2], PAGES_SCHEMA).write.parquet(os.path.join(src, "batch=1"))
    S.start_postings_stream(spark, src, out, checkpoint=ckpt, cleaned=False,
                            run_date="2026-06-13").awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    more = [(10 + pid, url, html) for pid, url, html in PAGES]
    spark.createDataFrame(more, PAGES_SCHEMA).write.parquet(os.path.join(src, "batch=2"))
    S.start_postings_stream(spark, src, out, checkpoint=ckpt, cleaned=False,
                            run_date="2026-06-13").awaitTermination(120)
    ids = sorted(r["page_id"] for r in spark.read.parquet(out).collect())
    assert ids == [1, 2, 11, 12, 14]      # page 13 has no HTML; nothing is processed twice


def test_stream_max_files_per_trigger(spark, scratch):
    src = os.path.join(scratch, "pages4")
    for i, part in enumerate((PAGES[:2], PAGES[2:])):
        spark.createDataFrame(part, PAGES_SCHEMA).write.parquet(os.path.join(src, f"batch={i}"))
    rows = S.postings_stream(S.read_pages_stream(spark, src, max_files_per_trigger=1),
                             cleaned=False, run_date="2026-06-13")
    q = rows.writeStream.format("memory").queryName("pa_stream_batches").start()
    q.processAllAvailable()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    q.stop()
    assert len(batches) >= 2
    assert sorted(r["page_id"] for r in spark.sql("SELECT page_id FROM pa_stream_batches").collect()) == [1, 2, 4]
