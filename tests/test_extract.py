from fixtures import PAGES, PAGES_SCHEMA
from posting_analytics import vocab
from posting_analytics.operators import extract


def pages(spark):
    return spark.createDataFrame(PAGES, PAGES_SCHEMA)


def test_extract_postings_full_and_empty_page(spark):
    rows = {r["page_id"]: r for r in
            extract.extract_postings(pages(spark), run_date="2026-06-13").collect()}
    assert set(rows) == {1, 2, 4}          # page 3 has no HTML: rejected
    full = rows[1]
    assert full["job_title"] == "Senior Data Engineer & Analyst"
    assert full["company_name"] == "PT Acme & Co"
    assert full["location"] == "Jakarta"    # list order wins; script/comment text ignored
    assert full["job_type"] == "Full-time"
    assert full["experience_level"] == "3 tahun"
    assert full["education_req"] == "S1"
    assert full["salary_range"] == "Rp. 7.000.000 - Rp. 9.500.000"
    assert full["job_requirements"] == "Python, SQL, Excel, Tableau, Git"
    assert full["job_responsibilities"] == "Membuat dashboard dan visualisasi data"
    assert full["posted_date"] == "2026-06-13"
    assert full["source_platform"] == vocab.SOURCE_PLATFORM
    empty = rows[2]
    for c in ("job_title", "company_name", "location", "job_type", "experience_level",
              "education_req", "job_requirements", "job_responsibilities"):
        assert empty[c] == vocab.NOT_FOUND, c
    assert empty["salary_range"] == vocab.NOT_STATED


def test_extract_postings_column_layout(spark):
    out = extract.extract_postings(pages(spark), run_date="2026-06-13")
    assert out.columns == ["page_id", "url", *vocab.POSTING_COLUMNS]


def test_rejected_pages_flagged(spark):
    out = extract.extract_postings(pages(spark), with_errors=True, run_date="2026-06-13")
    flagged = {r["page_id"] for r in out.filter("parse_error").collect()}
    assert flagged == {3}


def test_discover_links_distinct_and_filtered(spark):
    links = sorted(r["url"] for r in extract.discover_links(pages(spark)).collect())
    assert links == ["https://glints.com/opportunities/jobs/111",
                     "https://glints.com/opportunities/jobs/222"]
    capped = [r["url"] for r in extract.cap_links(extract.discover_links(pages(spark)), 1).collect()]
    assert capped == ["https://glints.com/opportunities/jobs/111"]


def test_safe_number_flags_overflow(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("id 1234567",), ("n 99999999999999999999999",), ("none",)], "t string")
    value, err = extract.safe_number(F.col("t"))
    got = [(r["v"], r["e"]) for r in df.select(value.alias("v"), err.alias("e")).collect()]
    assert got == [(1234567, 0), (None, 1), (None, 0)]


def test_extraction_options(spark):
    html = ("<h1>Dev</h1><p>JavaScript work near Bandungan, Jakarta. Gaji Rp 7.500.000,00. "
            "Minimal 2 years.</p>")
    df = spark.createDataFrame([(1, "u", html)], PAGES_SCHEMA)
    default = extract.extract_postings(df, run_date="2026-06-13").first()
    assert default["job_requirements"] == "Java, JavaScript"     # substring semantics
    assert default["location"] == "Jakarta"
    assert default["salary_range"] == "Rp. 750.000.000"
    opts = extract.extract_postings(df, run_date="2026-06-13", whole_word=True, drop_fraction=True,
                                    cities=["bandung", "jakarta"],
                                    experience_pattern=r"[0-9]+ years").first()
    assert opts["job_requirements"] == "JavaScript"
    assert opts["location"] == "Jakarta"                           # "Bandungan" is not the word
    assert opts["salary_range"] == "Rp. 7.500.000"
    assert opts["experience_level"] == "2 years"
