import pytest
from pyspark.sql import functions as F

from fixtures import SALARY_CASES
from posting_analytics import vocab
from posting_analytics.functions import match, money, numeric, text


def one(spark, col, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("out")).first()["out"]


@pytest.mark.parametrize("raw,want", SALARY_CASES)
def test_amount_range_fixtures(spark, raw, want):
    assert one(spark, money.amount_range("t"), raw) == want


def test_amount_range_any_length_orders_by_value(spark):
    raw = "Rp 9.999.999 Rp 10.000.000.000.000.000.000.000.000 Rp 0001234567"
    assert one(spark, money.amount_range("t"), raw) == \
        "Rp. 1.234.567 - Rp. 10.000.000.000.000.000.000.000.000"


def test_amount_range_null_text(spark):
    assert one(spark, money.amount_range("t"), None) == vocab.NOT_STATED


@pytest.mark.parametrize("raw,want", [
    ("5000000", "Rp. 5.000.000"), ("IDR 1,234", "Rp. 1.234"), ("no digits", "no digits"),
    ("000", "Rp. 0"), ("12", "Rp. 12"), ("1234", "Rp. 1.234"),
])
def test_money_format(spark, raw, want):
    assert one(spark, money.money_format("t"), raw) == want


@pytest.mark.parametrize("raw,want", [
    ("  a \t b\n\nc  ", "a b c"), (None, ""), ("", ""), ("x  y", "x y"),
    ("\x0bz\x0b", "z"),
])
def test_normalize_ws(spark, raw, want):
    assert one(spark, text.normalize_ws("t"), raw) == want


def test_html_to_text_drops_script_style_comment(spark):
    html = ('<!DOCTYPE html><html><head><style>p{}</style><script>var t="</p>";</script></head>'
            '<body><!-- hidden --><p>Hello&nbsp;<b>big</b>world &amp;&amp; more</p>a < b</body></html>')
    assert one(spark, text.html_to_text("t"), html) == "Hello big world && more a < b"


def test_first_tag_text_inner_tags_without_space(spark):
    html = '<div><h1 id="x">Data <i>Sci</i>entist &amp; ML</h1><h1>second</h1></div>'
    assert one(spark, text.first_tag_text("t", "h1"), html) == "Data Scientist & ML"
    assert one(spark, text.first_tag_text("t", "h1"), "<p>none</p>") == vocab.NOT_FOUND
    assert one(spark, text.first_tag_text("t", "h1"), "<h1></h1>") == ""
    assert one(spark, text.first_tag_text("t", "h1"), "<h10>x</h10>") == vocab.NOT_FOUND


def test_anchor_text_by_href_substring(spark):
    html = '<a href="/x">no</a><a class="c" href="/companies/pt-a">PT <b>A</b></a>'
    assert one(spark, text.anchor_text("t", "/companies/"), html) == "PT A"
    assert one(spark, text.anchor_text("t", "/jobs/"), html) == vocab.NOT_FOUND


def test_first_listed_list_order_beats_text_order(spark):
    assert one(spark, match.first_listed("t"), "Kantor di Bandung atau JAKARTA") == "Jakarta"
    assert one(spark, match.first_listed("t"), "Lokasi Yogyakarta") == "Yogyakarta"
    assert one(spark, match.first_listed("t"), "nowhere") == vocab.NOT_FOUND


def test_phrase_flag(spark):
    assert one(spark, match.phrase_flag("t"), "Full Time role") == "Full-time"
    assert one(spark, match.phrase_flag("t"), "Full-time role") == vocab.NOT_FOUND


def test_regex_first_experience_and_education(spark):
    assert one(spark, match.regex_first("t", vocab.EXPERIENCE_PATTERN, lower=True),
               "Min 3+ TAHUN dan 5 tahun") == "3+ tahun"
    assert one(spark, match.regex_first("t", vocab.EDUCATION_PATTERN), "Lulusan SMK / D3") == "SMK"
    assert one(spark, match.regex_first("t", vocab.EDUCATION_PATTERN), "s1 only") == vocab.NOT_FOUND


def test_keyword_tags_first_five_in_list_order(spark):
    t = "We use Docker, Git, SQL, Python, Excel, Tableau and JavaScript"
    # substring semantics: "Java" is found inside "JavaScript"
    assert one(spark, match.keyword_tags("t"), t) == "Python, SQL, Excel, Java, JavaScript"
    assert one(spark, match.keyword_tags("t"), "nothing") == vocab.NOT_FOUND
    assert one(spark, match.keyword_tags("t", whole_word=True), t) == \
        "Python, SQL, Excel, JavaScript, Tableau"


def test_ordered_label_first_rule_wins(spark):
    col = match.ordered_label("t", vocab.RESPONSIBILITIES, vocab.NOT_FOUND)
    assert one(spark, col, "Build API and a dashboard") == "Membuat dashboard dan visualisasi data"
    assert one(spark, col, "nothing") == vocab.NOT_FOUND


@pytest.mark.parametrize("title,want", [
    ("Data Software", "Data"), ("Software Analyst", "Software"), ("Analyst Engineer", "Analyst"),
    ("engineer", "Engineer"), ("Drafter", "IT Umum"), (None, "IT Umum"),
])
def test_category(spark, title, want):
    assert one(spark, match.category("t"), title) == want


@pytest.mark.parametrize("value,want", [("Rp. 1", 1), (vocab.NOT_STATED, 0), (None, 0)])
def test_presence_flag(spark, value, want):
    assert one(spark, match.presence_flag("t"), value) == want


@pytest.mark.parametrize("n,t,scale,want", [
    (1, 8000, 2, 0.01), (1, 800, 2, 0.13), (49, 400, 1, 12.3), (55, 69, 2, 79.71),
    (1, 3, 1, 33.3), (2, 3, 1, 66.7), (5, 0, 2, None), (0, 7, 2, 0.0),
])
def test_percent_half_up(spark, n, t, scale, want):
    df = spark.createDataFrame([(n, t)], "n long, t long")
    assert df.select(numeric.percent(F.col("n"), F.col("t"), scale).alias("p")).first()["p"] == want


def test_amount_range_drop_fraction(spark):
    assert one(spark, money.amount_range("t", drop_fraction=True), "Gaji Rp 7.500.000,00") == \
        "Rp. 7.500.000"


@pytest.mark.parametrize("raw,want", [("2026-06-13", "2026-06-13"), ("6/13/2026", "2026-06-13"),
                                      ("13 Juni", None), (None, None)])
def test_parse_date_both_formats(spark, raw, want):
    got = one(spark, text.parse_date("t"), raw)
    assert (str(got) if got is not None else None) == want


@pytest.mark.parametrize("html,want", [
    ("<p>a &nbsp; b</p>", "a b"), ("x&nbsp;&nbsp;y", "x y"), ("&amp;nbsp;", "&nbsp;"),
    ("<b>a</b>\n\n<i>b</i>", "a b"), ("&lt;b&gt;bold&lt;/b&gt;", "<b>bold</b>"), ("", ""),
])
def test_html_to_text_entities_and_spacing(spark, html, want):
    assert one(spark, text.html_to_text("t"), html) == want


@pytest.mark.parametrize("html,want", [
    ("<a href='/companies/x'>PT X</a>", "PT X"),
    ("<A HREF=/companies/y class=c>Y</A>", "Y"),
    ('<a data-href="/companies/z">Z</a>', vocab.NOT_FOUND),
    ('<a class="k"\n href = "/companies/w">W</a>', "W"),
    ('<a href="/Companies/v">V</a>', vocab.NOT_FOUND),
])
def test_anchor_quoting_and_attribute_names(spark, html, want):
    assert one(spark, text.anchor_text("t", "/companies/"), html) == want


def test_hrefs_any_quoting(spark):
    html = """<a href="/a?x=1&amp;y=2">1</a><a href='/b'>2</a><a href=/c>3</a><a data-href="/d">4</a>"""
    assert one(spark, text.hrefs("t"), html) == ["/a?x=1&y=2", "/b", "/c"]
