"""Small inline inputs shared by the tests."""

FULL_PAGE = (
    '<!DOCTYPE html><html><head><title>x</title><style>.a{color:red}</style>'
    '<script>var s="Python Jakarta";</script></head><body><!-- comment Bandung -->'
    '<h1 class="t">Senior <b>Data</b>\n Engineer &amp; Analyst</h1>'
    '<a class="c" href="/companies/acme-1">PT Acme &amp; Co</a>'
    '<a href="/opportunities/jobs/111">Job 1</a><a href="/opportunities/jobs/222">Job 2</a>'
    '<p>Lokasi: Bandung, Jakarta. Full Time. Pengalaman 3 tahun. Pendidikan S1 Informatika.\n'
    'Gaji Rp 7.000.000 - Rp 9.500.000 per bulan. Skills: SQL, Python, Docker, Git, Tableau, '
    'Excel.</p><p>Membuat dashboard dan report.</p></body></html>'
)
EMPTY_PAGE = "<html><body><p>Nothing here.</p></body></html>"
DUP_LINK_PAGE = '<html><body><a href="/opportunities/jobs/111">again</a><a href="/about">x</a></body></html>'

PAGES = [
    (1, "https://site/1", FULL_PAGE),
    (2, "https://site/2", EMPTY_PAGE),
    (3, "https://site/3", None),
    (4, "https://site/4", DUP_LINK_PAGE),
]
PAGES_SCHEMA = "page_id long, url string, html string"

SALARY_CASES = [
    ("Gaji Rp 7.500.000,00 per bulan", "Rp. 750.000.000"),
    ("Rp. 5.000.000", "Tidak disebutkan"),
    ("Rp5.000.000 - Rp8.000.000", "Rp. 5.000.000 - Rp. 8.000.000"),
    ("Rp 5.000.000 - 8.000.000", "Rp. 5.000.000"),
    ("Rp 5jt", "Tidak disebutkan"),
    ("Corp 1234567", "Rp. 1.234.567"),
    ("tidak ada", "Tidak disebutkan"),
    ("rp 9.000.000 Rp 10.000.000 Rp 9.000.000", "Rp. 9.000.000 - Rp. 10.000.000"),
    ("Rp 123.456.789.012.345.678.901", "Rp. 123.456.789.012.345.678.901"),
]
