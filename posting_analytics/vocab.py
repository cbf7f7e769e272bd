"""Fixed values of the posting data model.

Everything in this module is a value that must stay equal to the original
posting pipeline for results to agree: sentinel strings, ordered keyword
lists, patterns and output formats.  Operators take each of them as a
parameter; these are only the defaults.
"""

from __future__ import annotations

# --- fixed values: sentinel vocabulary -------------------------------------
NOT_FOUND = "Tidak ditemukan"      # field not found on the page
NOT_STATED = "Tidak disebutkan"    # value not stated (salary, education)
UNKNOWN = "Tidak diketahui"        # location unknown after cleaning

# --- fixed values: extraction dictionaries (list order is significant) -----
CITIES = [
    "jakarta",
    "bandung",
    "surabaya",
    "remote",
    "medan",
    "semarang",
    "yogyakarta",
    "malang",
    "bali",
]

SKILLS = [
    "Python",
    "SQL",
    "Excel",
    "Java",
    "JavaScript",
    "HTML",
    "CSS",
    "React",
    "Vue",
    "Angular",
    "Laravel",
    "PHP",
    "Node.js",
    "Spring Boot",
    "Machine Learning",
    "Deep Learning",
    "TensorFlow",
    "PyTorch",
    "Power BI",
    "Tableau",
    "Data Analysis",
    "Data Visualization",
    "Git",
    "Docker",
    "AWS",
    "Azure",
    "Linux",
    "MySQL",
    "PostgreSQL",
    "MongoDB",
]
MAX_SKILLS = 5

RESPONSIBILITIES = [
    ("frontend", "Mengembangkan tampilan frontend"),
    ("backend", "Mengembangkan sistem backend"),
    ("full stack", "Mengembangkan aplikasi full stack"),
    ("machine learning", "Membangun model machine learning"),
    ("data analyst", "Menganalisis data perusahaan"),
    ("data scientist", "Mengembangkan solusi berbasis data"),
    ("dashboard", "Membuat dashboard dan visualisasi data"),
    ("report", "Menyusun laporan dan insight data"),
    ("testing", "Melakukan pengujian sistem"),
    ("quality assurance", "Menjamin kualitas perangkat lunak"),
    ("api", "Mengembangkan dan mengelola API"),
    ("database", "Mengelola database perusahaan"),
    ("security", "Menjaga keamanan sistem informasi"),
]

# keyword category of a job title: first substring hit wins, else the default
CATEGORY_RULES = [
    ("data", "Data"),
    ("software", "Software"),
    ("analyst", "Analyst"),
    ("engineer", "Engineer"),
]
CATEGORY_DEFAULT = "IT Umum"

# --- fixed values: patterns and formats ------------------------------------
# Python's str whitespace set (what `\s` means in the original code), spelled
# out so the JVM regex engine and RE2 agree on it.
WS = (
    r"[\t\n\x0B\f\r \x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
EXPERIENCE_PATTERN = r"[0-9]+\+?" + WS + r"*tahun"          # on lower-cased text
EDUCATION_PATTERN = r"S[123]|D[1234]|SMA|SMK|Bachelor"      # case-sensitive
SALARY_PATTERN = r"(?i)Rp" + WS + r"*[0-9.]+(?:,[0-9]+)?"
SALARY_MIN_DIGITS = 6
MONEY_PREFIX = "Rp. "
THOUSANDS_SEP = "."
AMOUNT_RANGE_SEP = " - "

FULL_TIME_PHRASE = "full time"
FULL_TIME_LABEL = "Full-time"

COMPANY_LINK_SUBSTRING = "/companies/"
JOB_LINK_SUBSTRING = "/opportunities/jobs/"
SITE_ROOT = "https://glints.com"
SOURCE_PLATFORM = "Glints"
DOCUMENT_SOURCE = "Glints.com"
LINK_TARGET = 160
POSTED_DATE_FORMAT = "yyyy-MM-dd"

# salary status labels of the salary-availability report
SALARY_STATED_LABEL = "Gaji Dicantumkan"
SALARY_NOT_STATED_LABEL = "Gaji Tidak Dicantumkan"

# fill values applied before the completeness filters
FILL_DEFAULTS = {
    "location": UNKNOWN,
    "salary_range": NOT_STATED,
    "experience_level": NOT_STATED,
    "education_req": NOT_STATED,
}

# --- fixed values: column layouts ------------------------------------------
POSTING_COLUMNS = [
    "job_title",
    "company_name",
    "location",
    "job_type",
    "experience_level",
    "education_req",
    "salary_range",
    "job_requirements",
    "job_responsibilities",
    "posted_date",
    "source_platform",
]

CLUSTERED_COLUMNS = [
    "job_title",
    "company_name",
    "location",
    "keyword_category",
    "education_req",
    "salary_range",
    "has_salary",
    "cluster",
]
