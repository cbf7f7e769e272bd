"""Pages table -> posting rows (E13-E17) and link discovery.

The input is any table with an HTML column.  Extraction is one projection
(no shuffle), so it scales with the number of executors; only link discovery
shuffles, for its ``distinct``.  Read small page tables through
``partitioning.spread`` so the regex work uses every core.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import match, money, text
from ..functions._util import as_col, require_columns


def posting_columns(page_text, html, *,
                    cities: Sequence[str] = vocab.CITIES,
                    skills: Sequence[str] = vocab.SKILLS,
                    responsibilities=vocab.RESPONSIBILITIES,
                    company_href: str = vocab.COMPANY_LINK_SUBSTRING,
                    run_date: str | _dt.date | None = None,
                    source_platform: str = vocab.SOURCE_PLATFORM,
                    title_tag: str = "h1",
                    full_time_phrase: str = vocab.FULL_TIME_PHRASE,
                    experience_pattern: str = vocab.EXPERIENCE_PATTERN,
                    education_pattern: str = vocab.EDUCATION_PATTERN,
                    salary_pattern: str = vocab.SALARY_PATTERN,
                    drop_fraction: bool = False,
                    max_skills: int = vocab.MAX_SKILLS,
                    whole_word: bool = False) -> dict:
    """E3-E13 as a name -> Column mapping over a page-text and an HTML column.

    Every dictionary and pattern is a parameter; the defaults are the fixed
    values of the original extraction.  ``run_date`` is the crawl date
    (today when not given).
    """
    run_date = run_date or _dt.date.today()
    return {
        "job_title": text.first_tag_text(html, title_tag),
        "company_name": text.anchor_text(html, company_href),
        "location": match.ordered_label(page_text, [(c, c.title()) for c in cities],
                                        vocab.NOT_FOUND, whole_word),
        "job_type": match.phrase_flag(page_text, full_time_phrase),
        "experience_level": match.regex_first(page_text, experience_pattern, lower=True),
        "education_req": match.regex_first(page_text, education_pattern),
        "salary_range": money.amount_range(page_text, salary_pattern, drop_fraction=drop_fraction),
        "job_requirements": match.keyword_tags(page_text, skills, max_skills, whole_word=whole_word),
        "job_responsibilities": match.ordered_label(page_text, responsibilities, vocab.NOT_FOUND,
                                                    whole_word),
        "posted_date": F.date_format(F.lit(str(run_date)).cast("date"), vocab.POSTED_DATE_FORMAT),
        "source_platform": F.lit(source_platform),
    }


def _no_html(html) -> Column:
    return html.isNull() | (F.length(html) == 0)


def extract_postings(pages: DataFrame, html_col: str = "html", *,
                     keep: Sequence[str] = ("page_id", "url"),
                     with_errors: bool = False, **params) -> DataFrame:
    """One posting row of the 11 fixed columns per page.

    ``keep`` columns of the input are carried in front (an unknown name is an
    error).  Pages without HTML are rejected records (E16): with
    ``with_errors`` they stay, flagged by a ``parse_error`` column; otherwise
    they are left to ``rejected_pages``.
    """
    kept = require_columns(pages, keep)
    html = as_col(html_col)
    staged = pages.select(*kept, html.alias("_html"),
                          text.html_to_text(html).alias("_page_text"))
    cols = posting_columns(F.col("_page_text"), F.col("_html"), **params)
    out = staged.select(*kept, *[c.alias(n) for n, c in cols.items()],
                        _no_html(F.col("_html")).alias("parse_error"))
    if with_errors:
        return out
    return out.filter(~F.col("parse_error")).drop("parse_error")


#: Why a page gives no posting row.
NO_HTML_REASON = "no html"


def rejected_pages(pages: DataFrame, html_col: str = "html", *,
                   keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """The pages that give no posting row, with the ``reason``."""
    kept = require_columns(pages, keep)
    return pages.filter(_no_html(as_col(html_col))).select(
        *kept, F.lit(NO_HTML_REASON).alias("reason"))


def discover_links(pages: DataFrame, html_col: str = "html",
                   href_substring: str = vocab.JOB_LINK_SUBSTRING,
                   root: str = vocab.SITE_ROOT) -> DataFrame:
    """Distinct absolute links (``url``) whose href contains a substring."""
    href = F.explode(text.hrefs(html_col)).alias("href")
    return (pages.select(href)
            .filter(F.col("href").contains(F.lit(href_substring)))
            .select(F.concat(F.lit(root), F.col("href")).alias("url"))
            .distinct())


def cap_links(links: DataFrame, n: int = vocab.LINK_TARGET, order_col: str = "url") -> DataFrame:
    """The first ``n`` links in ``order_col`` order (a top-n, deterministic)."""
    return links.orderBy(order_col).limit(n)


def safe_number(c, pattern: str = r"[0-9]{6,}") -> tuple:
    """First ``pattern`` match cast to bigint with ``try_cast``.

    Returns ``(value, parse_error)``: ``parse_error`` is 1 when a match exists
    but does not fit the type, so bad records are kept and flagged.
    """
    hit = F.nullif(F.regexp_extract(as_col(c), pattern, 0), F.lit(""))
    value = hit.try_cast("bigint")
    err = F.when(hit.isNotNull() & value.isNull(), F.lit(1)).otherwise(F.lit(0))
    return value, err
