"""Cleaning operators (C1-C9, C11): filters, fills, replacements, derived columns.

Every filter is one native predicate, so Catalyst merges the chain into a
single ``Filter`` and pushes the null/equality parts into the Parquet scan.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import match
from ..functions._util import require_columns
from ..functions.numeric import percent


def require_present(df: DataFrame, cols: Sequence[str] = ("job_title", "company_name"),
                    sentinel: str = vocab.NOT_FOUND) -> DataFrame:
    """Keep rows where every column differs from the sentinel (NULL fails)."""
    cond = functools.reduce(lambda a, b: a & b, [F.col(c) != F.lit(sentinel) for c in cols])
    return df.filter(cond)


def fill_missing(df: DataFrame, values: Mapping[str, str] = vocab.FILL_DEFAULTS) -> DataFrame:
    """Per-column NULL fill (an unknown column is an error)."""
    require_columns(df, values)
    return df.na.fill(dict(values)) if values else df


def require_complete(df: DataFrame, sentinels: Mapping[str, str]) -> DataFrame:
    """Keep rows where each column is non-NULL and differs from its sentinel."""
    conds = [F.col(c).isNotNull() & (F.col(c) != F.lit(s)) for c, s in sentinels.items()]
    return df.filter(functools.reduce(lambda a, b: a & b, conds))


POSTING_COMPLETENESS = {
    "job_requirements": vocab.NOT_FOUND,
    "job_responsibilities": vocab.NOT_FOUND,
    "salary_range": vocab.NOT_STATED,
    "location": vocab.NOT_FOUND,
}


def replace_value(df: DataFrame, old: str, new: str, subset: Sequence[str]) -> DataFrame:
    """C4: replace one value by another in the chosen columns."""
    return df.na.replace(old, new, subset=list(subset))


def replace_with_null(df: DataFrame, value: str, subset: Sequence[str]) -> DataFrame:
    """Replace one value by NULL in the chosen columns."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(value)) for c in subset})


def any_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where at least one of the columns is non-NULL."""
    return df.filter(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def missing_report(df: DataFrame, cols: Sequence[str], scale: int = 2) -> DataFrame:
    """NULL count and NULL share (% of rows) per column, one aggregation.

    Returns ``(column_name, n_missing, n_rows, pct_missing)``; the share is
    NULL for an empty table instead of a division error.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("n_missing"))
               for i, c in enumerate(cols)]
    long = wide.select("n_rows", F.explode(F.array(*entries)).alias("_m"))
    return long.select("_m.column_name", "_m.n_missing", "n_rows",
                       percent(F.col("_m.n_missing"), F.col("n_rows"), scale).alias("pct_missing"))


def add_category(df: DataFrame, source: str = "job_title", out: str = "keyword_category",
                 rules=vocab.CATEGORY_RULES, default: str = vocab.CATEGORY_DEFAULT) -> DataFrame:
    """Ordered keyword category of a text column."""
    return df.withColumn(out, match.category(source, rules, default))


def add_presence_flag(df: DataFrame, source: str = "salary_range", out: str = "has_salary",
                      sentinel: str = vocab.NOT_STATED) -> DataFrame:
    """0/1 flag, 1 when the value is present and not the sentinel."""
    return df.withColumn(out, match.presence_flag(source, sentinel))


def add_metadata(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """C11: constant metadata columns (e.g. a run timestamp and a source)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def clean_postings(raw: DataFrame, *, require_salary: bool = True) -> DataFrame:
    """The default cleaning chain: C1 -> C2 -> C3 -> C8.

    Fill happens before the completeness filters, so an empty location becomes
    'unknown' and survives while an empty salary becomes 'not stated' and is
    dropped.
    """
    df = require_present(raw)
    df = fill_missing(df)
    checks = dict(POSTING_COMPLETENESS)
    if not require_salary:
        checks.pop("salary_range")
    df = require_complete(df, checks)
    return add_category(df)
