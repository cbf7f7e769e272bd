"""Table profile (S11, A16): schema, row count and per-column quality counts."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab

DEFAULT_SENTINELS = (vocab.NOT_FOUND, vocab.NOT_STATED, vocab.UNKNOWN)


def _column_profile(df: DataFrame, name: str, data_type: str, sentinels: Sequence[str],
                    approx: bool) -> DataFrame:
    c = F.col(f"`{name}`")
    is_sentinel = c.cast("string").isin(*sentinels) if sentinels else F.lit(False)
    if approx:
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("n_null"),
                      F.count_if(is_sentinel).alias("n_sentinel"),
                      F.approx_count_distinct(c).alias("n_distinct"))
    # one row per distinct value (with its count), then one row for the column
    per_value = df.groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("cnt"))
    v, cnt = F.col("v"), F.col("cnt")
    v_sentinel = v.cast("string").isin(*sentinels) if sentinels else F.lit(False)
    return per_value.agg(
        F.coalesce(F.sum(cnt), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(v.isNull(), cnt)), F.lit(0)).cast("bigint").alias("n_null"),
        F.coalesce(F.sum(F.when(v_sentinel, cnt)), F.lit(0)).cast("bigint").alias("n_sentinel"),
        F.count(v).alias("n_distinct"))


def table_profile(df: DataFrame, sentinels: Sequence[str] = DEFAULT_SENTINELS,
                  approx: bool = False) -> DataFrame:
    """One row per column: ``(column_name, data_type, n_rows, n_null,
    n_sentinel, n_distinct)``.

    Each column is profiled by its own branch of one union: the branch reads
    only that column (column pruning), counts its distinct values with a
    map-side partial aggregation and reduces them to one row.  This avoids the
    row expansion that several ``count(DISTINCT ..)`` in one aggregation
    cause (every row copied once per column).  On a columnar source the
    branches together read each column once; a row-format source (CSV, JSON)
    is read once per column, so profile a written or cached copy of it, or use
    ``approx``.
    """
    parts = [_column_profile(df, f.name, f.dataType.simpleString(), sentinels, approx)
             .select(F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     "n_rows", "n_null", "n_sentinel", "n_distinct")
             for f in df.schema.fields]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """T4: the first ``n`` rows (as shown by a preview)."""
    return df.limit(n)
