"""Parallelism and single evaluation of CPU-heavy row-wise steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Deal the rows of an input round-robin over ``partitions``.

    Regex extraction over pages costs CPU per row, and an input stored as a few
    large row groups would run in a few tasks.  A large input already arrives
    in many scan partitions (set ``spark.sql.files.maxPartitionBytes``) and
    needs no such shuffle, so the choice is the caller's.  A stream is
    partitioned by its source and returned as it is.
    """
    return df if df.isStreaming else df.repartition(partitions)


def compute_once(df: DataFrame) -> DataFrame:
    """The same rows, behind a point that filters are not pushed through.

    A filter on computed columns is otherwise pushed below them with a copy of
    their expressions for each use: a page's text would be extracted once per
    filtered field and again for the rows kept.  Each row passes through a
    one-element ``inline``, a narrow step; no shuffle, no write.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
