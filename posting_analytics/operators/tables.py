"""Chart-feeding tables (V1-V4): contingency pivots, yes/no splits, stack offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent
from .report import top_k_values


def contingency(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """V1: ``row x col`` count table over the given ``values``, missing cells 0."""
    return df.groupBy(row).pivot(col, list(values)).count().na.fill(0).orderBy(row)


def contingency_top_k(df: DataFrame, row: str, col: str, k: int = 5,
                      rank_col: str = "rank", count_col: str = "n") -> DataFrame:
    """V2: contingency of ``row`` with the ``k`` most frequent ``col`` values.

    One row per ``(row, value)`` with the value's rank, missing cells 0; NULL
    is not a value.  Every ``row`` of the input that holds one of the values
    appears.  The ranked values (at most ``k`` rows) are broadcast; the counts
    of a row are one aggregation.
    """
    order = Window.orderBy(F.desc("_n"), F.asc(col))  # over k rows
    top = top_k_values(df, col, k, "_n").select(F.col(col).alias("_v"),
                                                F.row_number().over(order).alias(rank_col))
    ranked = df.join(F.broadcast(top), df[col] == top["_v"]).groupBy(row).agg(
        *[F.count_if(F.col(rank_col) == i).alias(f"_{i}") for i in range(1, k + 1)])
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_{i}").alias("n")) for i in range(1, k + 1)])
    long = ranked.select(row, F.explode(cells).alias("_c"))
    return (long.join(F.broadcast(top), F.col("_c.i") == F.col(rank_col))
            .select(row, rank_col, F.col("_v").alias(col), F.col("_c.n").alias(count_col))
            .orderBy(row, rank_col))


def binary_split(df: DataFrame, group: str, flag: str, yes: str = "yes", no: str = "no",
                 answer_col: str = "answer", count_col: str = "n", pct_col: str = "pct",
                 scale: int = 1) -> DataFrame:
    """V3: per group the rows with flag 1 and the rest, each with its share."""
    agg = df.groupBy(group).agg(F.sum(flag).cast("bigint").alias("_yes"),
                                F.count(F.lit(1)).alias("_all"))
    long = agg.select(group, "_all", F.explode(F.array(
        F.struct(F.lit(yes).alias(answer_col), F.col("_yes").alias(count_col)),
        F.struct(F.lit(no).alias(answer_col), (F.col("_all") - F.col("_yes")).alias(count_col)),
    )).alias("_s"))
    return long.select(group, F.col(f"_s.{answer_col}").alias(answer_col),
                       F.col(f"_s.{count_col}").alias(count_col),
                       percent(F.col(f"_s.{count_col}"), F.col("_all"), scale).alias(pct_col))


def stack_offsets(counts: DataFrame, group: str, category: str, count_col: str = "n",
                  out: str = "offset") -> DataFrame:
    """V4: running sum of earlier categories inside each group (bar bottoms).

    The window is partitioned by group and holds one row per category.
    """
    w = (Window.partitionBy(group).orderBy(category)
         .rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn(out, F.coalesce(F.sum(count_col).over(w), F.lit(0)).cast("bigint"))
