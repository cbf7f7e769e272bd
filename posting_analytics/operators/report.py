"""Report operators.

Scale notes
-----------
* Every count is a hash aggregation with a map-side partial step, so a hot
  key is pre-aggregated on each input partition before the shuffle.
* Grand totals (W1) are a scalar subquery, not ``SUM(..) OVER ()``: an empty
  window moves every group to one task, the subquery only moves one partial
  sum per partition.
* Top-n per group (W2) is ``row_number() <= n``, which Spark plans as a
  partial window-group limit before the shuffle and a final one after it, so
  a group holding a third of all rows still sends only ``n`` rows per
  partition.
* Modes (A10) are ``min(struct(-count, value))`` over the per-value counts:
  a plain aggregation with partial combine, no window.
* The top-k semi-join (J1) broadcasts at most ``k`` rows.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent


def _n() -> Column:
    return F.count(F.lit(1))


def group_counts(df: DataFrame, keys: str | Sequence[str], count_col: str = "n",
                 order: bool = True) -> DataFrame:
    """Rows per key (ordered by key)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.groupBy(*keys).agg(_n().alias(count_col))
    return out.orderBy(*keys) if order else out


def grand_total(counts: DataFrame, count_col: str = "n") -> Column:
    """Sum of ``count_col`` over the whole frame, as a scalar subquery."""
    return counts.select(F.sum(count_col)).scalar()


def value_share(df: DataFrame, key: str, count_col: str = "n", pct_col: str = "pct",
                scale: int = 2, order: bool = True) -> DataFrame:
    """A1 + W1: count per value and its share of all rows in %, half-up at
    ``scale`` decimals; ordered by count desc, then value."""
    counts = df.groupBy(key).agg(_n().alias(count_col))
    total = grand_total(counts, count_col)
    out = counts.withColumn(pct_col, percent(F.col(count_col), total, scale))
    return out.orderBy(F.desc(count_col), F.asc(key)) if order else out


def top_k_with_set(df: DataFrame, key: str, set_of: str, k: int = 10,
                   count_col: str = "n", set_col: str = "values") -> DataFrame:
    """A2 + T2: top ``k`` keys by row count, each with the sorted distinct
    values of another column (ties: key ascending).

    Two phases: plain counts per key pick the ``k`` keys, and the value sets
    are built only for those keys (a semi-join against ``k`` broadcast rows).
    With a key of many values (company names) no set is built for the keys
    that are not reported.  The rows of the reported keys are first made
    distinct by key and value, dealt by both, so a key that holds a third of
    all rows is spread over the tasks and only its set comes together.
    """
    top = (df.groupBy(key).agg(_n().alias(count_col))
           .orderBy(F.desc(count_col), F.asc(key)).limit(k))
    keys = F.broadcast(top.select(F.col(key).alias("_k")))
    kept = df.join(keys, df[key].eqNullSafe(keys["_k"]), "left_semi")
    pairs = kept.select(F.col(key).alias("_k"), F.col(set_of).alias("_v")).distinct()
    sets = pairs.groupBy("_k").agg(F.array_sort(F.collect_list("_v")).alias(set_col))
    joined = F.broadcast(top).join(sets, F.col(key).eqNullSafe(F.col("_k")), "left")
    return joined.select(key, count_col, set_col).orderBy(F.desc(count_col), F.asc(key))


def label_counts(df: DataFrame, label: Column, label_name: str, count_col: str = "n",
                 order: bool = True) -> DataFrame:
    """A3: rows per derived label (grouping on the label expression)."""
    out = df.groupBy(label.alias(label_name)).agg(_n().alias(count_col))
    return out.orderBy(F.desc(count_col), F.asc(label_name)) if order else out


def pair_counts(df: DataFrame, a: str, b: str, where: Column | None = None,
                count_col: str = "n", order: bool = True) -> DataFrame:
    """Rows per ``(a, b)``, optionally filtered; ordered by a, count desc."""
    src = df if where is None else df.filter(where)
    out = src.groupBy(a, b).agg(_n().alias(count_col))
    return out.orderBy(F.asc(a), F.desc(count_col), F.asc(b)) if order else out


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """A5: number of distinct values of each column, as one row.

    Exact counts run one branch per column (the branch reads only its column
    and de-duplicates with a map-side partial aggregation); the one-row
    results are folded into one row.  This avoids the row expansion of
    several ``count(DISTINCT ..)`` in one aggregation.  ``approx`` uses
    HyperLogLog++ in a single pass instead.
    """
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(f"n_distinct_{c}") for c in cols])
    parts = [df.select(c).distinct().agg(F.count(c).alias("nd")).select(F.lit(c).alias("c"), "nd")
             for c in cols]
    long = functools.reduce(lambda a, b: a.unionByName(b), parts)
    return long.agg(*[F.max(F.when(F.col("c") == c, F.col("nd"))).alias(f"n_distinct_{c}")
                      for c in cols])


def conditional_rate(df: DataFrame, group: str, condition: Column, total_col: str = "total",
                     hit_col: str = "hits", pct_col: str = "pct", scale: int = 1,
                     order: bool = True) -> DataFrame:
    """Per group the row count, the rows meeting ``condition`` and
    their share in %."""
    hits = F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    out = (df.groupBy(group).agg(_n().alias(total_col), hits.alias(hit_col))
           .withColumn(pct_col, percent(F.col(hit_col), F.col(total_col), scale)))
    return out.orderBy(F.desc(total_col), F.asc(group)) if order else out


def flag_rate(df: DataFrame, group: str, flag: str, total_col: str = "total",
              hit_col: str = "hits", pct_col: str = "pct", scale: int = 1) -> DataFrame:
    """Rows with flag 1 (integer, boolean or double), count and % per group, ordered by group."""
    out = (df.groupBy(group)
           .agg(F.count_if(F.col(flag).cast("double") == 1.0).alias(hit_col), _n().alias(total_col))
           .withColumn(pct_col, percent(F.col(hit_col), F.col(total_col), scale)))
    return out.orderBy(group)


def mean_percent(df: DataFrame, group: str, flag: str, out: str = "pct",
                 scale: int = 1) -> DataFrame:
    """Mean of a 0/1 flag (integer, boolean or double) per group as %, half-up at
    ``scale`` decimals; NULL flags do not count."""
    yes = F.count_if(F.col(flag).cast("double") == 1.0)
    agg = df.groupBy(group).agg(yes.alias("_s"), F.count(flag).alias("_c"))
    return agg.select(group, percent(F.col("_s"), F.col("_c"), scale).alias(out))


def value_counts(df: DataFrame, group: str | Sequence[str], value: str,
                 count_col: str = "n") -> DataFrame:
    """Rows per ``(group, value)``; NULL values are not counted."""
    groups = [group] if isinstance(group, str) else list(group)
    return (df.filter(F.col(value).isNotNull())
            .groupBy(*groups, value).agg(_n().alias(count_col)))


def pick_mode(counts: DataFrame, group: str | Sequence[str], value: str,
              count_col: str = "n", out: str | None = None) -> DataFrame:
    """Most frequent value per group from per-value counts (ties: smallest value)."""
    groups = [group] if isinstance(group, str) else list(group)
    best = F.min(F.struct((-F.col(count_col)).alias("neg_n"), F.col(value).alias("v")))
    return counts.groupBy(*groups).agg(best["v"].alias(out or f"mode_{value}"))


def group_mode(df: DataFrame, group: str, value: str, out: str | None = None) -> DataFrame:
    """A10: most frequent value of ``value`` per group (ties: smallest value)."""
    return pick_mode(value_counts(df, group, value), group, value, out=out)


def rank_within(counts: DataFrame, group: str | Sequence[str], value: str,
                count_col: str = "n", rank_col: str = "rank") -> DataFrame:
    """Rank of each value inside its group by count desc, value asc."""
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(F.desc(count_col), F.asc(value))
    return counts.withColumn(rank_col, F.row_number().over(w))


def top_n_per_group(df: DataFrame, group: str | Sequence[str], value: str, n: int = 5,
                    count_col: str = "n", rank_col: str = "rank") -> DataFrame:
    """A12 + W2: the ``n`` most frequent values per group as rows."""
    ranked = rank_within(value_counts(df, group, value, count_col), group, value,
                         count_col, rank_col)
    return ranked.filter(F.col(rank_col) <= n)


def count_map(ranked: DataFrame, group: str | Sequence[str], value: str,
              count_col: str = "n", out: str = "counts") -> DataFrame:
    """``value -> count`` map per group, entries ordered by count desc,
    value asc (the frame is already cut to the wanted entries)."""
    groups = [group] if isinstance(group, str) else list(group)
    entry = F.struct((-F.col(count_col)).alias("k1"), F.col(value).alias("k2"),
                     F.col(value).cast("string").alias("key"), F.col(count_col).alias("n"))
    agg = ranked.groupBy(*groups).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    pairs = F.transform(F.col("_e"), lambda e: F.struct(e["key"], e["n"]))
    return agg.select(*groups, F.map_from_entries(pairs).alias(out))


def map_text(m: Column, sep: str = ", ") -> Column:
    """Ordered ``k:v`` text of a count map (for flat sinks and comparisons)."""
    return F.array_join(F.transform(F.map_entries(m),
                                    lambda e: F.concat(e["key"], F.lit(":"),
                                                       e["value"].cast("string"))), sep)


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return df.select(col).distinct().orderBy(col)


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """Total row count as a one-row frame."""
    return df.agg(_n().alias(out))


#: Types whose values the frequent-item sketch takes.
_SKETCHED = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp",
             "timestamp_ntz")


def _candidates(df: DataFrame, col: str, tracked: int) -> tuple[list, int]:
    """Values that may be frequent, and the most rows that any other value can have.

    The sketch tracks items in a map of the power of two at or above
    ``tracked / 0.75`` entries; its counts are upper bounds, wrong by at most
    3.5 / size of the rows, and it does not list a value whose lower bound is
    below that error.  Counts that add up to the rows are exact and complete.
    """
    name = "`" + col.replace("`", "``") + "`"
    row = df.filter(F.col(col).isNotNull()).select(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({name}, {tracked}, {tracked})").alias("items")).first()
    items, n = list(row["items"] or []), row["n"]
    if sum(i["count"] for i in items) == n:
        return [i["item"] for i in items], 0
    size = 1 << (int(tracked / 0.75) - 1).bit_length()
    listed = min(i["count"] for i in items) if len(items) >= tracked else 0
    return [i["item"] for i in items], max(listed, int(2 * 3.5 * n / size) + 1)


def heavy_hitters(df: DataFrame, col: str, k: int = 5, count_col: str = "n", tracked: int = 10_000) -> DataFrame:
    """T3 in bounded memory: the rows of ``top_k_values``, without a count of every value.

    A sketch of at most ``tracked`` values a partition (merged, never
    shuffled by value) names candidates and bounds what any other value can
    have; one more scan counts the candidates alone, exactly.  If the ``k``-th
    of them has more rows than the bound, they are the answer; if not - no value
    stands out - all values are counted.  So the answer is always exact, and what
    is shuffled only grows with the number of distinct values where none is
    frequent.  Runs its two scans when called; at most ``tracked`` values and
    ``k`` counts reach the driver.
    """
    if df.schema[col].dataType.simpleString() not in _SKETCHED or not 0 < k <= tracked:
        return top_k_values(df, col, k, count_col)
    values, bound = _candidates(df, col, tracked)
    spark, field = df.sparkSession, df.select(col).schema
    wanted = F.broadcast(spark.createDataFrame([(v,) for v in values], field))
    counted = top_k_values(df.select(col).join(wanted, on=col, how="left_semi"), col, k, count_col)
    top = counted.collect()
    if bound and (len(top) < k or top[-1][count_col] <= bound):
        return top_k_values(df, col, k, count_col)
    return spark.createDataFrame(top, counted.schema)


def top_k_values(df: DataFrame, col: str, k: int = 5, count_col: str = "n") -> DataFrame:
    """The ``k`` most frequent values (ties: value ascending); NULL is not a value."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(_n().alias(count_col))
            .orderBy(F.desc(count_col), F.asc(col)).limit(k))


def keep_top_k(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """Rows whose ``col`` is among the ``k`` most frequent values.

    A left-semi join against at most ``k`` broadcast rows.
    """
    top = top_k_values(df, col, k).select(col)
    return df.join(F.broadcast(top), on=col, how="left_semi")


def attribute_counts(df: DataFrame, group: str, attrs: Sequence[str], count_col: str = "n",
                     attr_col: str = "attribute", value_col: str = "value") -> DataFrame:
    """A8 for several attributes: rows per ``(group, attribute, value)``, values as text.

    One scan with a grouping set per attribute.  Each row becomes one per
    attribute in memory and is counted there before anything is shuffled.
    """
    sets = [f"_{i}" for i in range(len(attrs))]
    src = df.select(F.col(group).alias("_g"), *[F.col(a).cast("string").alias(s) for a, s in zip(attrs, sets)])
    out = src.groupingSets([["_g", s] for s in sets], "_g", *sets).agg(
        _n().alias("_n"), *[F.grouping(s).alias(f"_in{s}") for s in sets])

    def of_set(values) -> Column:
        """The value of the set that a row was grouped by: the attribute that is not rolled up."""
        chain = None
        for s, v in zip(sets, values):
            hit = F.col(f"_in{s}") == 0
            chain = F.when(hit, v) if chain is None else chain.when(hit, v)
        return chain

    return out.select(F.col("_g").alias(group), of_set([F.lit(a) for a in attrs]).alias(attr_col),
                      of_set([F.col(s) for s in sets]).alias(value_col), F.col("_n").alias(count_col))
