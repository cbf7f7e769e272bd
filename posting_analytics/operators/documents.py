"""Nested summary documents.

Every attribute is counted per ``(cluster, value)`` with a map-side partial
count.  Modes are a minimum over those counts; the entries of a count map are
cut to the wanted number by a window whose limit Spark applies before the
shuffle, so no task holds all values of a cluster and no list holds more
entries than its map.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent

def _value_counts(df: DataFrame, cluster: str, col: str) -> DataFrame:
    """Rows per ``(cluster, value)``; NULL values are not counted."""
    return (df.filter(F.col(col).isNotNull())
            .groupBy(F.col(cluster).alias("_c"), F.col(col).cast("string").alias("_v"))
            .agg(F.count(F.lit(1)).alias("_n")))


def _modes(counts: DataFrame, out: str) -> DataFrame:
    """Most frequent value per cluster (ties: smallest value); no window, no sort."""
    best = F.min(F.struct((-F.col("_n")).alias("k"), F.col("_v").alias("v")))
    return counts.groupBy(F.col("_c").alias(f"_c_{out}")).agg(best["v"].alias(out))


def _top(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent values per cluster: Spark limits each partition before the shuffle."""
    w = Window.partitionBy("_c").orderBy(F.desc("_n"), F.asc("_v"))
    return counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)


def _maps(top: DataFrame, out: str) -> DataFrame:
    """The values of a cluster as an ordered ``value -> count`` map."""
    entries = F.array_sort(F.collect_list(_entry(F.col("_n"), F.col("_v"))))
    return top.groupBy(F.col("_c").alias(f"_c_{out}")).agg(_as_map(entries).alias(out))


def _entry(n, value):
    # sorts by count desc, then by the value in its own type; keyed by its text
    return F.struct((-n).alias("k1"), value.alias("k2"), value.cast("string").alias("key"),
                    n.alias("n"))


def _as_map(entries):
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["n"])))


def cluster_summary(df: DataFrame, cluster: str = "cluster", category: str = "keyword_category",
                    location: str = "location", education: str = "education_req",
                    flag: str = "has_salary", top_locations: int = 5,
                    top_categories: int | None = None,
                    generated_at: _dt.datetime | None = None) -> DataFrame:
    """One document per cluster.

    Fields: ``cluster_id``, ``total_lowongan`` (rows), the most frequent
    category / location / education (ties: smallest value),
    ``pct_gaji_dicantumkan`` (mean of the 0/1, boolean or double flag in %,
    1 decimal), the category count map (whole, or of the ``top_categories`` most
    frequent), the top-``top_locations`` location count map and
    ``generated_at``.  Map entries run by count desc, value asc.

    Each attribute is counted once per ``(cluster, value)``; everything else
    works on those counts, and a limited map is cut before its entries meet.
    """
    yes = F.count_if(F.col(flag).cast("double") == 1.0)
    out = df.groupBy(F.col(cluster).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("total_lowongan"), yes.alias("_yes"), F.count(flag).alias("_flagged"))
    cat, loc = _value_counts(df, cluster, category), _value_counts(df, cluster, location)
    edu = _value_counts(df, cluster, education)
    for side, name in ((_modes(cat, "kategori_dominan"), "kategori_dominan"),
                       (_modes(loc, "lokasi_dominan"), "lokasi_dominan"),
                       (_modes(edu, "pendidikan_dominan"), "pendidikan_dominan"),
                       (_maps(cat if top_categories is None else _top(cat, top_categories), "distribusi_kategori"), "distribusi_kategori"),
                       (_maps(_top(loc, top_locations), "distribusi_lokasi"), "distribusi_lokasi")):
        out = out.join(side, F.col("cluster_id").eqNullSafe(F.col(f"_c_{name}")), "left")
    ts = generated_at or _dt.datetime.now()
    empty = F.create_map().cast("map<string,bigint>")
    return out.select(
        "cluster_id", "total_lowongan", "kategori_dominan", "lokasi_dominan", "pendidikan_dominan",
        percent(F.col("_yes"), F.col("_flagged"), 1).alias("pct_gaji_dicantumkan"),
        F.coalesce("distribusi_kategori", empty).alias("distribusi_kategori"),
        F.coalesce("distribusi_lokasi", empty).alias("distribusi_lokasi"),
        F.lit(ts).cast("timestamp").alias("generated_at"))


def top_values_document(df: DataFrame, cluster: str = "cluster", value: str = "company_name",
                        n: int = 5, out: str = "top_companies",
                        generated_at: _dt.datetime | None = None) -> DataFrame:
    """Per cluster the ``n`` most frequent values as a count map."""
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(F.col(cluster).alias("_c"), F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy("_c").orderBy(F.desc("_n"), F.asc("_v"))
    top = counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    ts = generated_at or _dt.datetime.now()
    entries = F.array_sort(F.collect_list(_entry(F.col("_n"), F.col("_v"))))
    return (top.groupBy("_c").agg(entries.alias("_e"))
            .select(F.col("_c").alias("cluster_id"), _as_map(F.col("_e")).alias(out),
                    F.lit(ts).cast("timestamp").alias("generated_at")))
