"""Reports whose memory or shuffle does not grow with a hot key or with distinct values."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from posting_analytics.operators import documents, report
from posting_analytics.plans import driver_queries as Q

SF = "/root/testdata/sf0.001"


def _rows(seed, n=6000):
    """One value with a third of the rows, some frequent ones, a long tail of values met once, NULLs."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = rng.random()
        out.append("hot" if x < 1 / 3 else None if x < 0.4 else f"often {rng.randrange(6)}" if x < 0.7 else f"rare {i}")
    return out


def _top(values, k):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("tracked", [16, 64, 10_000])
@pytest.mark.parametrize("k", [1, 5, 9])
def test_heavy_hitters_are_exact(spark, tracked, k):
    values = _rows(k)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    got = [tuple(r) for r in report.heavy_hitters(df, "v", k, tracked=tracked).collect()]
    assert sorted(got, key=lambda x: (-x[1], x[0])) == _top(values, k)


def test_frequent_values_are_found_without_counting_all(spark, monkeypatch):
    values = _rows(3)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    counted = []
    plain = report.top_k_values

    def watched(frame, *args):
        counted.append(frame.agg(F.count_distinct("v")).first()[0])
        return plain(frame, *args)

    monkeypatch.setattr(report, "top_k_values", watched)
    got = report.heavy_hitters(df, "v", 3, tracked=512).collect()
    assert sorted((tuple(r) for r in got), key=lambda x: (-x[1], x[0])) == _top(values, 3)
    assert len(counted) == 1 and counted[0] <= 512 < len(set(values))  # the candidates alone


@pytest.mark.parametrize("values", [[], [None, None], ["a"], [f"v{i % 700}" for i in range(1400)], ["b", "a", "b", "a"]])
def test_nothing_stands_out(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [tuple(r) for r in report.heavy_hitters(df, "v", 2, tracked=16).collect()]
    assert sorted(got, key=lambda x: (-x[1], x[0])) == _top(values, 2)


def test_other_types(spark):
    days = [dt.date(2026, 1, 1 + i % 3) for i in range(8)]
    df = spark.createDataFrame([(d, i % 3, bytes([i % 3])) for i, d in enumerate(days)], "`a d` date, i int, b binary")
    for c in ("a d", "i", "b"):
        assert sorted(map(tuple, report.heavy_hitters(df, c, 2).collect())) == sorted(
            map(tuple, report.top_k_values(df, c, 2).collect()))


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_attributes_are_counted_in_one_scan(spark):
    df = Q.attribute_counts(spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Expand" in text


def test_attribute_counts_tell_nulls_from_other_attributes(spark):
    rows = [("g", "a", 1), ("g", None, 1), ("g", None, None), (None, "a", 2)]
    df = spark.createDataFrame(rows, "value string, x string, attribute int")
    got = {(r.value_of, r.attr, r.v): r.c for r in report.attribute_counts(
        df, "value", ["x", "attribute"], "c", "attr", "v").withColumnRenamed("value", "value_of").collect()}
    assert got == {("g", "x", "a"): 1, ("g", "x", None): 2, (None, "x", "a"): 1,
                   ("g", "attribute", "1"): 2, ("g", "attribute", None): 1, (None, "attribute", "2"): 1}


def test_value_sets_are_made_of_distinct_pairs(spark):
    rows = [("hot", f"c{i % 40}") for i in range(3000)] + [("hot", None), (None, "x"), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(4)
    out = report.top_k_with_set(df, "k", "v", 3)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in text
    got = {r.k: (r.n, list(r["values"])) for r in out.collect()}
    assert got == {"hot": (3001, sorted({f"c{i}" for i in range(40)})), None: (1, ["x"]), "b": (1, [])}


def test_summary_holds_every_category(spark):
    rows = [(0, f"cat {i % 250:03d}", "J", "S1", 1) for i in range(600)]
    df = spark.createDataFrame(rows, "cluster int, keyword_category string, location string, education_req string, has_salary int")
    keys, n = documents.cluster_summary(df).select(F.map_keys("distribusi_kategori"), F.map_values("distribusi_kategori")).first()
    assert len(keys) == 250 and sum(n) == 600
    assert keys[:2] == ["cat 000", "cat 001"] and n[0] == 3 and n[-1] == 2
    assert len(documents.cluster_summary(df, top_categories=7).first()["distribusi_kategori"]) == 7
