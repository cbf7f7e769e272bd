"""Report operators against brute force (pandas) on a small skewed fixture."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from posting_analytics.operators import report


def half_up(x, scale):
    return float(Decimal(x).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", "d"])   # one group: a third of rows
        v = rnd.choice(["x", "y", "z", "w", "v", "u", None]) if g != "hot" else f"k{rnd.randint(0, 40)}"
        rows.append((i, g, v, rnd.randint(0, 1)))
    pdf = pd.DataFrame(rows, columns=["id", "g", "v", "flag"])
    return spark.createDataFrame(pdf).repartition(6), pdf


def test_value_share(skewed):
    df, pdf = skewed
    got = {r["g"]: (r["n"], r["pct"]) for r in report.value_share(df, "g").collect()}
    counts = pdf["g"].value_counts()
    want = {k: (int(n), half_up(Decimal(int(n)) * 100 / Decimal(len(pdf)), 2)) for k, n in counts.items()}
    assert got == want


def test_value_share_order(skewed):
    df, _ = skewed
    ns = [r["n"] for r in report.value_share(df, "g").collect()]
    assert ns == sorted(ns, reverse=True)


def test_group_mode_ties_smallest(skewed, spark):
    df, pdf = skewed
    got = {r["g"]: r["m"] for r in report.group_mode(df, "g", "v", "m").collect()}
    want = {}
    for g, sub in pdf.dropna(subset=["v"]).groupby("g"):
        c = sub["v"].value_counts()
        best = c.max()
        want[g] = sorted(c[c == best].index)[0]
    assert got == want
    ties = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a")], "g int, v string")
    assert report.group_mode(ties, "g", "v", "m").first()["m"] == "a"


def test_top_n_per_group(skewed):
    df, pdf = skewed
    got = sorted((r["g"], r["v"], r["n"], r["rank"])
                 for r in report.top_n_per_group(df, "g", "v", 3).collect())
    want = []
    for g, sub in pdf.dropna(subset=["v"]).groupby("g"):
        c = sub.groupby("v").size().reset_index(name="n").sort_values(["n", "v"], ascending=[False, True])
        for rank, (v, n) in enumerate(zip(c["v"], c["n"]), start=1):
            if rank <= 3:
                want.append((g, v, int(n), rank))
    assert got == sorted(want)


def test_count_map_and_text(skewed):
    df, pdf = skewed
    ranked = report.top_n_per_group(df, "g", "v", 2)
    maps = {r["g"]: r["t"] for r in report.count_map(ranked, "g", "v")
            .select("g", report.map_text(F.col("counts")).alias("t")).collect()}
    sub = pdf[pdf["g"] == "hot"].groupby("v").size().reset_index(name="n") \
        .sort_values(["n", "v"], ascending=[False, True]).head(2)
    assert maps["hot"] == ", ".join(f"{v}:{n}" for v, n in zip(sub["v"], sub["n"]))


def test_conditional_and_mean(skewed):
    df, pdf = skewed
    got = {r["g"]: (r["total"], r["hits"], r["pct"])
           for r in report.conditional_rate(df, "g", F.col("flag") == 1).collect()}
    mean = {r["g"]: r["pct"] for r in report.mean_percent(df, "g", "flag").collect()}
    for g, sub in pdf.groupby("g"):
        hits = int(sub["flag"].sum())
        p = half_up(Decimal(hits) * 100 / Decimal(len(sub)), 1)
        assert got[g] == (len(sub), hits, p)
        assert mean[g] == p


def test_top_k_with_set_and_semijoin(skewed):
    df, pdf = skewed
    top = report.top_k_with_set(df.filter(F.col("v").isNotNull()), "v", "g", 2).collect()
    c = pdf.dropna(subset=["v"]).groupby("v").size().reset_index(name="n") \
        .sort_values(["n", "v"], ascending=[False, True])
    assert [(r["v"], r["n"]) for r in top] == list(zip(c["v"].head(2), c["n"].head(2)))
    assert top[0]["values"] == sorted(pdf[pdf["v"] == top[0]["v"]]["g"].unique())
    kept = report.keep_top_k(df, "g", 1)
    assert kept.count() == int(pdf["g"].value_counts().max())


def test_distinct_and_attribute_counts(skewed):
    df, pdf = skewed
    row = report.distinct_counts(df, ["g", "v"]).first()
    assert row["n_distinct_g"] == pdf["g"].nunique()
    assert row["n_distinct_v"] == pdf["v"].nunique()
    long = report.attribute_counts(df, "g", ["v", "flag"])
    got = {(r["g"], r["attribute"], r["value"]): r["n"] for r in long.collect()}
    assert got[("hot", "flag", "1")] == int(pdf[(pdf.g == "hot") & (pdf.flag == 1)].shape[0])
    assert sum(n for (g, a, _), n in got.items() if a == "v") == len(pdf)


def test_label_and_pair_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("a", "x")], "p string, q string")
    lab = {r["s"]: r["n"] for r in report.label_counts(
        df, F.when(F.col("q") == "x", "X").otherwise("other"), "s").collect()}
    assert lab == {"X": 3, "other": 1}
    pairs = [tuple(r) for r in report.pair_counts(df, "p", "q", where=F.col("q") != "y").collect()]
    assert pairs == [("a", "x", 2), ("b", "x", 1)]
    assert [r["p"] for r in report.sorted_distinct(df, "p").collect()] == ["a", "b"]
    assert report.row_count(df).first()["n_rows"] == 4


def test_top_k_with_set_null_key(spark):
    df = spark.createDataFrame([(None, "J"), (None, "B"), (None, "J"), ("PT A", "J")],
                               "company string, city string")
    rows = [tuple(r) for r in report.top_k_with_set(df, "company", "city", 2).collect()]
    assert rows == [(None, 3, ["B", "J"]), ("PT A", 1, ["J"])]


def test_flag_rate(skewed):
    df, pdf = skewed
    got = {r["g"]: (r["hits"], r["total"], r["pct"]) for r in report.flag_rate(df, "g", "flag").collect()}
    for g, sub in pdf.groupby("g"):
        hits = int(sub["flag"].sum())
        assert got[g] == (hits, len(sub), half_up(Decimal(hits) * 100 / Decimal(len(sub)), 1))


def test_approx_distinct_counts_close_to_exact(spark):
    from posting_analytics.sources import profile
    df = spark.range(20000).select((F.col("id") % 1000).alias("k"), (F.col("id") % 7).alias("s"))
    exact = report.distinct_counts(df, ["k", "s"]).first()
    approx = report.distinct_counts(df, ["k", "s"], approx=True).first()
    assert tuple(exact) == (1000, 7)
    assert abs(approx["n_distinct_k"] - 1000) <= 50 and approx["n_distinct_s"] == 7
    prof = {r["column_name"]: r for r in profile.table_profile(df, approx=True).collect()}
    assert prof["k"]["n_rows"] == 20000 and abs(prof["k"]["n_distinct"] - 1000) <= 50
