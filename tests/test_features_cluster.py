import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from posting_analytics.operators import cluster, features


def test_index_frequency_keep(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "v string")
    out = features.index_labels(df, ["v"], ["i"])
    got = {r["v"]: r["i"] for r in out.collect()}
    # a and b tie at 2: alphabetical; NULL gets the extra index
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0}


def test_index_unseen_value_keep(spark):
    train = spark.createDataFrame([("a",), ("b",)], "v string")
    ranks = features.label_ranks(train, "v")
    test = spark.createDataFrame([("zz",), (None,), ("b",)], "v string")
    got = {r["v"]: r["i"] for r in features.apply_ranks(test, ranks, "v", "i").collect()}
    assert got == {"zz": 2.0, None: 2.0, "b": 1.0}


def test_index_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "v string")
    got = {r["v"]: r["i"] for r in features.index_labels(df, ["v"], ["i"], order="alphabetAsc").collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_many_labels_are_ranked_without_the_driver(spark):
    df = spark.range(200_000).select(F.format_string("v%06d", F.col("id") % 150_000).alias("v"))
    got = features.index_labels(df, ["v"], ["i"]).groupBy("v").agg(F.first("i").alias("i"))
    row = got.agg(F.count("*"), F.min("i"), F.max("i"), F.count_distinct("i")).first()
    assert tuple(row) == (150_000, 0.0, 149_999.0, 150_000)
    top = {r["v"]: r["i"] for r in got.filter("i in (0, 49999, 50000)").collect()}
    assert top == {"v000000": 0.0, "v049999": 49_999.0, "v050000": 50_000.0}
    with pytest.raises(ValueError):
        features.index_labels(df, ["v"], ["i"], order="other")


def test_standardize_sample_std_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, k double")
    out = features.standardize_columns(df, ["x", "k"]).orderBy("x").collect()
    assert [round(r["z_x"], 9) for r in out] == [-1.0, 0.0, 1.0]
    assert [r["z_k"] for r in out] == [0.0, 0.0, 0.0]


def test_pca_centres_and_explains(spark):
    rows = [(float(i), float(2 * i + (i % 2))) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double")
    feats = features.assembler(["a", "b"], "f").transform(df)
    model, scores = features.pca_scores(feats, "f", 2)
    pc1 = [r["pc1"] for r in scores.collect()]
    assert abs(sum(pc1)) < 1e-6                      # centred scores
    ratios = [r["ratio"] for r in features.explained_variance(model, spark).collect()]
    assert ratios[0] > 0.99 and math.isclose(sum(ratios), 1.0, rel_tol=1e-6)


def test_kmeans_elbow_and_quality(spark):
    pts = [(float(x), float(y)) for x, y in [(0, 0), (0, 1), (1, 0), (10, 10), (10, 11), (11, 10)]]
    df = features.assembler(["a", "b"], "features").transform(
        spark.createDataFrame(pts, "a double, b double").coalesce(1))
    sweep = cluster.elbow(df, ks=[2, 3], seed=42, max_iter=20)
    costs = [r["wssse"] for r in sweep.orderBy("k").collect()]
    assert costs[0] >= costs[1] >= 0
    model, out = cluster.kmeans_assign(df, k=2, seed=42, max_iter=20)
    labels = [r["cluster"] for r in out.orderBy("a", "b").collect()]
    assert len(set(labels[:3])) == 1 and len(set(labels[3:])) == 1 and labels[0] != labels[3]
    q = cluster.model_quality(model, out).first()
    assert q["k"] == 2 and q["silhouette"] > 0.8 and q["training_cost"] == pytest.approx(8 / 3)


def test_feature_pipeline_vector(spark):
    df = spark.createDataFrame([("J", "S1", 1), ("B", "D1", 0), ("J", "S1", 1)],
                               "location string, edu string, has int")
    model, out = features.fit_features(df, ["location", "edu"], ["li", "ei"], ["has"])
    arr = out.select(vector_to_array("features").alias("v")).collect()
    assert all(len(r["v"]) == 3 for r in arr)


def test_feature_pipeline_one_hot(spark):
    df = spark.createDataFrame([("J", "S1", 1), ("B", "D1", 0), ("M", "S1", 1)],
                               "location string, edu string, has int")
    _, out = features.fit_features(df, ["location", "edu"], ["li", "ei"], ["has"], one_hot=True)
    width = len(out.select(vector_to_array("features").alias("v")).first()["v"])
    # one slot per label (NULL and unseen labels are all zeros): 3 locations, 2 educations, the flag
    assert width == 3 + 2 + 1


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (5.0,), (9.0,)], "x double")
    feats = features.assembler(["x"], "features").transform(df)
    model, out = cluster.kmeans_assign(feats, k=7)
    assert {r["x"]: r["cluster"] for r in out.collect()}.__len__() == 3 and model.summary.k == 3
    assert cluster.elbow(feats, range(3, 6)).collect() == [(3, 0.0), (4, 0.0), (5, 0.0)]
    one = feats.filter("x = 0")
    model, out = cluster.kmeans_assign(one, k=4)
    assert model is None and {r["cluster"] for r in out.collect()} == {0}
    assert cluster.model_quality(model, out).first()["training_cost"] == 0.0
