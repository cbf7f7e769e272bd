"""Clustering operators (M5-M8) on ``pyspark.ml`` k-means.

k-means is distributed by Spark (k-means|| initialisation, centres broadcast
per iteration).  The feature frame is persisted for the sweep so the input is
not recomputed for every fit, and the fits of a sweep run side by side.  Note: with the same seed, a different
partitioning of the input may give different clusters.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Fits of a sweep in flight at a time.
PARALLEL_FITS = 3


def kmeans(k: int = 4, seed: int = 42, max_iter: int = 50, features_col: str = "features",
           prediction_col: str = "cluster") -> KMeans:
    return KMeans(featuresCol=features_col, predictionCol=prediction_col, k=k, seed=seed,
                  maxIter=max_iter)


def distinct_points(df: DataFrame, features_col: str, most: int) -> int:
    """Number of distinct feature vectors, counted up to ``most``."""
    return df.select(features_col).distinct().limit(most).count()


def elbow(df: DataFrame, ks: Iterable[int] = range(2, 8), seed: int = 42, max_iter: int = 20,
          features_col: str = "features", digits: int = 2) -> DataFrame:
    """M5: training cost (WSSSE) for each k, as ``(k, wssse)``.

    The features are cached for the sweep unless the input already is.  A few
    fits are submitted at a time, so that the stages of one fill the cores
    that another leaves idle.  With at most ``k`` distinct points every point
    is a centre and the cost is 0.
    """
    ks = list(ks)
    cached = df.storageLevel != StorageLevel.NONE
    feats = df.select(features_col)
    if not cached:
        feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        points = distinct_points(feats, features_col, max(ks, default=0) + 1)

        def fit(k: int) -> tuple[int, float]:
            if k >= points:
                return int(k), 0.0
            model = kmeans(k, seed, max_iter, features_col).fit(feats)
            return int(k), round(float(model.summary.trainingCost), digits)

        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            rows = list(pool.map(inheritable_thread_target(df.sparkSession)(fit), ks))
    finally:
        if not cached:
            feats.unpersist()
    spark = SparkSession.getActiveSession() or df.sparkSession
    return spark.createDataFrame(rows, "k int, wssse double")


def kmeans_assign(df: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 50,
                  features_col: str = "features",
                  prediction_col: str = "cluster") -> tuple[KMeansModel | None, DataFrame]:
    """M6: fit k-means and add the cluster id column.

    Fewer distinct points than ``k`` give as many clusters; a single point is
    cluster 0 and has no model.
    """
    k = min(k, distinct_points(df, features_col, k))
    if k < 2:
        return None, df.withColumn(prediction_col, F.lit(0))
    model = kmeans(k, seed, max_iter, features_col, prediction_col).fit(df)
    return model, model.transform(df)


def silhouette(clustered: DataFrame, features_col: str = "features",
               prediction_col: str = "cluster") -> float:
    """M8: silhouette with squared Euclidean distance; NaN with fewer than two clusters."""
    if clustered.select(prediction_col).distinct().limit(2).count() < 2:
        return float("nan")
    ev = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(clustered))


def model_quality(model: KMeansModel | None, clustered: DataFrame, features_col: str = "features",
                  prediction_col: str = "cluster") -> DataFrame:
    """M7 + M8: ``(k, training_cost, iterations, silhouette)`` as one row."""
    if model is None:  # one distinct point
        row = (1, 0.0, 0, float("nan"))
    else:
        s = model.summary
        row = (int(s.k), float(s.trainingCost), int(s.numIter),
               silhouette(clustered, features_col, prediction_col))
    spark = SparkSession.getActiveSession() or clustered.sparkSession
    return spark.createDataFrame([row], "k int, training_cost double, iterations int, "
                                        "silhouette double")
