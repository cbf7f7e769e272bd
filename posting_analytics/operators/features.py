"""Feature operators (M1-M4, M9-M12) on DataFrames and ``pyspark.ml``.

Category codes come from a distributed rank of the distinct labels: counts
per label, a range sort, and row numbers from per-partition offsets.  No label
list reaches the driver, so a column of any cardinality can be indexed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, PCAModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def label_ranks(df: DataFrame, col: str, order: str = "frequencyDesc",
                out: str = "idx") -> DataFrame:
    """``col, out``: the distinct labels numbered from 0 (as double).

    ``frequencyDesc``: most frequent first, ties alphabetical;
    ``alphabetAsc``: alphabetical.  NULL is not a label.
    """
    keys = {"frequencyDesc": [F.desc("_n"), F.asc(col)], "alphabetAsc": [F.asc(col)]}
    if order not in keys:
        raise ValueError(f"unknown order {order!r}; one of {sorted(keys)}")
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    # the sorted labels are checkpointed, so both uses see the same partitions
    place = F.monotonically_increasing_id()
    ranked = counts.orderBy(*keys[order]).select(col, place.alias("_id")).checkpoint()
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    ranked = ranked.select(col, part.alias("_p"), row.alias("_r"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = ranked.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return ranked.join(offsets, "_p").select(col, (F.col("_o") + F.col("_r")).cast("double").alias(out))


#: Rank tables up to this many labels are broadcast; larger ones are joined by a shuffle.
BROADCAST_LABELS = 100_000


def apply_ranks(df: DataFrame, ranks: DataFrame, col: str, out: str) -> DataFrame:
    """Add the rank of ``col``; NULL and labels without a rank get the number of labels."""
    label, idx = ranks.columns
    n = ranks.count()
    names = ranks.select(F.col(label).alias("_label"), F.col(idx).alias("_rank"))
    names = F.broadcast(names) if n <= BROADCAST_LABELS else names
    joined = df.join(names, F.col(col) == F.col("_label"), "left")
    return joined.withColumn(out, F.coalesce("_rank", F.lit(float(n)))).drop("_label", "_rank")


def index_labels(df: DataFrame, cols: Sequence[str], out_cols: Sequence[str] | None = None,
                 order: str = "frequencyDesc") -> DataFrame:
    """M1 (or M9 with ``order="alphabetAsc"``): add index columns."""
    for c, out in zip(cols, out_cols or [f"{c}_idx" for c in cols]):
        df = apply_ranks(df, label_ranks(df, c, order), c, out)
    return df


def assembler(cols: Sequence[str], out: str = "features_raw") -> VectorAssembler:
    """M2 stage: numbers -> one vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out)


def scaler(inp: str = "features_raw", out: str = "features", with_mean: bool = True,
           with_std: bool = True) -> StandardScaler:
    """M3 stage: centre and scale to unit sample standard deviation."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=with_mean, withStd=with_std)


def feature_pipeline(index_out: Sequence[str], numeric_cols: Sequence[str] = (),
                     features_col: str = "features", one_hot: bool = False) -> Pipeline:
    """M4: (one-hot ->) assembler -> scaler over indexed columns as one ``Pipeline``.

    By default the category codes themselves are features (as in the original
    model, so code distance counts as category distance); with ``one_hot``
    each category becomes its own 0/1 feature instead.
    """
    stages, coded = [], list(index_out)
    if one_hot:
        coded = [f"{c}_vec" for c in index_out]
        stages.append(OneHotEncoder(inputCols=list(index_out), outputCols=coded,
                                    handleInvalid="keep"))
    stages += [assembler([*coded, *numeric_cols], "features_raw"),
               scaler("features_raw", features_col)]
    return Pipeline(stages=stages)


def fit_features(df: DataFrame, index_cols: Sequence[str], index_out: Sequence[str],
                 numeric_cols: Sequence[str] = (), features_col: str = "features",
                 one_hot: bool = False) -> tuple[PipelineModel, DataFrame]:
    """Index the categories, fit the M4 pipeline and transform the same frame."""
    indexed = index_labels(df, index_cols, index_out)
    model = feature_pipeline(index_out, numeric_cols, features_col, one_hot).fit(indexed)
    return model, model.transform(indexed)


def standardize_columns(df: DataFrame, cols: Sequence[str], out_prefix: str = "z_",
                        digits: int | None = None) -> DataFrame:
    """M2 + M3 on plain numeric columns, returning one double column per input."""
    model = Pipeline(stages=[assembler(cols, "_raw"), scaler("_raw", "_z")]).fit(df)
    arr = vector_to_array(F.col("_z"))
    outs = {}
    for i, c in enumerate(cols):
        v = arr[i]
        outs[f"{out_prefix}{c}"] = F.round(v, digits) if digits is not None else v
    return model.transform(df).withColumns(outs).drop("_raw", "_z")


def pca_projection(df: DataFrame, features_col: str = "features", k: int = 2,
                   out: str = "pca") -> tuple[PCAModel, DataFrame]:
    """Scores on the first ``k`` principal components of centred data.

    Spark's ``PCAModel.transform`` does not centre, so the vectors are centred
    first with a mean-only ``StandardScaler``.
    """
    centre = scaler(features_col, "_centred", with_mean=True, with_std=False).fit(df)
    centred = centre.transform(df)
    model = PCA(k=k, inputCol="_centred", outputCol=out).fit(centred)
    return model, model.transform(centred).drop("_centred")


def pca_scores(df: DataFrame, features_col: str = "features", k: int = 2,
               keep: Sequence[str] = ()) -> tuple[PCAModel, DataFrame]:
    """M10 + M11 as flat columns ``pc1 .. pck`` next to the ``keep`` columns."""
    model, projected = pca_projection(df, features_col, k, "_pca")
    arr = vector_to_array(F.col("_pca"))
    return model, projected.select(*keep, *[arr[i].alias(f"pc{i + 1}") for i in range(k)])


def explained_variance(model: PCAModel, spark=None) -> DataFrame:
    """Explained-variance ratio per component as ``(component, ratio)``."""
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    return spark.createDataFrame(rows, "component int, ratio double")
