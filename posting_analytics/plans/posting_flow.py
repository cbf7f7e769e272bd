"""The posting flow end to end: pages -> postings -> cleaned -> reports ->
clusters -> profiles -> documents -> chart tables, all as Spark jobs.

Each stage is a function from DataFrames to DataFrames; ``run`` chains them
and writes every result under one output folder.  Stage outputs that later
stages reuse (postings, cleaned rows, clustered rows) are written and read
back, which also cuts the lineage: a lost executor recomputes from the last
written table, not from the raw pages.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..operators import clean, cluster, documents, extract, features, report, tables
from ..sources import collections, files

#: The categories of the fixed rules, in alphabetical order.
CATEGORIES = sorted({label for _, label in vocab.CATEGORY_RULES} | {vocab.CATEGORY_DEFAULT})
INDEX_COLS = ["location", "education_req", "keyword_category"]
INDEX_OUT = ["location_idx", "edu_idx", "category_idx"]


def analysis_reports(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The report set over cleaned postings (column names as published)."""
    salary_stated = F.col("salary_range") != vocab.NOT_STATED
    status = (F.when(salary_stated, F.lit(vocab.SALARY_STATED_LABEL))
              .otherwise(F.lit(vocab.SALARY_NOT_STATED_LABEL)))
    return {
        "missing": clean.missing_report(cleaned, ["job_requirements", "job_responsibilities"]),
        "location_share": report.value_share(cleaned, "location", "jumlah_lowongan", "persentase"),
        "top_companies": report.top_k_with_set(cleaned, "company_name", "location", 10,
                                               "total_lowongan", "kota_operasi"),
        "category_share": report.value_share(cleaned, "keyword_category", "jumlah", "persen")
        .withColumnRenamed("keyword_category", "kategori"),
        "salary_status": report.label_counts(cleaned, status, "status_gaji", "jumlah_lowongan"),
        "education_by_category": report.pair_counts(
            cleaned, "keyword_category", "education_req",
            where=F.col("education_req") != vocab.NOT_STATED, count_col="jumlah"),
        "distinct_counts": report.distinct_counts(
            cleaned, ["location", "job_type", "education_req", "keyword_category"]),
        "salary_by_city": report.conditional_rate(cleaned, "location", salary_stated, "total",
                                                  "ada_gaji", "pct_ada_gaji"),
    }


@dataclass
class Clustering:
    clustered: DataFrame
    elbow: DataFrame
    quality: DataFrame
    feature_model: object = None
    kmeans_model: object = None
    extra: dict = field(default_factory=dict)


def cluster_postings(cleaned: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 50,
                     elbow_ks=range(2, 8), elbow_iter: int = 20, one_hot: bool = False) -> Clustering:
    """Flag, index, assemble, scale, sweep k, fit k-means, evaluate.

    With fewer distinct rows than ``k`` k-means gives as many clusters as
    there are; without rows every result is an empty table.
    """
    df = clean.add_presence_flag(cleaned, "salary_range", "has_salary")
    if df.isEmpty():
        spark = df.sparkSession
        return Clustering(df.withColumn("cluster", F.lit(0)).select(*vocab.CLUSTERED_COLUMNS),
                          spark.createDataFrame([], "k int, wssse double"),
                          spark.createDataFrame([], "k int, training_cost double, iterations int, "
                                                    "silhouette double"))
    fmodel, feats = features.fit_features(df, INDEX_COLS, INDEX_OUT, ["has_salary"],
                                          one_hot=one_hot)
    feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    sweep = cluster.elbow(feats, elbow_ks, seed, elbow_iter)
    kmodel, out = cluster.kmeans_assign(feats, k, seed, max_iter)
    quality = cluster.model_quality(kmodel, out)
    clustered = out.select(*vocab.CLUSTERED_COLUMNS)
    return Clustering(clustered, sweep, quality, fmodel, kmodel, {"features": feats})


def cluster_profiles(clustered: DataFrame) -> dict[str, DataFrame]:
    """Size, attribute mix and salary transparency per cluster, each a plain grouped count."""
    pairs = {name: report.pair_counts(clustered, "cluster", col, count_col="jumlah")
             for name, col in (("category", "keyword_category"), ("location", "location"),
                               ("education", "education_req"))}
    return {
        "sizes": report.group_counts(clustered, "cluster", "jumlah_lowongan"),
        **pairs,
        "salary": report.flag_rate(clustered, "cluster", "has_salary", "total", "ada_gaji",
                                   "pct_ada_gaji"),
    }


def summary_documents(clustered: DataFrame, run_ts: _dt.datetime) -> dict[str, DataFrame]:
    """The three document collections: raw rows with metadata, one summary per
    cluster, top companies per cluster."""
    return {
        "raw_jobs": clean.add_metadata(clustered, {"scraped_at": run_ts,
                                                   "source": vocab.DOCUMENT_SOURCE}),
        "cluster_summary": documents.cluster_summary(clustered, generated_at=run_ts),
        "top_companies": documents.top_values_document(clustered, "cluster", "company_name", 5,
                                                       generated_at=run_ts),
    }


def projection(clustered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two principal components of the alphabetical codes, and their variance shares.

    Fewer than two rows have no variance: their scores are 0 and the shares are an empty table.
    """
    if clustered.limit(2).count() < 2:
        none = F.lit(0.0)
        return (clustered.select("cluster", none.alias("pc1"), none.alias("pc2")),
                clustered.sparkSession.createDataFrame([], "component int, ratio double"))
    names = [f"{c}_enc" for c in INDEX_COLS]
    coded = features.index_labels(clustered, INDEX_COLS, names, order="alphabetAsc")
    assembled = features.assembler([*names, "has_salary"], "codes").transform(coded)
    model, scores = features.pca_scores(assembled, "codes", 2, keep=("cluster",))
    return scores, features.explained_variance(model)


def chart_tables(clustered: DataFrame) -> dict[str, DataFrame]:
    """The data behind the five charts."""
    counts = report.pair_counts(clustered, "cluster", "keyword_category", order=False)
    scores, variance = projection(clustered)
    return {
        "cluster_sizes": report.group_counts(clustered, "cluster"),
        "category_by_cluster": tables.contingency(clustered, "cluster", "keyword_category",
                                                  CATEGORIES),
        "category_offsets": tables.stack_offsets(counts, "cluster", "keyword_category"),
        "top_locations_by_cluster": tables.contingency_top_k(clustered, "cluster", "location", 5),
        "salary_split": tables.binary_split(clustered, "cluster", "has_salary", "Ada Gaji",
                                            "Tidak Ada"),
        "pca_scores": scores,
        "pca_variance": variance,
    }


def _write_read(spark: SparkSession, df: DataFrame, path: str, schema=None) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


def run(spark: SparkSession, out_dir: str, *, pages: DataFrame | None = None,
        raw: DataFrame | None = None, run_date: str | None = None,
        run_ts: _dt.datetime | None = None, k: int = 4) -> dict[str, str]:
    """Run every stage and write its outputs under ``out_dir``.

    Input is either a pages table (``page_id, url, html``) or an already
    extracted posting table.  Pages that give no posting row are written to
    ``rejects`` with the reason.  Returns ``name -> path``.  An input of few
    large files keeps few cores busy: repartition it (``partitioning.spread``).
    """
    out = out_dir.rstrip("/")
    run_ts = run_ts or _dt.datetime.now()
    paths: dict[str, str] = {}
    if raw is None:
        if pages is None:
            raise ValueError("give pages or raw postings")
        raw = extract.extract_postings(pages, run_date=run_date)
        extract.rejected_pages(pages).write.mode("overwrite").parquet(f"{out}/rejects")
        paths["rejects"] = f"{out}/rejects"
    raw = _write_read(spark, raw, f"{out}/postings")
    paths["postings"] = f"{out}/postings"
    files.write_csv(raw.select(*vocab.POSTING_COLUMNS), f"{out}/postings_csv")

    cleaned = _write_read(spark, clean.clean_postings(raw), f"{out}/cleaned")
    paths["cleaned"] = f"{out}/cleaned"
    for name, df in analysis_reports(cleaned).items():
        files.write_csv(df, f"{out}/reports/{name}")
        paths[f"report_{name}"] = f"{out}/reports/{name}"

    result = cluster_postings(cleaned, k=k)
    clustered = _write_read(spark, result.clustered, f"{out}/clustered")
    if "features" in result.extra:
        result.extra["features"].unpersist()
    paths["clustered"] = f"{out}/clustered"
    files.write_csv(clustered, f"{out}/clustered_csv")
    files.write_json(clustered, f"{out}/clustered_json")
    files.write_csv(result.elbow, f"{out}/model/elbow")
    files.write_csv(result.quality, f"{out}/model/quality")
    paths["model"] = f"{out}/model"

    for name, df in cluster_profiles(clustered).items():
        files.write_csv(df, f"{out}/profiles/{name}")
    docs = summary_documents(clustered, run_ts)
    collections.write_collections(docs, f"{out}/collections")
    paths["collections"] = f"{out}/collections"
    for name, df in chart_tables(clustered).items():
        files.write_csv(df, f"{out}/charts/{name}")
    paths["charts"] = f"{out}/charts"
    return paths
