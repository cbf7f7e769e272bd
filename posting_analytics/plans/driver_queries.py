"""Queries over the driver's test tables, one per operator group.

Each query is ``f(spark, sf_dir) -> DataFrame`` and runs the library's own
operators on whole tables.  Computed columns carry the same names as the
matching SQL in ``oracle``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import match, money, text
from ..operators import clean, cluster, documents, extract, features, report, tables
from ..operators.partitioning import compute_once, spread
from ..session import scratch_path
from ..sources import collections, files, profile
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]


#: Session setting: how many partitions the rows of CPU-heavy inputs are dealt over after the scan.
#: Unset (the default) nothing is dealt: a large input arrives in many scan partitions.
DEAL_SETTING = "spark.posting_analytics.dealOver"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def heavy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table that feeds CPU-heavy work per row, dealt over partitions if the session's owner asks for it."""
    df, wanted = table(spark, sf_dir, name), spark.conf.get(DEAL_SETTING, None)
    return spread(df, int(wanted)) if wanted else df


# --- E: extraction ---------------------------------------------------------

def normalize_ws(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id", text.normalize_ws("text").alias("text_norm"))


def html_text(spark, sf_dir):
    p = heavy(spark, sf_dir, "pages")
    return p.select("page_id", text.html_to_text("html").alias("page_text"))


def html_h1(spark, sf_dir):
    p = heavy(spark, sf_dir, "pages")
    return p.select("page_id", text.first_tag_text("html", "h1").alias("job_title"))


def html_anchor(spark, sf_dir):
    p = heavy(spark, sf_dir, "pages")
    return p.select("page_id", text.anchor_text("html", P.PAGE_HREF).alias("company_name"))


def first_match(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id", match.first_listed("text", P.DOC_FIRST_WORDS).alias("first_word"))


def flag_text(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id", match.phrase_flag("text", P.DOC_FLAG_PHRASE, P.DOC_FLAG_LABEL)
                    .alias("license_flag"))


def regex_first(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id",
                    match.regex_first("text", P.DOC_REF_PATTERN).alias("first_ref"),
                    match.regex_first("text", P.DOC_LOWER_PATTERN, lower=True).alias("first_phrase"),
                    match.regex_first("text", P.DOC_CASE_PATTERN).alias("first_grade"))


def amount_range(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id", money.amount_range("text", P.DOC_AMOUNT_PATTERN).alias("amount_range"))


def amount_range_no_fraction(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id", money.amount_range("text", P.DOC_AMOUNT_PATTERN, drop_fraction=True)
                    .alias("amount_range"))


def keyword_tags_whole_word(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id", match.keyword_tags("text", P.DOC_TAG_WORDS, whole_word=True)
                    .alias("tags"))


def money_format(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    price_text = F.concat(F.lit("IDR "), F.floor("o_totalprice").cast("bigint").cast("string"))
    return o.select("o_orderkey", money.money_format(price_text).alias("price_text"))


def keyword_tags(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id", match.keyword_tags("text", P.DOC_TAG_WORDS).alias("tags"))


def keyword_label(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    return d.select("doc_id", match.ordered_label("text", P.DOC_LABELS, vocab.NOT_FOUND)
                    .alias("label"))


def const_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    o = o.withColumns({
        "source_platform": F.lit(vocab.SOURCE_PLATFORM),
        "posted_date": F.date_format(F.lit(P.RUN_DATE).cast("date"), vocab.POSTED_DATE_FORMAT),
    })
    return clean.add_metadata(o, {"scraped_at": P.RUN_TS, "source": vocab.DOCUMENT_SOURCE})


def link_discovery(spark, sf_dir):
    return extract.discover_links(heavy(spark, sf_dir, "pages"), href_substring=P.PAGE_HREF)


def link_cap(spark, sf_dir):
    links = extract.discover_links(heavy(spark, sf_dir, "pages"), href_substring=P.PAGE_HREF)
    return extract.cap_links(links, P.PAGE_LINK_CAP)


def safe_extract(spark, sf_dir):
    d = heavy(spark, sf_dir, "documents")
    value, err = extract.safe_number("text", P.DOC_LONG_NUMBER)
    # shown as text: a nullable bigint would reach pandas as float64
    return d.select("doc_id", value.cast("string").alias("amount"), err.alias("parse_error"))


PAGE_PARAMS = dict(cities=P.DOC_FIRST_WORDS, skills=P.DOC_TAG_WORDS, responsibilities=P.DOC_LABELS,
                   company_href=P.PAGE_HREF, full_time_phrase=P.PAGE_PHRASE,
                   experience_pattern=P.PAGE_LOWER_PATTERN, education_pattern=P.PAGE_CASE_PATTERN,
                   salary_pattern=P.PAGE_AMOUNT_PATTERN, run_date=P.RUN_DATE)


def _pages_and_empty(spark, sf_dir):
    """All pages, and copies of some that came without HTML (NULL) or with none in it (empty)."""
    pages = heavy(spark, sf_dir, "pages")
    lost = F.col("page_id") % P.PAGE_REJECT_EVERY
    copies = table(spark, sf_dir, "pages").filter(lost < 2).withColumn(
        "html", F.when(lost == 1, F.lit("")))
    return pages.unionByName(copies)


def extract_postings(spark, sf_dir):
    """A posting row of every page; the copies without HTML give none."""
    return extract.extract_postings(_pages_and_empty(spark, sf_dir), keep=("page_id",),
                                    **PAGE_PARAMS)


def rejects(spark, sf_dir):
    return extract.rejected_pages(_pages_and_empty(spark, sf_dir))


def page_location_share(spark, sf_dir):
    """Pages -> posting rows -> cleaning chain -> title category -> share of
    each (location, category) among the kept postings."""
    postings = extract.extract_postings(heavy(spark, sf_dir, "pages"), keep=("page_id",),
                                        **PAGE_PARAMS)
    cleaned = clean.clean_postings(compute_once(postings), require_salary=False)
    keyed = cleaned.withColumn("location_category",
                               F.concat_ws(" / ", "location", "keyword_category"))
    return report.value_share(keyed, "location_category")


# --- C: cleaning -----------------------------------------------------------

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def required_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    o = clean.require_present(o, ["o_orderstatus"], P.STATUS_SENTINEL)
    return clean.require_complete(o, {"o_orderpriority": P.PRIORITY_SENTINEL})


def _nullified_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o = clean.replace_with_null(o, P.PRIORITY_SENTINEL, ["o_orderpriority"])
    return clean.replace_with_null(o, P.STATUS_SENTINEL, ["o_orderstatus"])


def fill_nulls(spark, sf_dir):
    return clean.fill_missing(_nullified_orders(spark, sf_dir),
                              {"o_orderpriority": vocab.NOT_STATED, "o_orderstatus": vocab.UNKNOWN})


def replace_value(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return clean.replace_value(o, P.PRIORITY_SENTINEL, vocab.UNKNOWN, ["o_orderpriority"])


def replace_null(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return clean.replace_with_null(o, P.PRIORITY_SENTINEL, ["o_orderstatus", "o_orderpriority"])


def any_present(spark, sf_dir):
    return clean.any_present(_nullified_orders(spark, sf_dir), ["o_orderpriority", "o_orderstatus"])


def missing_rate(spark, sf_dir):
    return clean.missing_report(_nullified_orders(spark, sf_dir), ["o_orderpriority", "o_orderstatus"])


def _part_categories(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return clean.add_category(p, "p_name", "category", P.PART_RULES, P.PART_DEFAULT)


def category_share(spark, sf_dir):
    return report.value_share(_part_categories(spark, sf_dir), "category")


def presence_flag(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    o = clean.add_presence_flag(o, "o_orderpriority", "has_priority", P.PRIORITY_SENTINEL)
    return o.select("o_orderkey", "o_orderpriority", "has_priority")


# --- A / W / T / J: reports ------------------------------------------------

def value_share(spark, sf_dir):
    return report.value_share(table(spark, sf_dir, "orders"), "o_orderpriority")


def value_share_customer(spark, sf_dir):
    return report.value_share(table(spark, sf_dir, "orders"), "o_custkey")


def topk_with_set(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("string").alias("order_day"),
                                              "o_orderpriority")
    top = report.top_k_with_set(o, "order_day", "o_orderpriority", 40, set_col="priorities")
    return top.withColumn("priorities", F.array_join("priorities", ","))


def status_count(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    label = (F.when(F.col("o_orderpriority") != P.PRIORITY_SENTINEL, F.lit("Priority stated"))
             .otherwise(F.lit("Priority not stated")))
    return report.label_counts(o, label, "priority_status")


def two_key_count(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return report.pair_counts(c, "c_nationkey", "c_mktsegment",
                              where=F.col("c_mktsegment") != "HOUSEHOLD")


def group_counts(spark, sf_dir):
    return report.group_counts(table(spark, sf_dir, "lineitem"), "l_returnflag")


def attribute_counts(spark, sf_dir):
    return report.attribute_counts(table(spark, sf_dir, "orders"), "o_orderstatus",
                                   ["o_orderpriority", "o_custkey"])


def distinct_counts(spark, sf_dir):
    return report.distinct_counts(table(spark, sf_dir, "orders"),
                                  ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])


def _part_flags(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.withColumns({
        "big_size": (F.col("p_size") > P.PART_SIZE_CUT).cast("int"),
        "premium": (F.col("p_retailprice") > P.PART_PRICE_CUT).cast("int"),
    })


def conditional_rate(spark, sf_dir):
    return report.conditional_rate(table(spark, sf_dir, "part"), "p_brand",
                                   F.col("p_size") > P.PART_SIZE_CUT)


def flag_rate(spark, sf_dir):
    return report.flag_rate(_part_flags(spark, sf_dir), "p_type", "premium")


def mode_per_group(spark, sf_dir):
    return report.group_mode(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment",
                             out="mode_segment")


def mean_pct(spark, sf_dir):
    return report.mean_percent(_part_flags(spark, sf_dir), "p_brand", "big_size", out="pct_big")


def topn_per_group(spark, sf_dir):
    return report.top_n_per_group(table(spark, sf_dir, "orders"), "o_orderstatus", "o_custkey", 5)


def cluster_summary(spark, sf_dir):
    p = _part_flags(spark, sf_dir).withColumn("p_size", F.col("p_size").cast("string"))
    doc = documents.cluster_summary(p, cluster="p_type", category="p_brand", location="p_name",
                                    education="p_size", flag="premium")
    return doc.select("cluster_id", "total_lowongan", "kategori_dominan", "lokasi_dominan",
                      "pendidikan_dominan", "pct_gaji_dicantumkan",
                      report.map_text(F.col("distribusi_kategori")).alias("distribusi_kategori"),
                      report.map_text(F.col("distribusi_lokasi")).alias("distribusi_lokasi"))


def top_companies(spark, sf_dir):
    doc = documents.top_values_document(table(spark, sf_dir, "orders"), "o_orderstatus",
                                        "o_custkey", 5)
    return doc.select("cluster_id", report.map_text(F.col("top_companies")).alias("top_companies"))


def heavy_hitters(spark, sf_dir):
    """T3 by sketch and recount: few values, some frequent ones, and none frequent (all are counted)."""
    li = table(spark, sf_dir, "lineitem")
    parts = [report.heavy_hitters(li, c, 5, tracked=64).select(
        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), "n")
        for c in ("l_returnflag", "l_suppkey", "l_partkey")]
    return functools.reduce(DataFrame.unionByName, parts)


def sorted_distinct(spark, sf_dir):
    return report.sorted_distinct(table(spark, sf_dir, "orders"), "o_orderpriority")


def table_profile(spark, sf_dir):
    return profile.table_profile(table(spark, sf_dir, "orders"),
                                 sentinels=(P.PRIORITY_SENTINEL, vocab.NOT_FOUND))


def topk_semijoin(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return report.keep_top_k(o, "o_custkey", 5)


# --- V: chart tables -------------------------------------------------------

def pivot_counts(spark, sf_dir):
    return tables.contingency(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority",
                              P.PRIORITIES)


def pivot_top_counts(spark, sf_dir):
    return tables.contingency_top_k(table(spark, sf_dir, "orders"), "o_orderpriority",
                                    "o_custkey", 5)


def pivot_top_nulls(spark, sf_dir):
    """The most frequent priorities among values of which many are NULL."""
    return tables.contingency_top_k(_nullified_orders(spark, sf_dir), "o_orderstatus",
                                    "o_orderpriority", 3)


def binary_split(spark, sf_dir):
    return tables.binary_split(_part_flags(spark, sf_dir), "p_brand", "big_size")


def stack_offsets(spark, sf_dir):
    counts = report.pair_counts(table(spark, sf_dir, "orders"), "o_orderstatus",
                                "o_orderpriority", order=False)
    return tables.stack_offsets(counts, "o_orderstatus", "o_orderpriority")


# --- M: features and clustering --------------------------------------------

def index_freq(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return features.index_labels(p, ["p_type"], ["type_idx"])


def index_alpha(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return features.index_labels(p, ["p_brand"], ["brand_idx"], order="alphabetAsc")


def index_many(spark, sf_dir):
    """Codes of a column with about as many labels as customers."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    return features.index_labels(o, ["customer"], ["customer_idx"])


def feature_vectors(spark, sf_dir):
    """M4: indexed categories and a number, assembled and scaled."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    _, out = features.fit_features(p, ["p_type", "p_brand"], ["t", "b"], ["p_size"])
    z = vector_to_array("features")
    return out.select("p_partkey", *[F.round(z[i], 6).alias(f"z{i}") for i in range(3)])


def standardize(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    out = features.standardize_columns(p, ["p_size", "p_retailprice"], digits=6)
    return out.select("p_partkey", "z_p_size", "z_p_retailprice")


def _embedding_features(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", array_to_vector("embedding").alias("features"))


def elbow(spark, sf_dir):
    return cluster.elbow(_embedding_features(spark, sf_dir), range(2, 8), seed=42, max_iter=20)


def kmeans_assign(spark, sf_dir):
    _, out = cluster.kmeans_assign(_embedding_features(spark, sf_dir), k=4, seed=42, max_iter=50)
    return out.select("vec_id", "label", "cluster")


def cluster_quality(spark, sf_dir):
    feats = _embedding_features(spark, sf_dir)
    model, out = cluster.kmeans_assign(feats, k=4, seed=42, max_iter=50)
    return cluster.model_quality(model, out)


def pca_scores(spark, sf_dir):
    _, out = features.pca_scores(_embedding_features(spark, sf_dir), "features", 2,
                                 keep=("vec_id", "label"))
    return out


def pca_variance(spark, sf_dir):
    model, _ = features.pca_projection(_embedding_features(spark, sf_dir), "features", 2)
    return features.explained_variance(model, spark)


def _plane(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return features.assembler(["p_size", "p_retailprice"], "features").transform(p)


def pca_plane(spark, sf_dir):
    """Scores on the two components of a two-column table; the sign is the one
    that makes the component's loading on the price positive."""
    model, out = features.pca_scores(_plane(spark, sf_dir), "features", 2, keep=("p_partkey",))
    sign = [1.0 if model.pc[1, i] >= 0 else -1.0 for i in range(2)]
    return out.select("p_partkey", *[F.round(F.col(f"pc{i + 1}") * sign[i], 4).alias(f"pc{i + 1}")
                                     for i in range(2)])


def pca_plane_variance(spark, sf_dir):
    model, _ = features.pca_projection(_plane(spark, sf_dir), "features", 2)
    return features.explained_variance(model, spark).withColumn("ratio", F.round("ratio", 8))


def _groups(spark, sf_dir):
    """Line items as points around far apart places, one per return flag."""
    place = (F.ascii("l_returnflag") * 10_000).cast("double")
    rows = heavy(spark, sf_dir, "lineitem").select("l_returnflag", (place + F.col("l_quantity")).alias("x"))
    return features.assembler(["x"], "features").transform(rows)


def _fitted_groups(spark, sf_dir):
    points = _groups(spark, sf_dir)
    return cluster.kmeans_assign(points, k=points.select("l_returnflag").distinct().count(), seed=42, max_iter=50)


def kmeans_groups(spark, sf_dir):
    """Clusters of well separated points, numbered by the least point in them."""
    _, out = _fitted_groups(spark, sf_dir)
    least = out.groupBy("cluster").agg(F.min("x").alias("low"))
    number = least.select("cluster", F.row_number().over(Window.orderBy("low")).cast("int").alias("number"))
    return (out.join(F.broadcast(number), "cluster")  # k rows
            .groupBy("number", "l_returnflag").agg(F.count(F.lit(1)).alias("n")))


def cluster_quality_groups(spark, sf_dir):
    model, out = _fitted_groups(spark, sf_dir)
    return cluster.model_quality(model, out).select(
        "k", F.round("training_cost", 2).alias("training_cost"), F.round("silhouette", 8).alias("silhouette"))


def elbow_groups(spark, sf_dir):
    """Sweep over points around three places of unlike distances, so that k = 2 and k = 3 have one best split."""
    place = F.element_at(F.create_map(*[F.lit(x) for v, at in P.PRIORITY_PLACES.items() for x in (v, at)]),
                         F.col("o_orderpriority"))
    points = table(spark, sf_dir, "orders").select((place + F.col("o_orderkey") % 5).alias("x"))
    return cluster.elbow(features.assembler(["x"], "features").transform(points), (2, 3), digits=1)


# --- S: sinks and read-back ------------------------------------------------

_SINKS = ("csv", "json", "parquet")


def _through(spark, df, schema, fmt, path):
    """Write with the sink of ``fmt`` and read back."""
    if fmt == "csv":
        files.write_csv(df, path)
        return files.read_csv(spark, path, schema)
    if fmt == "json":
        files.write_json(df, path)
        return files.read_json(spark, path, schema)
    df.write.mode("overwrite").parquet(path)
    return files.read_documents(spark, path)


def sink_roundtrip(spark, sf_dir):
    """Every order, all columns, as each sink gives it back."""
    o = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "orders")
    parts = [_through(spark, o, o.schema, fmt, f"{root}/{fmt}").withColumn("sink", F.lit(fmt)) for fmt in _SINKS]
    out = functools.reduce(DataFrame.unionByName, parts).select("sink", *o.columns)
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def text_roundtrip(spark, sf_dir):
    """Every document text, some with quotes, line breaks and edge spaces, as each sink gives it back.

    Empty strings and NULLs are rows of their own, under the negative ids ``-1 - doc_id``.
    """
    t, turn = F.col("text"), F.col("doc_id") % 5
    hard = (F.when(turn == 0, F.concat(F.lit(' "'), t, F.lit('"\n')))
            .when(turn == 3, F.concat(F.lit("\\,"), t, F.lit("\r\n "))).otherwise(t))
    d = heavy(spark, sf_dir, "documents").select("doc_id", hard.alias("text"), "lang")
    bare = table(spark, sf_dir, "documents").filter(turn.isin(1, 2)).select(
        (F.lit(-1) - F.col("doc_id")).alias("doc_id"), F.when(turn == 1, F.lit("")).alias("text"), "lang")
    d = d.unionByName(bare)
    root = scratch_path(spark, "texts")
    parts = [_through(spark, d, d.schema, fmt, f"{root}/{fmt}").withColumn("sink", F.lit(fmt)) for fmt in _SINKS]
    # compared by length and digest: DuckDB views hold the same values
    return functools.reduce(DataFrame.unionByName, parts).select(
        "sink", "doc_id", F.coalesce(F.length("text"), F.lit(-1)).alias("n"),
        F.md5(F.coalesce(F.col("text"), F.lit("NULL"))).alias("digest"))


def json_arrays(spark, sf_dir):
    """Orders written as JSON arrays of up to 1,000 and read back."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    path = scratch_path(spark, "arrays")
    files.write_json_arrays(o, path, F.floor(F.col("o_orderkey") / 1000))
    return files.read_json(spark, path, o.schema)


def malformed_records(spark, sf_dir):
    """Every order as a CSV line, and beside it a line that is short, long or does not parse: rows and rejects."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    fields = [F.col(c).cast("string") for c in o.columns[:3]]
    bad = (F.when(F.col("o_orderstatus") == "F", F.concat_ws(",", *fields[:2]))
           .when(F.col("o_orderstatus") == "O", F.concat_ws(",", *fields, F.lit("more")))
           .otherwise(F.concat(F.lit("x"), F.concat_ws(",", *fields))))
    lines = o.select(F.explode(F.array(F.concat_ws(",", *fields), bad)).alias("value"))
    path = scratch_path(spark, "malformed")
    lines.write.text(path)
    rows, rejects = files.read_checked(spark, path, o.drop("o_orderstatus").schema, header=False)
    return rows.withColumn("raw", F.lit(None).cast("string")).unionByName(
        rejects.select("raw"), allowMissingColumns=True)


def collection_counts(spark, sf_dir):
    """Replaced twice, a collection holds the rows of the last writing."""
    root = scratch_path(spark, "collections")
    o = table(spark, sf_dir, "orders")
    collections.write_collections({"orders": o, "shares": o.limit(3)}, root)
    collections.write_collections({"shares": report.value_share(o, "o_orderpriority", order=False)}, root)
    return collections.count_collections(spark, root, ["orders", "shares"])


def documents_view(spark, sf_dir):
    """Documents written with an ``_id``, read without it and queried as a view."""
    c = table(spark, sf_dir, "customer").withColumn("_id", F.md5(F.col("c_custkey").cast("string")))
    path = collections.replace_collection(c, scratch_path(spark, "view"), "customers")
    files.register_view(files.read_documents(spark, path), "customer_documents")
    return spark.sql("SELECT * FROM customer_documents")


def first_rows(spark, sf_dir):
    """T4: the first rows in key order."""
    return profile.head(table(spark, sf_dir, "orders").drop("o_orderdate").orderBy("o_orderkey"), 20)


QUERIES: dict[str, Query] = {
    "normalize_ws": normalize_ws,
    "html_text": html_text,
    "html_h1": html_h1,
    "html_anchor": html_anchor,
    "first_match": first_match,
    "flag_text": flag_text,
    "regex_first": regex_first,
    "amount_range": amount_range,
    "amount_range_no_fraction": amount_range_no_fraction,
    "money_format": money_format,
    "keyword_tags": keyword_tags,
    "keyword_tags_whole_word": keyword_tags_whole_word,
    "keyword_label": keyword_label,
    "const_columns": const_columns,
    "link_discovery": link_discovery,
    "link_cap": link_cap,
    "safe_extract": safe_extract,
    "extract_postings": extract_postings,
    "page_location_share": page_location_share,
    "required_filter": required_filter,
    "fill_nulls": fill_nulls,
    "replace_value": replace_value,
    "replace_null": replace_null,
    "any_present": any_present,
    "missing_rate": missing_rate,
    "category_share": category_share,
    "presence_flag": presence_flag,
    "value_share": value_share,
    "value_share_customer": value_share_customer,
    "topk_with_set": topk_with_set,
    "status_count": status_count,
    "two_key_count": two_key_count,
    "group_counts": group_counts,
    "attribute_counts": attribute_counts,
    "distinct_counts": distinct_counts,
    "conditional_rate": conditional_rate,
    "flag_rate": flag_rate,
    "mode_per_group": mode_per_group,
    "mean_pct": mean_pct,
    "topn_per_group": topn_per_group,
    "cluster_summary": cluster_summary,
    "top_companies": top_companies,
    "heavy_hitters": heavy_hitters,
    "sorted_distinct": sorted_distinct,
    "table_profile": table_profile,
    "topk_semijoin": topk_semijoin,
    "pivot_counts": pivot_counts,
    "pivot_top_counts": pivot_top_counts,
    "pivot_top_nulls": pivot_top_nulls,
    "binary_split": binary_split,
    "stack_offsets": stack_offsets,
    "index_freq": index_freq,
    "index_alpha": index_alpha,
    "standardize": standardize,
    "elbow": elbow,
    "kmeans_assign": kmeans_assign,
    "cluster_quality": cluster_quality,
    "pca_scores": pca_scores,
    "pca_variance": pca_variance,
    "index_many": index_many,
    "feature_vectors": feature_vectors,
    "pca_plane": pca_plane,
    "pca_plane_variance": pca_plane_variance,
    "kmeans_groups": kmeans_groups,
    "cluster_quality_groups": cluster_quality_groups,
    "elbow_groups": elbow_groups,
    "rejects": rejects,
    "sink_roundtrip": sink_roundtrip,
    "text_roundtrip": text_roundtrip,
    "json_arrays": json_arrays,
    "malformed_records": malformed_records,
    "collection_counts": collection_counts,
    "documents_view": documents_view,
    "first_rows": first_rows,
}
