"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets the key of Efraimidis and Spirakis in its exponential form:
``-ln(u) / weight`` with a uniform ``u`` that the document alone decides, so
documents of higher quality weight come early.  Within its source the documents
stand in key order and a prefix sum of their sizes is cut at the source's token
budget.  A budget above the source's size takes complete epochs first and the
rest by key order.  Only DataFrame functions are used.

The prefix sum never sorts a source in one task: keys fall in ranges, whose
width follows the number of rows; range totals give the range in which the
budget ends, ranges before it are taken whole, and only the rows of that one
range are put in order.  Ranges are cut evenly in the logarithm of the key: that
logarithm is ``ln(-ln(u))`` shifted by the weight, whose density is ``1/e`` at most,
so no range holds a larger share than its width over ``e``, whatever the weights are.

Cases: a null text has size 0 and is taken 0 times; a null source is a source
of its own and stands last; repeated rows are documents of their own; ties in
the key are broken by doc_id, then size; an empty table gives an empty result;
extra columns are ignored; a missing weight column is not needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import carried, cut, uniform

WORD = r"[^\x20\x09-\x0D]+"
#: Expected rows of the fullest key range, at most, if all rows were of one source; the
#: fullest range holds one part of ``LEAST_RANGES`` of a source at most.
ROWS_PER_RANGE, LEAST_RANGES = 100_000, 1024
#: Sources up to this many are joined by broadcast (about 100 bytes each); more are shuffled.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def noise_weight(text: Column) -> Column:
    """Default quality weight in (0, 1]: falls with the share of symbol noise."""
    noisy = F.regexp_count(text, F.lit(r"[!#$%&*|]"))
    share = noisy / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.lit(1.0) / (F.lit(1.0) + F.lit(10.0) * share), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], total_share: float,
                   most_epochs: float) -> DataFrame:
    """``source, source_size, target`` from one row ``source, source_size`` per source.

    Weights repeat along the sources in code-point order, null last.  Targets
    share ``total_share`` of all sizes by weight; what lies above ``most_epochs``
    times a source's size is reshared by weight until no target is above, which
    is one level: target = min(cap, level * weight), solved by prefix sums over
    the sources in the order in which they reach their caps.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    t = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(most_epochs))
    whole = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    t = (t.withColumn("total", F.sum("source_size").over(whole) * float(total_share))
         .withColumn("all_w", F.sum("w").over(whole))
         .withColumn("full", F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0)))
         .withColumn("full_w", F.coalesce(F.sum("w").over(by_cap), F.lit(0.0))))
    # The level if exactly the sources before this one are at their caps.
    t = t.withColumn("level", (F.col("total") - F.col("full")) / (F.col("all_w") - F.col("full_w")))
    open_ = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"),
                         F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(whole)
    target = F.least(F.col("cap"), F.coalesce(open_["level"] * F.col("w"), F.col("cap")))
    return t.select("source", "source_size", target.alias("target"))


def _keyed(docs: DataFrame, seed: int, quality: Column | None) -> DataFrame:
    """The rows with ``_source, _size, _key`` added."""
    weight = noise_weight(F.col("text")) if quality is None else quality
    draw = uniform(F.col("doc_id"), F.xxhash64("text"), F.lit(seed))  # rows without an id differ by text
    key = -F.log(draw) / F.greatest(weight, F.lit(1e-9))
    return docs.withColumns({"_source": F.col("source").cast("string"),
                             "_size": word_count(F.col("text")), "_key": key})


def _ranges(slim: DataFrame, wanted: int | None) -> int:
    """The least number of key ranges for the (checkpointed) rows."""
    return wanted or max(LEAST_RANGES, math.ceil(slim.count() / ROWS_PER_RANGE))


def _in_ranges(rows: DataFrame, n: int) -> DataFrame:
    """``_bucket``: the range of the key, in key order; a range holds one n-th of a source's rows at most."""
    return rows.withColumn("_bucket", F.floor(F.log("_key") * F.lit(n / math.e)).cast("long"))


#: Order of the rows of a source.
_ORDER = ("_key", "doc_id", "_size")


def _plan(slim: DataFrame, weights: tuple[float, ...], total_share: float, most_epochs: float) -> DataFrame:
    """Per source: size, target, whole epochs, rest, the range in which the rest ends, words before it."""
    part = cut(slim.groupBy("_source", "_bucket").agg(F.sum("_size").alias("part")))
    targets = source_targets(part.groupBy(F.col("_source").alias("source")).agg(
        F.sum("part").alias("source_size")), weights, total_share, most_epochs)
    budget = F.round("target").cast("long")
    targets = targets.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    targets = cut(targets.withColumn("rest", budget - F.col("epochs") * F.col("source_size")))
    run = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = part.withColumn("before", F.coalesce(F.sum("part").over(run), F.lit(0))).join(
        targets, F.col("_source").eqNullSafe(F.col("source")))
    ends = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("part"))
    edge = ranges.filter(ends).groupBy(F.col("_source").alias("edge_source")).agg(
        F.min("_bucket").alias("edge"), F.min("before").alias("before"))
    plan = targets.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")
    return cut(plan.withColumnRenamed("source", "its_source"))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    few = plan.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(plan) if few else plan, F.col("_source").eqNullSafe(F.col("its_source")), "left")


def _edge_rows(rows: DataFrame) -> DataFrame:
    """The rows of each source's range in which the rest ends, with the words ``ahead`` of each."""
    order = Window.partitionBy("_source").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    at_edge = rows.filter(F.col("_bucket") == F.col("edge"))
    return at_edge.withColumn("ahead", F.col("before") + F.coalesce(F.sum("_size").over(order), F.lit(0)))


def mix_sources(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5,
                most_epochs: float = 2.0, seed: int = 17, key_ranges: int | None = None,
                quality: Column | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, taken`` of every document.

    ``taken`` counts the words the mix takes: complete epochs times the size,
    plus what the fractional selection takes; the document in which the budget
    ends gives the words up to it.
    """
    slim = cut(_keyed(docs.select("doc_id", "source", "text"), seed, quality).select("_source", *_ORDER))
    slim = _in_ranges(slim, _ranges(slim, key_ranges))
    rows = _with_plan(slim, _plan(slim, weights, total_share, most_epochs))
    base = F.col("epochs") * F.col("_size")
    rest = F.when(F.col("_bucket") < F.col("edge"), F.col("_size")).otherwise(0)
    partial = F.least(F.greatest(F.col("rest") - F.col("ahead"), F.lit(0)), F.col("_size"))
    out = lambda df, taken: df.select(
        "doc_id", F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size", "target",
        "epochs", taken.cast("long").alias("taken"))
    elsewhere = rows.filter(~F.coalesce(F.col("_bucket") == F.col("edge"), F.lit(False)))
    return out(elsewhere, base + rest).unionByName(out(_edge_rows(rows), base + partial))


def mixed_documents(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5,
                    most_epochs: float = 2.0, seed: int = 17, key_ranges: int | None = None,
                    quality: Column | None = None) -> DataFrame:
    """The mix as whole documents, all columns (of any name): a document stands there once per epoch that takes it.

    The document in which a source's budget ends is taken whole.
    """
    needed = ["doc_id", "source", "text"] + ([] if quality is None else [quality.alias("_weight")])
    keyed = _keyed(carried(docs, *needed), seed, None if quality is None else F.col("_weight"))
    slim = cut(keyed.select("_source", *_ORDER))
    n = _ranges(slim, key_ranges)
    keyed, slim = _in_ranges(keyed, n), _in_ranges(slim, n)
    plan = _plan(slim, weights, total_share, most_epochs)
    place = F.struct(*_ORDER)
    last = _edge_rows(_with_plan(slim, plan)).filter("ahead < rest").groupBy(
        F.col("_source").alias("last_source")).agg(F.max(place).alias("last"))
    plan = cut(plan.join(last, F.col("its_source").eqNullSafe(F.col("last_source")), "left").drop("last_source"))
    taken = (F.col("_bucket") < F.col("edge")) | ((F.col("_bucket") == F.col("edge")) & (place <= F.col("last")))
    copies = F.col("epochs") + F.coalesce(taken, F.lit(False)).cast("long")
    return _with_plan(keyed, plan).withColumn("_copies", copies).filter("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")
