"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards, with room for a fixed number of children at
each node.  A key draws an exponential variate ``-ln(u(key, node)) / weight`` once per
region and goes to the least; there it draws once per rack, and in the rack once per
shard.  A node's weight is that of all its places.

A region or rack whose places are all filled by shards of weight 1 competes with its own
draw alone.  One with free places or other weights is opened first: a child's draw is
``draw(node) + e(child) - min(e)`` with the draws ``e`` that a descent into the node would
compare.  As exponential draws have no memory, the least of the children's draws is the
node's own and each is exponential with the child's weight; so opening a node changes no
choice among shards that stay, and a free place leaves the rest as it is.  A shard of weight
``w`` divides its draw by ``w``.  When a weight grows or a shard is added, keys move only into
that region, that rack and that shard; when a weight shrinks, only keys of that shard leave.
Only DataFrame functions are used.

Slots number the rows of a shard from 0 without gaps: rows are counted per
(shard, sub-bucket), counts are prefix-summed over the sub-buckets, and rows are
numbered inside a sub-bucket only, so no task orders a whole shard.  The number of
sub-buckets follows the number of rows.

Cases: a null text has no bytes and checksum 0; a null doc_id is a key of its
own; equal keys share a shard; rows that agree in doc_id, size and checksum are
interchangeable; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut, uniform

#: Rows of a sub-bucket on average, at most; fewest sub-buckets of a shard.
ROWS_PER_BUCKET, LEAST_BUCKETS = 100_000, 64
#: Start tables up to this many rows are joined by broadcast (about 30 bytes each); larger ones are shuffled.
BROADCAST_STARTS = 100_000
#: (region, rack) of shard i: racks of 4 shards, regions of 2 racks.
SHARDS_PER_RACK, RACKS_PER_REGION = 4, 2


def tree(n_shards: int, weights: dict[int, float] | None = None) -> list[list[list[tuple[int, float]]]]:
    """Regions of racks of ``(shard, weight)``; shard ids fill racks in order."""
    weights = weights or {}
    leaves = [(i, float(weights.get(i, 1.0))) for i in range(n_shards)]
    if any(w <= 0 for _, w in leaves):
        raise ValueError("shard weights must be above 0")
    racks = [leaves[i:i + SHARDS_PER_RACK] for i in range(0, len(leaves), SHARDS_PER_RACK)]
    return [racks[i:i + RACKS_PER_REGION] for i in range(0, len(racks), RACKS_PER_REGION)]


#: Places below a region, a rack and a shard: their weights in the tree of equal shards.
_PLACES = (SHARDS_PER_RACK * RACKS_PER_REGION, SHARDS_PER_RACK, 1)
#: Children of a region and of a rack.
_CHILDREN = (RACKS_PER_REGION, SHARDS_PER_RACK)


def _draw(key: Column, level: int, node: Column, seed: int) -> Column:
    """The key's exponential draw at node number ``node`` of a level (0 regions, 1 racks, 2 shards)."""
    return -F.log(uniform(key, F.lit(level), node, F.lit(seed))) / F.lit(float(_PLACES[level]))


def _child(key: Column, level: int, node: Column, seed: int) -> Column:
    """The child of least draw of a node."""
    children = [node * F.lit(_CHILDREN[level]) + F.lit(i) for i in range(_CHILDREN[level])]
    return F.array_min(F.array(*[F.struct(_draw(key, level + 1, c, seed).alias("draw"), c.alias("node"))
                                 for c in children]))["node"]


def _rivals(key: Column, level: int, node: int, draw: Column, weights: dict[int, float], seed: int) -> list[Column]:
    """``struct(draw, level, node)`` of the node if it is whole, else of the whole nodes below it."""
    first = node * _PLACES[level]
    held = [weights.get(i) for i in range(first, first + _PLACES[level])]
    if all(w is None for w in held):
        return []
    if level == 2 or all(w == 1.0 for w in held):
        own = draw if level < 2 else draw / F.lit(held[0])
        return [F.struct(own.alias("draw"), F.lit(level).alias("level"), F.lit(node).alias("node"))]
    below = [node * _CHILDREN[level] + i for i in range(_CHILDREN[level])]
    e = [_draw(key, level + 1, F.lit(c), seed) for c in below]
    return [r for c, x in zip(below, e)
            for r in _rivals(key, level + 1, c, draw + x - F.array_min(F.array(*e)), weights, seed)]


def descend(regions: list[list[list[tuple[int, float]]]], key: Column, seed: int = 29) -> Column:
    """The shard of ``key``: region, then rack, then shard of least draw."""
    weights = {i: w for racks in regions for rack in racks for i, w in rack}
    rivals = [r for n in range(len(regions))
              for r in _rivals(key, 0, n, _draw(key, 0, F.lit(n), seed), weights, seed)]
    best = F.array_min(F.array(*rivals))
    rack = F.when(best["level"] == 0, _child(key, 0, best["node"], seed)).otherwise(best["node"])
    return F.when(best["level"] == 2, best["node"]).otherwise(_child(key, 1, rack, seed))


def assign_shards(docs: DataFrame, n_shards: int = 24, *, weights: dict[int, float] | None = None,
                  seed: int = 29, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 8; ``grown_shard`` is the shard in
    the tree with one more shard of weight 1.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.col("doc_id")
    rows = cut(docs.select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        descend(tree(n_shards, weights), key, seed).alias("shard"),
        descend(tree(n_shards + 1, weights), key, seed).alias("grown_shard"),
        F.xxhash64("doc_id", body, F.lit(seed + 1)).alias("spot")))
    sub_buckets = max(LEAST_BUCKETS, math.ceil(rows.count() / n_shards / rows_per_bucket))
    rows = rows.withColumn("sub", F.pmod("spot", F.lit(sub_buckets)))
    run = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "sub").agg(F.count("*").alias("n")).select(
        "shard", "sub", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "sub").orderBy("doc_id", "text_crc32", "size")
    few = n_shards * sub_buckets <= BROADCAST_STARTS
    return rows.withColumn("place", F.row_number().over(inside) - 1).join(
        F.broadcast(starts) if few else starts, ["shard", "sub"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("place")).cast("long").alias("slot"), "grown_shard")
