"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct 4-word shingles (64-bit hashes).  Two
documents link when ``100 * |A and B| >= 85 * |A or B|``; the result is the
smallest doc_id that links reach.

1. Equal sets are one class; classes stand for their documents from then on.
2. Shingle hashes are routed to buckets as packed sorted arrays and each gets its
   document frequency over the classes.  Shingles of one class only cannot be
   common to two, so a class keeps its shared shingles; a class whose shared
   shingles are under 85 % of its set has no partner.
3. Classes that share one of their rarest shingles - as many as a partner at the
   threshold could lack, plus one - may link.  Their connected components are
   the clusters in which partners lie.  In a cluster of more than one leaf, each
   class is first verified against one hub a round, the class of a drawn order
   that heads most of its rarest shingles; what links is one part from then on.
4. Shingles hash into 64 groups, and a class is the point of its group counts.  A
   cluster's points are packed into the leaves of an R-tree by size and
   coordinates; the overlap of a point with anything in a node is at most the sum
   of the coordinate minima of the point and the node's upper corner.  Large
   clusters have many leaves, cut from points sorted by part, size and coordinate
   sums, and leaf pairs are joined under the same bound.  A large part has leaves
   of its own, and leaves of one part are not joined: its points still meet all
   points outside it.  Points under a surviving node are bounded one by one, and
   what is left is verified on the shingles themselves.
5. Verified links give the components.  A search starts from a point and takes in
   what links to it, so points already reached are not compared again and a large
   group of near copies yields a spanning tree, not all its pairs.

No step depends on a cap: buckets, leaves and clusters of any size are processed
whole.  Routed shingles keep 52 bits of their hash.

Cases: a null or empty text has no shingles and links with nothing; a text of
fewer than four words is one shingle of all its words; repeated rows and equal
texts are one class; a null doc_id is never a component's id unless nothing else
is reached; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import bytetext as B
from .common import cut, n_buckets, numbered, unused, written

K, NUMERATOR, DENOMINATOR = 4, 85, 100
GROUPS, NODE, LEAF = 64, 16, 256
_ROUNDS = 4
#: Edges that one task takes: what rounds over edges leave in the end, not more, is solved in it.
EDGES = 1 << 16
_RUN_BYTES, _RUN_DOCS, _DOC_BITS = 4 << 20, 4096, 12
U = np.uint64


class ShingleRun:
    """Distinct ``(shingle, document)`` pairs of a run of documents, as sorted packed integers."""

    def __init__(self, data: np.ndarray, off: np.ndarray, k: int):
        w = B.words(data, off, B.NOT_SPACE)
        h, doc = B.shingles(w.hash, w.first, k)
        packed = ((h >> U(_DOC_BITS)) << U(_DOC_BITS)) | doc.astype(U)
        packed.sort()
        if len(packed):
            packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])]
        self.packed, self.n_docs = packed, len(off) - 1
        self.doc = (packed & U((1 << _DOC_BITS) - 1)).astype(np.int64)
        self.size = np.bincount(self.doc, minlength=self.n_docs)
        total = np.zeros(self.n_docs, U)
        np.add.at(total, self.doc, B.mix(packed >> U(_DOC_BITS)))
        #: one value per distinct set
        self.sig = B.mix(total + self.size.astype(U) * U(0x9E3779B97F4A7C15))


def _runs(batch, text_at: int, k: int):
    data, off = B.string_buffers(batch.column(text_at))
    for lo, hi in B.slices(data, off, _RUN_BYTES, _RUN_DOCS):
        yield lo, hi, ShingleRun(data, off[lo:hi + 1], k)


def _classes(k: int):
    def run(batches):
        for batch in batches:
            for lo, hi, r in _runs(batch, 1, k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(r.size, pa.int64()),
                     pa.array(r.sig.view(np.int64), pa.int64())], ["doc_id", "n_shingles", "sig"])
    return run


def set_signatures(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, sig``: equal sets have equal ``sig``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_classes(k), "doc_id long, n_shingles long, sig long")


# --- document frequencies -------------------------------------------------------------------


def _planes(sorted_: np.ndarray) -> bytes:
    """Sorted integers as differences in byte planes, high planes left out."""
    d = np.diff(sorted_, prepend=U(0))
    if len(d):
        d[0] = sorted_[0]
    most = int(d[1:].max()) if len(d) > 1 else 0
    p = max(1, (most.bit_length() + 7) // 8)
    first = int(d[0]) if len(d) else 0
    rest = d[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :p]
    return bytes([p]) + first.to_bytes(8, "little") + np.ascontiguousarray(rest.T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    p, first = raw[0], int.from_bytes(raw[1:9], "little")
    body = np.frombuffer(raw, np.uint8, offset=9).reshape(p, -1)
    d = np.zeros((body.shape[1] + 1, 8), np.uint8)
    d[1:, :p] = body.T
    out = d.view("<u8").ravel().astype(U)
    out[0] = first
    return np.cumsum(out, dtype=U)


def _route(bits: int, k: int):
    def run(batches):
        for batch in batches:
            for _, _, r in _runs(batch, 0, k):
                sigs, at = np.unique(r.sig, return_index=True)
                one = np.zeros(r.n_docs, bool)
                one[at] = True  # of equal sets in a run one is routed
                packed = r.packed[one[r.doc]]
                if not len(packed):
                    continue
                edges = np.searchsorted(packed >> U(64 - bits) if bits else np.zeros(len(packed), U),
                                        np.arange((1 << bits) + 1, dtype=U))
                buckets, keys, ids, sizes = [], [], [], []
                for b in range(1 << bits):
                    seg = packed[edges[b]:edges[b + 1]]
                    if not len(seg):
                        continue
                    doc = (seg & U(_RUN_DOCS - 1)).astype(np.int64)
                    has = np.zeros(r.n_docs, bool)
                    has[doc] = True
                    used = np.flatnonzero(has)
                    number = np.cumsum(has) - 1
                    seg = (seg & ~U(_RUN_DOCS - 1)) | number[doc].astype(U)
                    buckets.append(b)
                    keys.append(_planes(seg))
                    ids.append(r.sig[used].tobytes())
                    sizes.append(r.size[used].astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int32()), pa.array(keys, pa.binary()), pa.array(ids, pa.binary()),
                     pa.array(sizes, pa.binary())], ["bucket", "keys", "sigs", "sizes"])
    return run


def _shared(bits: int):
    """Of a bucket: the shingles of two classes or more, packed by the class's home bucket."""
    def run(table: pa.Table) -> pa.Table:
        packed, owner, sigs, sizes, base = [], [], [], [], 0
        for keys, ids, n in zip(table.column("keys"), table.column("sigs"), table.column("sizes")):
            p = _unplanes(keys.as_py())
            sig = np.frombuffer(ids.as_py(), U)
            packed.append(p >> U(_DOC_BITS))
            owner.append((p & U(_RUN_DOCS - 1)).astype(np.int64) + base)
            sigs.append(sig)
            sizes.append(np.frombuffer(n.as_py(), np.int32))
            base += len(sig)
        key, own = np.concatenate(packed), np.concatenate(owner)
        del packed, owner
        sig, at, same = np.unique(np.concatenate(sigs), return_index=True, return_inverse=True)
        size = np.concatenate(sizes)[at]
        order = np.argsort(key)
        key, own = key[order], same[own[order]]
        again = key[1:] == key[:-1]
        multi = np.flatnonzero(np.concatenate([again, [False]]) | np.concatenate([[False], again]))
        key, own = key[multi], own[multi]
        order = np.lexsort((own, key))
        key, own = key[order], own[order]
        if len(key):  # a class in several runs counts once
            keep = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
            key, own = key[keep], own[keep]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
        df = np.repeat(np.diff(edge), np.diff(edge))
        key, own, df = key[df > 1], own[df > 1], df[df > 1]
        order = np.argsort(own, kind="stable")  # by signature, so by home bucket
        key, own, df = key[order], own[order], df[order]
        home = (sig >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(sig), np.int64)
        cols: list[list] = [[], [], [], [], [], []]
        edges = np.searchsorted(home[own], np.arange((1 << bits) + 1)) if len(own) else np.zeros((1 << bits) + 1, int)
        for b in range(1 << bits):
            lo, hi = int(edges[b]), int(edges[b + 1])
            if lo == hi:
                continue
            who, count = np.unique(own[lo:hi], return_counts=True)
            for c, v in zip(cols, (b, sig[who].tobytes(), size[who].astype(np.int32).tobytes(),
                                   count.astype(np.int32).tobytes(), key[lo:hi].tobytes(),
                                   np.minimum(df[lo:hi], 2**31 - 1).astype(np.int32).tobytes())):
                c.append(v)
        return pa.table({"home": pa.array(cols[0], pa.int32()), "sigs": pa.array(cols[1], pa.binary()),
                         "sizes": pa.array(cols[2], pa.binary()), "counts": pa.array(cols[3], pa.binary()),
                         "keys": pa.array(cols[4], pa.binary()), "dfs": pa.array(cols[5], pa.binary())})
    return run


_POINT = "sig long, n int, keys binary, prefix array<long>, low int, even int"


def _least_overlap(a, b):
    """Smallest intersection of sets of a and b shingles that link."""
    return -(-(NUMERATOR * (a + b)) // (NUMERATOR + DENOMINATOR))


def _gather(table: pa.Table) -> pa.Table:
    """Classes that can have a partner, with all their shared shingles and the rarest of them."""
    def cat(name, kind):
        return np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])

    sig, size, count = cat("sigs", U), cat("sizes", np.int32), cat("counts", np.int32)
    key, df = cat("keys", U), cat("dfs", np.int32)
    whole, at, own = np.unique(sig, return_index=True, return_inverse=True)
    size = size[at].astype(np.int64)
    own = np.repeat(own, count)
    order = np.lexsort((key, df, own))
    key, own = key[order], own[order]
    n_shared = np.bincount(own, minlength=len(whole))
    first = np.concatenate([[0], np.cumsum(n_shared)])
    out: list[list] = [[], [], [], [], [], []]
    for i in np.flatnonzero(DENOMINATOR * n_shared >= NUMERATOR * size).tolist():
        mine = key[first[i]:first[i + 1]]
        n = int(size[i])
        lack = n - -(-NUMERATOR * n // DENOMINATOR)  # what a partner may lack at most
        rare = lack + 1 - (n - len(mine))  # shingles of this class only come first
        out[0].append(int(whole[i].astype(np.int64)))
        out[1].append(n)
        out[2].append(np.sort(mine).tobytes())
        out[3].append(mine[:rare].view(np.int64))
        out[4].append(int((mine % U(GROUPS) < U(GROUPS // 2)).sum()))
        out[5].append(int((mine % U(2) == 0).sum()))
    return pa.table({"sig": pa.array(out[0], pa.int64()), "n": pa.array(out[1], pa.int32()),
                     "keys": pa.array(out[2], pa.binary()), "prefix": pa.array(out[3], pa.list_(pa.int64())),
                     "low": pa.array(out[4], pa.int32()), "even": pa.array(out[5], pa.int32())})


# --- R-tree ---------------------------------------------------------------------------------


def count_vector(keys: np.ndarray) -> np.ndarray:
    return np.bincount((keys % U(GROUPS)).astype(np.int64), minlength=GROUPS).astype(np.int32)


class Tree:
    """An R-tree packed from points: nodes of NODE points, upper corners, least sizes."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        total = vectors.sum(axis=1)
        # by size, then along the coordinate sums of ever smaller halves of the groups
        halves = [vectors[:, :GROUPS // 2].sum(axis=1), vectors[:, ::2].sum(axis=1)]
        self.order = np.lexsort((halves[1], halves[0], total, sizes))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        starts = np.arange(0, len(sizes), NODE)
        self.upper = np.maximum.reduceat(self.vectors, starts, axis=0)
        self.least = np.minimum.reduceat(self.sizes, starts)
        self.most = np.maximum.reduceat(self.sizes, starts)

    def search(self, vector: np.ndarray, size: int, free: np.ndarray) -> np.ndarray:
        """Places (in packed order) of the free points whose bound reaches the link overlap."""
        nodes = (DENOMINATOR * self.most >= NUMERATOR * size) & (NUMERATOR * self.least <= DENOMINATOR * size)
        nodes = np.flatnonzero(nodes)
        bound = np.minimum(self.upper[nodes], vector).sum(axis=1)
        nodes = nodes[bound >= _least_overlap(size, self.least[nodes])]
        at = (nodes[:, None] * NODE + np.arange(NODE)).ravel()
        at = at[at < len(self.sizes)]
        at = at[free[at]]
        bound = np.minimum(self.vectors[at], vector).sum(axis=1)
        return at[bound >= _least_overlap(size, self.sizes[at])]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the sorted keys of b are among the sorted keys of a."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[at] == b).sum())


def _links(sigs: list[int], sizes: np.ndarray, keys: list[np.ndarray], parts: list[int]) -> list[tuple[int, int]]:
    """Links that, with the parts already linked, connect all points that any links connect."""
    tree = Tree(np.stack([count_vector(k) for k in keys]), sizes)
    free = np.ones(len(sigs), bool)
    place = np.argsort(tree.order)
    members: dict[int, list[int]] = {}
    for i, part in enumerate(parts):
        members.setdefault(part, []).append(i)
    out = []
    for start in members:
        if not free[place[members[start][0]]]:
            continue
        queue = list(members[start])
        free[place[queue]] = False
        while queue and free.any():
            i = queue.pop()
            mine, n = keys[i], int(sizes[i])
            for p in tree.search(tree.vectors[place[i]], n, free).tolist():
                j = int(tree.order[p])
                if free[p] and _common(mine, keys[j]) >= _least_overlap(n, int(sizes[j])):
                    with_it = members[parts[j]]
                    free[place[with_it]] = False
                    queue += with_it
                    out.append((sigs[i], sigs[j]))
    return out


_BODY = ["sigs", "sizes", "parts", "lengths", "points"]
_LEAF = ("cluster long, band int, own long, leaf long, upper array<int>, least int, most int, sigs binary, "
         "sizes binary, parts binary, lengths binary, points binary")


def _leaf(cluster: int, band: int, own: int | None, leaf: int, rows: list[tuple[int, int, bytes, int]]) -> dict:
    """A leaf of points ``sig, n, keys, part``."""
    keys = [np.frombuffer(r[2], U) for r in rows]
    n = np.array([r[1] for r in rows], np.int32)
    return {"cluster": cluster, "band": band, "own": own, "leaf": leaf,
            "upper": np.max([count_vector(k) for k in keys], axis=0).tolist(),
            "least": int(n.min()), "most": int(n.max()),
            "sigs": np.array([r[0] for r in rows], np.int64).tobytes(), "sizes": n.tobytes(),
            "parts": np.array([r[3] for r in rows], np.int64).tobytes(),
            "lengths": np.array([len(k) for k in keys], np.int32).tobytes(), "points": b"".join(r[2] for r in rows)}


def _leaf_table(rows: list[dict]) -> dict[str, pa.Array]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    return {name: pa.array([r[name] for r in rows], kinds[kind])
            for name, kind in (x.split() for x in _LEAF.split(", "))}


def _shared_leaf(table: pa.Table) -> pa.Table:
    """Small clusters that share a leaf."""
    rows = list(zip(*[table.column(c).to_pylist() for c in ("sig", "n", "keys", "sig")]))
    return pa.table(_leaf_table([_leaf(table.column("share")[0].as_py(), -1, None, 0, rows)]))


def _cut_leaves(size: int):
    """Leaves of ``size`` points of large clusters, which come sorted."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        rows, key = [], None

        def leaf():
            nonlocal number
            number += 1
            return pa.RecordBatch.from_pydict(_leaf_table([_leaf(*key, number, rows)]))

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("cluster", "band", "own", "sig", "n", "keys", "part")]
            for cluster, band, own, *row in zip(*cols):
                if rows and (len(rows) >= size or key != (cluster, band, own)):
                    yield leaf()
                    rows = []
                key = (cluster, band, own)
                rows.append(tuple(row))
        if rows:
            yield leaf()
    return run


def _link_leaves(batches):
    for batch in batches:
        for row in batch.to_pylist():
            sigs: list[int] = []
            parts: list[int] = []
            sizes, keys = [], []
            for side in ("", "2"):
                if row["sigs" + side] is None:
                    continue
                sigs += np.frombuffer(row["sigs" + side], np.int64).tolist()
                parts += np.frombuffer(row["parts" + side], np.int64).tolist()
                sizes.append(np.frombuffer(row["sizes" + side], np.int32).astype(np.int64))
                lengths = np.frombuffer(row["lengths" + side], np.int32)
                keys += np.split(np.frombuffer(row["points" + side], U), np.cumsum(lengths)[:-1])
            found = _links(sigs, np.concatenate(sizes), keys, parts)
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _verify(batches):
    """Of classes and their hubs: those that link."""
    for batch in batches:
        n, n2 = batch.column("n").to_pylist(), batch.column("n2").to_pylist()
        ok = [_common(np.frombuffer(a.as_py(), U), np.frombuffer(b.as_py(), U)) >= _least_overlap(x, y)
              for a, b, x, y in zip(batch.column("keys"), batch.column("keys2"), n, n2)]
        yield pa.RecordBatch.from_arrays([batch.column("sig"), batch.column("hub")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _solved(batches):
    """``node, label`` of the few edges of a partition: larger roots hang themselves under smaller ones."""
    ends = [(batch.column("a").to_numpy(), batch.column("b").to_numpy()) for batch in batches]
    if not ends:
        return
    a, b = (np.concatenate(x) for x in zip(*ends))
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    root = np.arange(len(node))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[root])], ["node", "label"])


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (the least node reached) of every node of ``edges`` (``a, b``).

    Each round maps every node to the neighbour, or itself, that a hash of the
    round puts first, and on to where that one is mapped; edges then join what
    is left, those inside a node are dropped, and the rest, a part of the nodes,
    goes into the next round.  What is no more than one task's share is solved
    there: rounds over a few edges cost the driver plans and threads, not work.
    The rounds' maps are joined one behind the other.
    """
    edge = cut(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps: list[DataFrame] = []
    while left := edge.count():
        if left <= EDGES:
            steps.append(cut(edge.coalesce(1).mapInArrow(_solved, "node long, label long")))
            break
        draw = lambda c: F.struct(F.xxhash64(c, F.lit(len(steps))).alias("h"), F.col(c).alias("to"))  # noqa: B023, E731
        ends = edge.select("a", draw("b").alias("d")).unionByName(edge.select(F.col("b").alias("a"), draw("a").alias("d")))
        step = ends.groupBy("a").agg(F.min("d").alias("d")).select(
            F.col("a").alias("node"), F.least("d", draw("a"))["to"].alias("label"))
        via = step.select(F.col("node").alias("via"), F.col("label").alias("far"))
        step = cut(step.join(via, F.col("label") == F.col("via")).select("node", F.col("far").alias("label")))
        steps.append(step)
        for end in ("a", "b"):
            edge = edge.join(step, edge[end] == step.node).drop(end, "node").withColumnRenamed("label", end)
        edge = cut(edge.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not steps:
        return edge.select(F.col("a").alias("node"), F.col("b").alias("label"))
    found = steps[0]
    if len(steps) == 1 and left <= EDGES:
        return found
    for step in steps[1:]:
        step = step.select(F.col("node").alias("via"), F.col("label").alias("far"))
        found = found.join(step, found.label == step.via, "left").select(
            "node", F.coalesce("far", "label").alias("label"))
    found = cut(found)
    least = found.groupBy("label").agg(F.min("node").alias("least"))
    return found.join(least, "label").select("node", F.col("least").alias("label"))


def _joined(parts: DataFrame, found: DataFrame) -> DataFrame:
    """``sig, part`` after ``found`` links: only the parts that they connect are labelled anew."""
    def end(name):
        return parts.select(F.col("sig").alias(name), F.col("part").alias(f"part_{name}"))

    met = found.join(end("a"), "a", "left").join(end("b"), "b", "left").select(
        F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b")).distinct()
    label = components(met)
    new = label.join(parts, label.node == parts.sig, "left_anti").select(F.col("node").alias("sig"), F.col("label").alias("part"))
    old = parts.join(label, parts.part == label.node, "left").select("sig", F.coalesce("label", "part").alias("part"))
    return old.unionByName(new)


def _contracted(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified links of classes with hubs, and ``sig, part`` of the classes they connect.

    Each round tries one hub for each class that has one outside its part, so a
    round costs one comparison a class whatever the group's size.  The rounds only
    spare later work: what they leave unlinked is compared in the leaves.
    """
    spark = points.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    parts = spark.createDataFrame([], "sig long, part long")
    body = points.select("sig", "n", "keys")
    for turn in range(_ROUNDS):
        entries = points.select("sig", "n", F.explode("prefix").alias("key")).join(parts, "sig", "left").select(
            "sig", "n", "key", F.coalesce("part", "sig").alias("part"))
        hub = entries.groupBy("key").agg(F.min(F.struct(F.xxhash64("sig", F.lit(turn)), "sig", "n", "part")).alias("h"))
        hub = hub.select("key", F.col("h.sig").alias("hub"), F.col("h.n").alias("n2"), F.col("h.part").alias("part2"))
        near = entries.join(hub, "key").filter(
            (F.col("part") != F.col("part2")) & (DENOMINATOR * F.col("n") >= NUMERATOR * F.col("n2"))
            & (DENOMINATOR * F.col("n2") >= NUMERATOR * F.col("n")))
        best = near.groupBy("sig", "hub").agg(F.count("*").alias("shared")).groupBy("sig").agg(
            F.max(F.struct("shared", "hub")).alias("m"))
        tries = written(best.select("sig", F.col("m.hub").alias("hub")), "ngram-tries")
        hubs = written(tries.select(F.col("hub").alias("sig")).distinct().join(body, "sig").select(
            F.col("sig").alias("hub"), F.col("n").alias("n2"), F.col("keys").alias("keys2")), "ngram-hubs")
        found = written(tries.join(body, "sig").join(hubs, "hub").mapInArrow(_verify, "a long, b long"), "ngram-hub-links")
        tried, hits = tries.count(), found.count()
        if hits:
            links = links.unionByName(found)
            parts = cut(_joined(parts, found))
        if 4 * hits < tried or not tried:
            break
    return links, parts


def _leaves(points: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points packed into leaves, and the links found on the way.

    Clusters of up to LEAF points share leaves with others, whole; a larger one
    is cut into size bands (partners differ by one band at most) of leaves.
    """
    step = math.log(DENOMINATOR / NUMERATOR)
    clusters = clusters.select(F.col("node").alias("sig"), F.col("label").alias("cluster"))
    whole = cut(clusters.groupBy("cluster").agg(F.count("*").alias("members")))
    few = whole.filter(F.col("members") <= LEAF).agg(F.sum("members")).first()[0] or 0
    shares = max(1, math.ceil(few / LEAF))
    named = written(clusters.join(whole, "cluster").select("sig", "cluster", F.when(
        F.col("members") <= LEAF, F.pmod(F.xxhash64("cluster"), F.lit(shares))).alias("share")), "ngram-clusters")
    p = written(points.join(named, "sig"), "ngram-clustered")  # the bodies are sent here and to their leaf
    leaves = p.filter("share is not null").select("sig", "n", "keys", "share").groupBy("share").applyInArrow(
        _shared_leaf, _LEAF)
    large = p.filter("share is null")
    if named.filter("share is null").isEmpty():
        return written(leaves, "ngram-leaves"), points.sparkSession.createDataFrame([], "a long, b long")
    links, parts = _contracted(large)
    own = parts.groupBy("part").agg(F.count("*").alias("in_part")).filter(F.col("in_part") > LEAF).select(
        "part", F.col("part").alias("own"))
    placed = large.drop("prefix").join(parts.join(own, "part", "left"), "sig", "left").select(
        "cluster", F.floor(F.log(F.col("n").cast("double")) / step).cast("int").alias("band"), "own", "n", "low", "even",
        "sig", F.coalesce("part", "sig").alias("part"), "keys")
    order = ["cluster", "band", "own", "n", "low", "even", "sig"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(leaves.unionByName(placed.mapInArrow(_cut_leaves(LEAF), _LEAF)), "ngram-leaves"), links


def _leaf_pairs(leaves: DataFrame) -> DataFrame:
    """``leaf, leaf2`` of large clusters that may hold a link between two parts.

    All leaves of a part's band are one node; nodes of one part are not paired.
    """
    slim = leaves.filter("band >= 0").select("cluster", "band", "own", "leaf", "upper", "least", "most",
                                             F.coalesce("own", F.lit(0)).alias("part"),
                                             F.when(F.col("own").isNull(), F.col("leaf")).otherwise(0).alias("node"))
    node = slim.groupBy("cluster", "band", "own", "part", "node").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    names = lambda df, *cols: df.select("cluster", *[F.col(c).alias(f"{c}2") for c in cols])
    sizes = ((DENOMINATOR * F.col("most") >= NUMERATOR * F.col("least2"))
             & (DENOMINATOR * F.col("most2") >= NUMERATOR * F.col("least")))
    after = F.struct("part2", "node2") > F.struct("part", "node")
    pairs = node.join(names(node, "band", "own", "part", "node", "least", "most"), "cluster").filter(
        (F.col("own").isNull() | F.col("own2").isNull() | (F.col("own") != F.col("own2"))) & sizes
        & (((F.col("band2") == F.col("band")) & after) | (F.col("band2") == F.col("band") + 1))).select(
        "cluster", "band", "part", "node", "band2", "part2", "node2")
    bound = F.aggregate(F.zip_with("upper", "upper2", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    need = F.ceil(F.lit(NUMERATOR) * (F.col("least") + F.col("least2")) / (NUMERATOR + DENOMINATOR))
    one = slim.select("cluster", "band", "part", "node", "leaf", "upper", "least", "most")
    two = names(slim, "band", "part", "node", "leaf", "upper", "least", "most")
    return pairs.join(one, ["cluster", "band", "part", "node"]).join(two, ["cluster", "band2", "part2", "node2"]).filter(
        (bound >= need) & sizes).select("leaf", "leaf2")


def verified_links(docs: DataFrame, k: int = K) -> DataFrame:
    """Links ``a, b`` between signatures that connect whatever any link connects."""
    spark = docs.sparkSession
    buckets = n_buckets(spark)
    bits = buckets.bit_length() - 1
    routed = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _route(bits, k), "bucket int, keys binary, sigs binary, sizes binary")
    shared = routed.groupBy("bucket").applyInArrow(
        _shared(bits), "home int, sigs binary, sizes binary, counts binary, keys binary, dfs binary")
    points = written(shared.groupBy("home").applyInArrow(_gather, _POINT), "ngram-points")

    entries = points.select("sig", F.explode("prefix").alias("key"))
    hub = entries.groupBy("key").agg(F.min("sig").alias("hub"), F.max("sig").alias("last")).filter("hub <> last")
    # A class and the hubs of its keys (at most as many as its prefix holds) as a star about the least
    # of them: connects the same, and classes of one group name the same few pairs of hubs.
    star = entries.join(hub, "key").groupBy("sig").agg(F.collect_set("hub").alias("hubs")).select(
        F.array_union("hubs", F.array("sig")).alias("all"))
    edges = star.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).filter("a <> b").distinct()
    clusters = components(edges)

    leaves, links = _leaves(points, clusters)
    # Leaves of one part hold no new link by themselves.
    alone = leaves.filter("own is null").select(*_BODY, *[F.lit(None).cast("binary").alias(f"{c}2") for c in _BODY])
    left = leaves.filter("band >= 0").select("leaf", *_BODY)
    right = left.select(F.col("leaf").alias("leaf2"), *[F.col(c).alias(f"{c}2") for c in _BODY])
    paired = _leaf_pairs(leaves).join(left, "leaf").join(right, "leaf2")
    both = alone.unionByName(paired.select(*_BODY, *[f"{c}2" for c in _BODY]))
    return both.mapInArrow(_link_leaves, "a long, b long").unionByName(links)


def near_duplicates(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, component_id, sig`` of every row of ``docs``."""
    rows = written(set_signatures(docs, k), "ngram-classes")
    linked = components(verified_links(docs, k))
    classes = rows.filter("n_shingles > 0").groupBy("sig").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("members"))
    classes = classes.join(linked, classes.sig == linked.node, "left").select(
        "sig", "first_id", "members", F.coalesce("label", "sig").alias("comp"), F.col("label").isNotNull().alias("linked"))
    least = classes.filter("linked").groupBy("comp").agg(F.min("first_id").alias("component_id"))
    many = classes.filter("linked or members > 1").join(least, "comp", "left").select(
        F.col("sig").alias("its_sig"), F.coalesce("component_id", "first_id").alias("component_id"), "comp")
    out = rows.join(many, (rows.sig == many.its_sig) & (rows.n_shingles > 0), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "sig",
                      F.when(F.col("n_shingles") > 0, F.coalesce("comp", "sig")).alias("comp"))


def one_of_each(docs: DataFrame, k: int = K) -> DataFrame:
    """The documents, all columns (of any name), less all but one of each group of linked documents.

    The row of the group's smallest doc_id stays; a document without words is in no group.
    """
    found = written(near_duplicates(docs, k), "ngram-found")
    keep_id, keep_sig, many_id, sig, size = (unused(docs, c) for c in ("keep_id", "keep_sig", "many_id", "_sig", "_n"))
    # One row of each group: the smallest doc_id, a null id last, then the smallest signature.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sig")
    keep = found.filter("n_shingles > 0").groupBy("comp").agg(F.min(order).alias("w")).select(
        F.col("w.doc_id").alias(keep_id), F.col("w.sig").alias(keep_sig))
    empty = found.filter("n_shingles = 0").select(F.col("doc_id").alias(keep_id))
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null")
    repeated = cut(repeated.select(F.col("doc_id").alias(many_id)))
    same_id = F.col("doc_id").cast("long").eqNullSafe(F.col(keep_id))
    wanted = keep.select(keep_id).unionAll(empty).filter(F.col(keep_id).isNotNull())
    if repeated.isEmpty():
        return docs.join(wanted, same_id, "left_semi")
    # Rows that share an id (or have none) are told apart by their signature.
    is_many = F.col("doc_id").cast("long").eqNullSafe(F.col(many_id))
    single = docs.join(repeated, is_many, "left_anti").join(wanted, same_id, "left_semi")
    many = numbered(docs.join(repeated, is_many, "left_semi"))
    schema = many.withColumns({"sig": F.lit(0).cast("long"), "n": F.lit(0).cast("long")}).schema
    at = docs.columns.index("text")

    def sign(batches):
        for batch in batches:
            for lo, hi, r in _runs(batch, at, k):
                yield pa.RecordBatch.from_arrays(
                    [c.slice(lo, hi - lo) for c in batch.columns]
                    + [pa.array(r.sig.view(np.int64), pa.int64()), pa.array(r.size, pa.int64())],
                    names=batch.schema.names + ["sig", "n"])

    rest = many.mapInArrow(sign, schema).toDF(*docs.columns, sig, size)
    same = same_id & (F.col(sig) == F.col(keep_sig))
    first = rest.filter(F.col(size) > 0).join(keep, same, "left_semi").dropDuplicates([sig])
    return single.unionAll(first.drop(sig, size)).unionAll(rest.filter(F.col(size) == 0).drop(sig, size))
