"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate.  A pass builds, per query, a
histogram of the scores in the query's current range; histograms of all blocks
are summed, and the bin that holds the k-th value becomes the next range.  Bins
shrink by their number each pass until a bin is one score wide, which is then
exactly the k-th value.  A last pass keeps the scores above it and, of those
equal to it, the smallest ids that are still wanted.

Vectors travel as packed blocks.  Blocks are dealt to cells, each of a share of
the candidates and a share of the queries of bounded size, so neither side is
ever whole in one place.  A cell scores its pairs tile by tile.  It gives only
those bins that can still hold the k-th value, and so scores below what its
earlier tiles reach are not looked at.

Cases: a vector that is null or holds null or non-finite components, or whose
id is null, takes no part; an empty vector scores 0; vectors meet only vectors
of their own length; a query id on several rows is queried once, by its least
vector, while every row is a candidate of the other ids; scaled components
beyond 2**53 count as 2**53 and scores beyond a long as the nearest long; a
query with fewer candidates than k returns all; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut

BINS = 512
QUERY_BLOCK, CANDIDATE_BLOCK, STEP = 4096, 4096, 512
#: Components of a block at most, and bytes of either side of a cell.
BLOCK, CELL = 1 << 20, 16 << 20
_LIMIT = float(1 << 53)


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


_KINDS = {2: np.int16, 4: np.float32, 8: np.float64}


def _pack(ids: np.ndarray, flat: np.ndarray, dim: int, scale: float) -> tuple[bytes, bytes, int, float]:
    mat = np.clip(np.floor(flat.astype(np.float64) * scale), -_LIMIT, _LIMIT).reshape(len(ids), dim)
    most = _most(mat)
    width = 2 if most < (1 << 15) else 4 if most < (1 << 24) else 8
    norm = float(np.sqrt((mat * mat).sum(axis=1).max())) if mat.size else 0.0
    return ids.astype(np.int64).tobytes(), mat.astype(_KINDS[width]).tobytes(), width, norm


def _most(mat: np.ndarray) -> float:
    """The largest absolute component."""
    return max(float(mat.max()), -float(mat.min())) if mat.size else 0.0


_BLOCK = "dim int, ids binary, mat binary, width int, norm double"


def _pack_batches(scale: float):
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            ids = t.column(0).combine_chunks().to_numpy(zero_copy_only=False)
            vec = t.column(1).combine_chunks()
            vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
            off = vec.offsets.to_numpy()
            flat = vec.values.to_numpy(zero_copy_only=False)
            dims = np.diff(off)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                size = max(1, min(CANDIDATE_BLOCK, BLOCK // max(1, int(dim))))
                for at in range(0, len(rows), size):
                    r = rows[at:at + size]
                    take = (off[r][:, None] + np.arange(dim)).ravel()
                    b = _pack(ids[r], flat[take], int(dim), scale)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(dim)], pa.int32()), pa.array([b[0]], pa.binary()),
                         pa.array([b[1]], pa.binary()), pa.array([b[2]], pa.int32()),
                         pa.array([b[3]], pa.float64())], ["dim", "ids", "mat", "width", "norm"])
    return run


def _array(column: pa.ChunkedArray, row: int, kind: type = np.int64) -> np.ndarray:
    """A packed value; its bytes are not copied."""
    raw = column[row].as_buffer()
    return np.frombuffer(raw, kind) if raw.size else np.empty(0, kind)


def _candidates(cell: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a cell's candidates, those of a number type together."""
    out, widths = [], cell.column("width").to_numpy()
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width).tolist()
        ids = np.concatenate([_array(cell.column("ids"), i) for i in rows])
        mat = np.concatenate([_array(cell.column("mat"), i, _KINDS[width]) for i in rows])
        out.append((ids, mat.reshape(len(ids), cell.column("dim")[0].as_py())))
    return out


def _queries(cell: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, ids, vectors, range starts and wanted counts of each query block of a cell."""
    for i in range(cell.num_rows):
        ids = _array(cell.column("q_ids"), i)
        mat = _array(cell.column("q_mat"), i, _KINDS[cell.column("q_width")[i].as_py()])
        yield (cell.column("block")[i].as_py(), ids, mat.reshape(len(ids), cell.column("dim")[i].as_py()),
               _array(cell.column("lo"), i), _array(cell.column("need"), i))


def _scores(q: np.ndarray, c: np.ndarray, kind: type, room: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as object integers when too large for floating point."""
    if kind is not object:
        return np.matmul(q, c.astype(kind).T, out=room[:len(q) * len(c)].reshape(len(q), len(c)))
    big = [[int(x) for x in row] for row in c]
    out = [[sum(a * b for a, b in zip(x, y)) for y in big] for x in q]
    top = (1 << 62)
    return np.array([[max(-top, min(top, v)) for v in row] for row in out], dtype=object)


def _tiles(qid: np.ndarray, q: np.ndarray, floor: np.ndarray, candidates: list[tuple[np.ndarray, np.ndarray]]):
    """Query place, candidate id and score of all pairs that reach the query's floor, and how
    many candidates were met so far.  The caller may raise floors between tiles."""
    met, most = 0, _most(q)
    for ids, mat in candidates:
        most_score = q.shape[1] * most * _most(mat)
        kind = np.float32 if most_score < (1 << 24) else np.float64 if most_score < _LIMIT else object
        left = [[int(x) for x in row] for row in q] if kind is object else q.astype(kind)
        room = np.empty(0 if kind is object else len(q) * min(STEP, len(ids)), kind)
        at = 0
        while at < len(ids):  # short tiles first, until there are floors
            tile = slice(at, at + min(STEP, max(32, met)))
            s = _scores(left, mat[tile], kind, room)
            least = floor.astype(kind)
            rows = np.flatnonzero(s.max(axis=1) >= least)
            r, c = np.nonzero(s[rows] >= least[rows, None])
            r, found = rows[r], ids[tile][c]
            other = qid[r] != found
            at, met = at + s.shape[1], met + s.shape[1]
            yield r[other], found[other], s[r[other], c[other]].astype(np.int64), met


#: Range start of a query that keeps every candidate, and floor of one that looks for nothing.
_ALL, _NONE = -(1 << 62), (1 << 63) - 1


def _counted(qid: np.ndarray, q: np.ndarray, lo: np.ndarray, need: np.ndarray,
             candidates: list, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, bin and count of the bins that can hold the value wanted by a query."""
    h = np.zeros((len(q), BINS), np.int32)  # the best bin first
    floor = np.where((need > 0) & (lo != _ALL), lo, _NONE)
    fresh, n_fresh, due = np.zeros(len(q), bool), 0, 0
    seen, first = np.zeros(len(q), bool), BINS - 1
    for r, _, s, met in _tiles(qid, q, floor, candidates):
        b = (s - lo[r]) // width
        r, b = r[b < BINS], BINS - 1 - b[b < BINS]
        np.add.at(h, (r, b), 1)
        first = min(first, int(b.min(initial=first)))
        fresh[r] = True
        n_fresh += len(r)
        if met >= due or n_fresh > 4 * len(q):
            rows = np.flatnonzero(fresh)
            if len(rows):
                last = BINS - 1 - int(((floor[rows] - lo[rows]) // width).min())
                enough = np.cumsum(h[rows, first:last + 1], axis=1, dtype=np.int32) >= need[rows][:, None]
                some = enough[:, -1]
                b = first + enough[some].argmax(axis=1)
                floor[rows[some]] = lo[rows[some]] + (BINS - 1 - b) * width
            seen |= fresh
            fresh[:], n_fresh, due = False, 0, 2 * met
    rows = np.flatnonzero(seen | fresh)
    h = h[rows]
    i, b = np.nonzero((h > 0) & (np.cumsum(h, axis=1, dtype=np.int32) - h < need[rows][:, None]))
    return rows[i], BINS - 1 - b, h[i, b]


def _histograms(width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(cell: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"block": [], "q": [], "bin": [], "n": []}
        candidates = _candidates(cell) if queries.num_rows else []
        for block, qid, q, lo, need in _queries(queries) if candidates else ():
            i, b, n = _counted(qid, q, lo, need, candidates, width)
            for name, values in zip(out, (np.full(len(i), block, np.int64), i, b, n)):
                out[name].append(values)
        return _table(out, {"block": pa.int64(), "q": pa.int32(), "bin": pa.int32(), "n": pa.int64()})
    return run


def _table(columns: dict[str, list[np.ndarray]], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({name: pa.array(np.concatenate([np.empty(0, np.int64), *columns[name]]).astype(
        kind.to_pandas_dtype()), kind) for name, kind in kinds.items()})


def _narrow(width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The block with new range and remaining count of each query, from its summed histogram."""
    def run(block: pa.Table, hist: pa.Table) -> pa.Table:
        lo, need = _array(block.column("lo"), 0).copy(), _array(block.column("need"), 0).copy()
        q, b, n = (hist.column(c).to_numpy().astype(np.int64) for c in ("q", "bin", "n"))
        order = np.lexsort((-b, q))
        q, b, n = q[order], b[order], n[order]
        run_ = np.cumsum(n)
        firsts = np.searchsorted(q, np.arange(len(lo)))
        lasts = np.searchsorted(q, np.arange(len(lo)), "right")
        base = np.concatenate([[0], run_])[firsts]
        for i in range(len(lo)):
            if need[i] <= 0 or lo[i] == _ALL:
                continue
            mine = run_[firsts[i]:lasts[i]] - base[i]
            j = int(np.searchsorted(mine, need[i]))
            if j == len(mine):  # fewer candidates than wanted: all are kept
                lo[i], need[i] = _ALL, 0
                continue
            need[i] -= int(mine[j - 1]) if j else 0
            lo[i] += int(b[firsts[i] + j]) * width
        at = block.schema.get_field_index
        for name, values in (("lo", lo), ("need", need)):
            block = block.set_column(at(name), name, pa.array([values.tobytes()], pa.binary()))
        return block
    return run


def _least_ids(r: np.ndarray, ids: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each query the smallest ids, as many as it still wants."""
    order = np.lexsort((ids, r))
    r, ids = r[order], ids[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < need[r]
    return r[keep], ids[keep]


def _select(cell: pa.Table, queries: pa.Table) -> pa.Table:
    out = {"query_id": [], "vec_id": [], "score": []}
    candidates = _candidates(cell) if queries.num_rows else []
    for _, qid, q, lo, need in _queries(queries) if candidates else ():
        tied = np.empty(0, np.int64), np.empty(0, np.int64)
        for r, ids, s, _ in _tiles(qid, q, lo, candidates):
            above = (s > lo[r]) | (lo[r] == _ALL)
            for name, values in zip(out, (qid[r[above]], ids[above], s[above])):
                out[name].append(values)
            if not above.all():  # of equal scores only the smallest ids that are still wanted
                tied = _least_ids(np.concatenate([tied[0], r[~above]]),
                                  np.concatenate([tied[1], ids[~above]]), need)
        for name, values in zip(out, (qid[tied[0]], tied[1], lo[tied[0]])):
            out[name].append(values)
    return _table(out, dict.fromkeys(out, pa.int64()))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best candidates.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` marks the query
    rows.  Components become ``floor(scale * x)`` and the score is the integer
    inner product; ties go to the smaller ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"),
                       F.coalesce(is_query, F.lit(False)).alias("q"))
    cand = cut(rows.select("vec_id", "embedding").mapInArrow(_pack_batches(scale), _BLOCK))
    c = cand.agg(F.max("norm").alias("norm"), F.count("*").alias("n"), F.sum(F.length("mat")).alias("bytes")).first()
    queries = cut(rows.filter("q").groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    n = queries.agg(F.count("*").alias("rows"), F.sum(F.size("embedding")).alias("cells")).first()
    n_blocks = max(1, math.ceil(n["rows"] / QUERY_BLOCK), math.ceil((n["cells"] or 0) / BLOCK))
    # Queries are candidates too, so no score is outside of +-reach.
    reach = min(1 << 61, int(math.ceil((c["norm"] or 0.0) ** 2)) + 1)
    width = 1
    while width * BINS < 2 * reach + 1:
        width *= BINS

    def pack_queries(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        vec = table.column("embedding").combine_chunks()
        vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
        b = _pack(ids, vec.flatten().to_numpy(zero_copy_only=False), int(table.column("dim")[0].as_py()), scale)
        return pa.table({"dim": table.column("dim").slice(0, 1).cast(pa.int32()),
                         "block": table.column("block").slice(0, 1).cast(pa.int64()),
                         "q_ids": pa.array([b[0]], pa.binary()), "q_mat": pa.array([b[1]], pa.binary()),
                         "q_width": pa.array([b[2]], pa.int32()),
                         "lo": pa.array([np.full(len(ids), -reach, np.int64).tobytes()], pa.binary()),
                         "need": pa.array([np.full(len(ids), k, np.int64).tobytes()], pa.binary())})

    # A block's number is unique over all dimensions.
    number = F.col("dim").cast("long") * n_blocks + F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))
    schema = "dim int, block long, q_ids binary, q_mat binary, q_width int, lo binary, need binary"
    blocks = cut(queries.withColumn("dim", F.size("embedding")).withColumn("block", number)
                 .groupBy("block").applyInArrow(pack_queries, schema))
    # Shares of the two sides: as many as their bytes ask for, and of the candidates so many more
    # that all tasks have a cell, unless that made more of the queries' copies than of the candidates.
    c_bytes, q_bytes = c["bytes"] or 0, blocks.agg(F.sum(F.length("q_mat")).alias("b")).first()["b"] or 0
    n_q = max(1, math.ceil(q_bytes / CELL))
    tasks = math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions", "200")) / n_q)
    n_c = max(1, math.ceil(c_bytes / CELL), min(tasks, c["n"], math.ceil(c_bytes * n_q / max(1, q_bytes))))
    cells = ["dim", "c_share", "q_share"]
    shared = cand.drop("norm").withColumn("c_share", F.pmod(F.xxhash64("ids"), F.lit(n_c)).cast("int")).withColumn(
        "q_share", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).groupBy(*cells)

    def met(run: Callable[[pa.Table, pa.Table], pa.Table], out: str) -> DataFrame:
        q = blocks.withColumn("q_share", F.pmod(F.col("block"), F.lit(n_q)).cast("int")).withColumn(
            "c_share", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
        return shared.cogroup(q.groupBy(*cells)).applyInArrow(run, out)

    while True:
        hist = met(_histograms(width), "block long, q int, bin int, n long")
        hist = hist.groupBy("block", "q", "bin").agg(F.sum("n").alias("n"))
        blocks = cut(blocks.groupBy("block").cogroup(hist.groupBy("block")).applyInArrow(_narrow(width), schema))
        if width == 1:
            break
        width //= BINS
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = met(_select, "query_id long, vec_id long, score long")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
