"""Language-model scoring with an interpolated modified Kneser-Ney bigram model.

Bigrams are counted in Spark: every run of documents sends its bigrams to the
buckets of their first words as sorted hash arrays, a bucket counts them, and
the words' continuation counts meet in the buckets of the words.  A bucket then
holds its part of the model - sorted word hashes, sorted bigram keys and their
log-probabilities - in memory-mapped arrays of its worker, looks up the bigrams
of all documents that were sent to it, and returns one partial sum per document.
No part of the model passes through the driver and no bucket knows another's.

    p(w | u) = max(c(u w) - D(c(u w)), 0) / c(u) + g(u) * p(w)
    p(w)     = max(t(w) - D'(t(w)), 0) / T       + g' / (V + 1)

with t(w) the number of distinct words before w and T their sum; D and D' are
the discounts for counts 1, 2 and 3 or more, estimated from the counts of
counts; g(u) and g' are what the discounts leave.  The last term is uniform over
the V known words and one unknown word.  A document starts after a start mark,
which is only ever a first word, and ends with an end token.

Words are 64-bit hashes of lower-cased byte runs.  With fewer than three classes
of counts the discounts are 0.5, 1 and 1.5.

Cases: a null text is empty and an empty text is its end token alone; nothing to
learn from leaves every token unknown (N = V = 0, score 0 per token); a null
doc_id has the checksum of an empty text; repeated rows are documents of their
own; texts of any length are scored whole; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from . import bytetext as B

U = np.uint64
START, END = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
_RUN_BYTES, _RUN_DOCS = 8 << 20, 1 << 16
_W, _D = U(16), U(40)  # a packed bigram: first word 24 bits, word 24 bits, document 16 bits

_ROUTED = ("bucket int, run long, n_docs int, train binary, u binary, u_runs binary, w binary, "
           "w_at binary, doc binary, ids array<long>, held_out array<boolean>, n_tokens array<long>")
_ROUTED_NAMES = [x.split()[0] for x in _ROUTED.split(", ")]


def token_stream(w: B.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with the end tokens put in, the token before each, and each token's document."""
    n_docs = len(w.first) - 1
    seq = np.empty(len(w.hash) + n_docs, U)
    seq[np.arange(len(w.hash)) + w.doc] = w.hash
    seq[w.first[1:] + np.arange(n_docs)] = END
    before = np.empty_like(seq)
    before[1:] = seq[:-1]
    before[w.first[:-1] + np.arange(n_docs)] = START
    return seq, before, np.repeat(np.arange(n_docs), w.count + 1)


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places at which the buckets of sorted hashes begin, and the end."""
    if not bits:
        return np.array([0, len(hashes)])
    marks = np.arange(1 << bits, dtype=U) << U(64 - bits)
    return np.concatenate([np.searchsorted(hashes, marks), [len(hashes)]])


def _route(bits: int):
    def run(batches):
        number = TaskContext.get().partitionId() << 32  # the same in every attempt
        for batch in batches:
            data, off = B.string_buffers(batch.column(2))
            for lo, hi in B.slices(data, off, _RUN_BYTES, _RUN_DOCS):
                w = B.words(data, off[lo:hi + 1], B.NOT_SPACE)
                held = batch.column(1).slice(lo, hi - lo)
                train = (~held.to_numpy(zero_copy_only=False).astype(bool)).astype(np.uint8).tobytes()
                seq, before, doc = token_stream(w)
                uniq, at = np.unique(np.concatenate([seq, [START]]), return_inverse=True)
                wid = at[:-1].astype(U)
                uid = np.empty_like(wid)
                uid[1:] = wid[:-1]
                uid[w.first[:-1] + np.arange(hi - lo)] = U(at[-1])
                packed = (uid << _D) | (wid << _W) | doc.astype(U)
                packed.sort()
                edges = np.searchsorted(packed, _top(uniq, bits)[:-1].astype(U) << _D).tolist() + [len(packed)]
                cols: list[list] = [[] for _ in range(6)]
                for b in range(1 << bits):
                    seg = packed[edges[b]:edges[b + 1]]
                    if not len(seg):
                        continue
                    u = (seg >> _D).astype(np.int64)
                    cuts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
                    x = ((seg >> _W) & U(0xFFFFFF)).astype(np.int64)
                    has = np.zeros(len(uniq), bool)
                    has[x] = True
                    used = np.flatnonzero(has)
                    place = (np.cumsum(has) - 1)[x]
                    for c, v in zip(cols, (
                            b, uniq[u[cuts]].tobytes(),
                            np.diff(np.concatenate([cuts, [len(u)]])).astype(np.int32).tobytes(),
                            uniq[used].tobytes(),
                            place.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32).tobytes(),
                            (seg & U(0xFFFF)).astype(np.uint16).tobytes())):
                        c.append(v)
                n = len(cols[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array([number] * n, pa.int64()),
                     pa.array([hi - lo] * n, pa.int32()), pa.array([train] * n, pa.binary()),
                     *[pa.array(c, pa.binary()) for c in cols[1:]],
                     pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.bool_())),
                     pa.nulls(n, pa.list_(pa.int64()))], _ROUTED_NAMES)
                none = pa.nulls(1, pa.binary())
                yield pa.RecordBatch.from_arrays(  # the run's documents, once
                    [pa.array([number % (1 << bits)], pa.int32()), pa.array([number], pa.int64()),
                     pa.array([hi - lo], pa.int32()), none, none, none, none, none, none,
                     pa.array([batch.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                     pa.array([held.to_pylist()], pa.list_(pa.bool_())),
                     pa.array([(w.count + 1).tolist()], pa.list_(pa.int64()))], _ROUTED_NAMES)
                number += 1
    return run


class _Bucket:
    """The bigrams sent to a bucket: sorted first words ``u``, sorted words ``w``, and per run the entries."""

    def __init__(self, table: pa.Table):
        rows = [r for r in range(table.num_rows) if table.column("u")[r].is_valid]
        runs = table.column("run").to_pylist()
        rows.sort(key=lambda r: runs[r])
        get = lambda name, r, kind: np.frombuffer(table.column(name)[r].as_py(), kind)
        us, ws = [get("u", r, U) for r in rows], [get("w", r, U) for r in rows]
        empty = np.zeros(0, U)
        self.u = np.unique(np.concatenate(us)) if us else empty
        self.w = np.unique(np.concatenate(ws)) if ws else empty
        self.runs, self.n_docs, keys, docs, train = [], [], [], [], []
        for r, u, w in zip(rows, us, ws):
            at = get("doc", r, np.uint16)
            raw = table.column("w_at")[r].as_py()
            place = np.frombuffer(raw, np.uint16 if len(raw) == 2 * len(at) else np.uint32)
            first = np.repeat(np.searchsorted(self.u, u).astype(U), get("u_runs", r, np.int32))
            keys.append((first << U(32)) | np.searchsorted(self.w, w).astype(U)[place])
            docs.append(at)
            train.append(get("train", r, np.uint8).astype(bool)[at])
            self.runs.append(runs[r])
            self.n_docs.append(table.column("n_docs")[r].as_py())
        self.keys, self.docs = keys, docs
        learned = np.concatenate([k[t] for k, t in zip(keys, train)]) if keys else empty
        learned.sort()
        cut = np.flatnonzero(np.concatenate([[True], learned[1:] != learned[:-1]])) if len(learned) else \
            np.zeros(0, np.int64)
        #: sorted keys of the counted bigrams and their counts
        self.key = learned[cut]
        self.count = np.diff(np.concatenate([cut, [len(learned)]]))

    def continuations(self) -> tuple[np.ndarray, np.ndarray]:
        """Per word: distinct first words before it here, and its count here."""
        w = (self.key & U(0xFFFFFFFF)).astype(np.int64)
        types = np.bincount(w, minlength=len(self.w))
        counts = np.bincount(w, self.count, len(self.w)).astype(np.int64)
        return types.astype(np.int64), counts


def counts_of_counts(x: np.ndarray) -> list[int]:
    return [int((x == i).sum()) for i in (1, 2, 3, 4)]


def discounts(n: list[int]) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more."""
    if min(n[:3]) == 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return np.array([0.0] + [min(max(x, 0.0), k + 1.0) for k, x in enumerate(d)])


_SENT = "w_bucket int, bucket int, w binary, types binary, counts binary, coc array<long>"
_BACK = "bucket int, w_bucket int, types binary, counts binary, coc array<long>, words array<long>"


#: Buckets of words at most (2 ** 10): a bucket of words holds counts of distinct words only.
_WORD_BITS = 10


def _count(bits: int):
    """Continuation counts of a bucket, sent to every bucket of words with the bucket's counts of counts."""
    def run(table: pa.Table) -> pa.Table:
        b = _Bucket(table)
        types, counts = b.continuations()
        coc, n = counts_of_counts(b.count), 1 << bits
        edges = _top(b.w, bits)
        part = lambda x: pa.array([x[edges[i]:edges[i + 1]].tobytes() for i in range(n)], pa.binary())
        bucket = table.column("bucket")[0].as_py()
        return pa.table({"w_bucket": pa.array(range(n), pa.int32()), "bucket": pa.array([bucket] * n, pa.int32()),
                         "w": part(b.w), "types": part(types), "counts": part(counts),
                         "coc": pa.array([coc] * n, pa.list_(pa.int64()))})
    return run


def _continue(table: pa.Table) -> pa.Table:
    """Total counts of a bucket's words, returned to the buckets that named them, with the bucket's totals."""
    get = lambda name, kind: [np.frombuffer(x.as_py(), kind) for x in table.column(name)]
    w = get("w", U)
    words, at = np.unique(np.concatenate(w), return_inverse=True)
    types = np.bincount(at, np.concatenate(get("types", np.int64)), len(words)).astype(np.int64)
    counts = np.bincount(at, np.concatenate(get("counts", np.int64)), len(words)).astype(np.int64)
    known = counts > 0
    totals = [*counts_of_counts(types[known]), int(types.sum()), int(counts.sum()), int(known.sum())]
    coc = np.array(table.column("coc").to_pylist()).sum(axis=0).tolist()
    at = np.split(at, np.cumsum([len(x) for x in w])[:-1])
    n = len(w)
    return pa.table({"bucket": table.column("bucket"), "w_bucket": table.column("w_bucket"),
                     "types": pa.array([types[a].tobytes() for a in at], pa.binary()),
                     "counts": pa.array([counts[a].tobytes() for a in at], pa.binary()),
                     "coc": pa.array([coc] * n, pa.list_(pa.int64())),
                     "words": pa.array([totals] * n, pa.list_(pa.int64()))})


def _mapped(x: np.ndarray) -> np.ndarray:
    """The array in a memory-mapped file that has no name and ends with the mapping."""
    if not len(x):
        return x
    with tempfile.TemporaryFile() as f:
        x.tofile(f)
        f.flush()
        return np.memmap(f, x.dtype, "r")


class Model:
    """A bucket's part of the model as sorted memory-mapped arrays."""

    def __init__(self, b: _Bucket, types: np.ndarray, counts: np.ndarray, coc: list[int], words: list[int]):
        *t_coc, t_all, self.n, self.v = words
        d, dt = discounts(coc), discounts(t_coc)
        cls = np.minimum(types, 3)
        left = dt[1] * t_coc[0] + dt[2] * t_coc[1] + dt[3] * (self.v - t_coc[0] - t_coc[1])
        if t_all:
            lower = np.maximum(types - dt[cls], 0) / t_all + left / t_all / (self.v + 1)
        else:
            lower = np.full(len(types), 1.0 / (self.v + 1))
        u, w = (b.key >> U(32)).astype(np.int64), (b.key & U(0xFFFFFFFF)).astype(np.int64)
        total = np.bincount(u, b.count, len(b.u))
        cls = np.minimum(b.count, 3)
        spare = np.bincount(u, d[cls], len(b.u))
        seen = total > 0
        spare = np.where(seen, spare / np.where(seen, total, 1), 1.0)
        p = np.maximum(b.count - d[cls], 0) / total[u] + spare[u] * lower[w] if len(u) else np.zeros(0)
        self.key, self.p = _mapped(b.key), _mapped(np.log10(p))
        self.lower, self.spare = _mapped(np.log10(lower)), _mapped(np.log10(np.maximum(spare, 1e-300)))
        self.counts = _mapped(counts)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probabilities of bigrams given as ``first word << 32 | word``."""
        out = np.asarray(self.spare[(keys >> U(32)).astype(np.int64)]
                         + self.lower[(keys & U(0xFFFFFFFF)).astype(np.int64)])
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
            hit = self.key[at] == keys
            out[hit] = self.p[at[hit]]
        return out


_PART = ("run long, score binary, base binary, known binary, n long, v long, "
         "ids array<long>, held_out array<boolean>, n_tokens array<long>")


def _score(sent: pa.Table, back: pa.Table) -> pa.Table:
    """Partial sums of every run's documents over the bigrams of a bucket."""
    cols: dict[str, list] = {x.split()[0]: [] for x in _PART.split(", ")}

    def add(**values):
        for name, c in cols.items():
            c.append(values.get(name))

    order = np.argsort(back.column("w_bucket").to_numpy(), kind="stable").tolist() if back.num_rows else []
    whole = lambda name: np.concatenate(
        [np.frombuffer(back.column(name)[i].as_py(), np.int64) for i in order] or [np.zeros(0, np.int64)])
    b = _Bucket(sent)
    if b.runs:
        words = np.array(back.column("words").to_pylist()).sum(axis=0).tolist()
        model = Model(b, whole("types"), whole("counts"), back.column("coc")[0].as_py(), words)
        logs = np.log10(model.counts + 1.0) - np.log10(model.n + model.v + 1.0)
        for run, n_docs, keys, docs in zip(b.runs, b.n_docs, b.keys, b.docs):
            w = (keys & U(0xFFFFFFFF)).astype(np.int64)
            add(run=run, score=np.bincount(docs, model.log10(keys), n_docs).tobytes(),
                base=np.bincount(docs, logs[w], n_docs).tobytes(),
                known=np.bincount(docs, model.counts[w] > 0, n_docs).astype(np.int32).tobytes(),
                n=int(model.n), v=int(model.v))
    for r in range(sent.num_rows):
        if sent.column("ids")[r].is_valid:
            add(run=sent.column("run")[r].as_py(),
                **{c: sent.column(c)[r].as_py() for c in ("ids", "held_out", "n_tokens")})
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(),
             pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(cols.items(), kinds)})


_OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, vocabulary long, "
        "base_score double, score double, perplexity double")


def _finish(table: pa.Table) -> pa.Table:
    """The documents of a run with their sums over all buckets."""
    own = next(i for i in range(table.num_rows) if table.column("ids")[i].is_valid)
    parts = [i for i in range(table.num_rows) if i != own]
    total = lambda name, kind: np.sum([np.frombuffer(table.column(name)[i].as_py(), kind) for i in parts], axis=0)
    n_tokens = np.array(table.column("n_tokens")[own].as_py(), np.int64)
    score, docs = total("score", np.float64), len(n_tokens)
    const = lambda name: pa.array([table.column(name)[parts[0]].as_py()] * docs, pa.int64())
    return pa.table({
        "doc_id": pa.array(table.column("ids")[own].as_py(), pa.int64()),
        "held_out": pa.array(table.column("held_out")[own].as_py(), pa.bool_()),
        "n_tokens": pa.array(n_tokens), "n_known": pa.array(total("known", np.int32).astype(np.int64)),
        "train_tokens": const("n"), "vocabulary": const("v"), "base_score": pa.array(total("base", np.float64)),
        "score": pa.array(score), "perplexity": pa.array(10.0 ** np.minimum(-score / n_tokens, 300))})


def score_corpus(docs: DataFrame, held_out: Column) -> DataFrame:
    """Every document scored by the model of the documents that are not held out.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, vocabulary, base_score,
    score, perplexity``.  Buckets are the power of two at or below the session's
    shuffle partitions, which its owner sizes to the data.
    """
    spark = docs.sparkSession
    bits = min(16, max(0, int(spark.conf.get("spark.sql.shuffle.partitions", "200")).bit_length() - 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    sent = rows.mapInArrow(_route(bits), _ROUTED)
    named = sent.groupBy("bucket").applyInArrow(_count(min(bits, _WORD_BITS)), _SENT)
    back = named.groupBy("w_bucket").applyInArrow(_continue, _BACK)
    parts = sent.groupBy("bucket").cogroup(back.groupBy("bucket")).applyInArrow(_score, _PART)
    return parts.groupBy("run").applyInArrow(_finish, _OUT)
