"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.  In
a chunk every byte has a learned embedding, learned filters of eight bytes slide
over it by four, and each filter's response is rectified and max-pooled.  A
document's maximum and mean over its chunks are combined by a logistic unit into
one probability.  Filters, embeddings and the last unit are trained together by
Adam on a bounded sample of labelled documents.

The sample is fixed by hashes: up to ``per_class`` documents of each label of at
most ``max_bytes`` bytes, whatever the size of the corpus; it is the only bounded
part, and scoring reads every whole text.

Cases: a null text counts as empty, and an empty text gets the network's answer
to an empty chunk; a document with several label rows takes their mean (0.5 and
above is 1); null labels are ignored; without both labels in the sample every
score is the smoothed share of label 1; repeated rows are scored alike; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytetext as B
from .common import numbered, unused

CHUNK, OVERLAP, WIDTH, STRIDE = 512, 64, 8, 4
EMBED, FILTERS = 8, 48
PER_CLASS, MAX_BYTES, EPOCHS, BATCH_DOCS, SEED = 1024, 1 << 15, 12, 32, 7
THRESHOLD = 0.7
_PAD = 256


def chunks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(chunks x CHUNK byte codes, first chunk of each document)``; code 256 pads."""
    size, step = np.diff(off), CHUNK - OVERLAP
    per = 1 + np.maximum(0, -(-(size - CHUNK) // step))
    first = np.concatenate([[0], np.cumsum(per)])
    doc = np.repeat(np.arange(len(size)), per)
    begin = (np.arange(first[-1]) - first[doc]) * step
    at = begin[:, None] + np.arange(CHUNK)
    inside = at < size[doc][:, None]
    if not len(data):
        return np.full(inside.shape, _PAD, np.int16), first
    source = np.where(inside, at + off[doc][:, None], 0)
    return np.where(inside, data[source].astype(np.int16), np.int16(_PAD)), first


class Network:
    """``embed (257 x EMBED)``, ``filters (WIDTH * EMBED x FILTERS)``, ``bias``, ``out``, ``out_bias``."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
            "filters": rng.normal(0, (1.0 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": np.zeros(2 * FILTERS, np.float32), "out_bias": np.zeros(1, np.float32),
        }
        self.p["embed"][_PAD] = 0
        self.prior: float | None = None

    def responses(self, codes: np.ndarray) -> np.ndarray:
        """Filter responses, ``chunks x windows x FILTERS``, before the rectifier.

        A window is two steps of STRIDE bytes; each half is one matrix product
        over all steps, so no window is copied.
        """
        n, half = len(codes), STRIDE * EMBED
        e = self.p["embed"][codes.ravel()].reshape(n, CHUNK // STRIDE, half)
        flat = e.reshape(-1, half)
        left = (flat @ self.p["filters"][:half]).reshape(n, -1, FILTERS)
        right = (flat @ self.p["filters"][half:]).reshape(n, -1, FILTERS)
        left = left[:, :-1]
        left += right[:, 1:]
        return left

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        """Rectified maximum of each filter in each chunk."""
        return np.maximum(self.responses(codes).max(axis=1) + self.p["bias"], 0)

    def combine(self, pooled: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Document vectors: maximum and mean over the document's chunks."""
        at = first[:-1]
        mean = np.add.reduceat(pooled, at, axis=0) / np.diff(first)[:, None]
        return np.concatenate([np.maximum.reduceat(pooled, at, axis=0), mean], axis=1)

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(off) - 1, self.prior)
        out, step = [], 256
        codes, first = chunks(data, off)
        pooled = np.concatenate([self.pooled(codes[i:i + step]) for i in range(0, len(codes), step)])
        z = self.combine(pooled, first) @ self.p["out"] + self.p["out_bias"]
        out = 1.0 / (1.0 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))
        return out

    def gradients(self, data: np.ndarray, off: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss; only the maximal windows pass anything back."""
        codes, first = chunks(data, off)
        n, half = len(codes), STRIDE * EMBED
        r = self.responses(codes)
        where = r.argmax(axis=1)  # chunks x FILTERS
        top = np.take_along_axis(r, where[:, None, :], axis=1)[:, 0] + self.p["bias"]
        pooled = np.maximum(top, 0)
        x = self.combine(pooled, first)
        z = x @ self.p["out"] + self.p["out_bias"]
        d = ((1 / (1 + np.exp(-z))) - y).astype(np.float32) / len(y)
        doc = np.repeat(np.arange(len(y)), np.diff(first))
        dx = d[:, None] * self.p["out"]
        is_max = pooled == x[doc, :FILTERS]
        share = np.add.reduceat(is_max.astype(np.float32), first[:-1], axis=0)
        dp = dx[doc, :FILTERS] * is_max / share[doc] + dx[doc, FILTERS:] / np.diff(first)[doc][:, None]
        dp = dp * (top > 0)
        # the bytes of each maximal window
        at = where[:, :, None] * STRIDE + np.arange(WIDTH)  # chunks x FILTERS x WIDTH
        bytes_ = np.take_along_axis(codes[:, None, :].repeat(FILTERS, axis=1), at, axis=2)
        e = self.p["embed"][bytes_].reshape(n, FILTERS, WIDTH * EMBED)
        grad = {"filters": np.einsum("nf,nfk->kf", dp, e), "bias": dp.sum(axis=0)}
        de = (dp[:, :, None] * self.p["filters"].T[None]).reshape(n, FILTERS, WIDTH, EMBED)
        ge = np.zeros((257, EMBED), np.float32)
        for j in range(EMBED):
            ge[:, j] = np.bincount(bytes_.ravel(), weights=de[..., j].ravel(), minlength=257)
        ge[_PAD] = 0
        return grad | {"embed": ge, "out": x.T @ d, "out_bias": d.sum(keepdims=True)}


def train(texts: list[bytes], labels: np.ndarray, *, epochs: int = EPOCHS, batch_docs: int = BATCH_DOCS,
          rate: float = 0.01, decay: float = 1e-4, seed: int = SEED) -> Network:
    """Adam on the log loss, classes weighing alike."""
    net = Network(seed)
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        net.prior = float((y.sum() + 1) / (len(y) + 2))
        return net
    rng = np.random.default_rng(seed)
    sides = [np.flatnonzero(y == v) for v in (0, 1)]
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    t, steps = 0, max(1, len(y) // batch_docs)
    half = batch_docs // 2
    for epoch in range(epochs):
        queues = [np.concatenate([rng.permutation(s) for _ in range(-(-steps * half // len(s)))]) for s in sides]
        lr = rate * (1 - epoch / epochs)
        for b in range(steps):
            pick = np.concatenate([q[b * half:(b + 1) * half] for q in queues])
            joined = [texts[i] for i in pick]
            off = np.concatenate([[0], np.cumsum([len(x) for x in joined])])
            data = np.frombuffer(b"".join(joined), np.uint8)
            grad = net.gradients(data, off, y[pick])
            t += 1
            for k, g in grad.items():
                g = g + decay * net.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.p[k] = (net.p[k] - lr * (m[k] / (1 - 0.9 ** t))
                            / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
            net.p["embed"][_PAD] = 0
    return net


def fold_of(doc_id: Column, n: int) -> Column:
    """``crc32`` of the id's text, modulo n; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def training_sample(docs: DataFrame, labels: DataFrame, *, held_out: Column, label: str = "quality",
                    per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> list[tuple[bytes, int]]:
    """At most ``per_class`` labelled texts of each class, chosen by a hash of the id.

    Ids are chosen from the labels first (``per_class`` rows a class), so only
    the chosen texts leave the scan.
    """
    one = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg(label) >= 0.5).cast("int").alias("y"))
    one = one.filter(~held_out)
    order = [F.xxhash64("doc_id", F.lit(11)), F.col("doc_id")]
    chosen = [one.filter(F.col("y") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    ids = chosen[0].unionAll(chosen[1])  # at most 2 * per_class rows
    text = F.col("text").cast("string")
    rows = docs.filter(text.isNotNull() & (F.octet_length(text) <= max_bytes)).select(
        "doc_id", text.cast("binary").alias("text")).join(F.broadcast(ids), "doc_id")
    rows = rows.orderBy("doc_id", F.xxhash64("text")).limit(2 * per_class)
    return [(bytes(r["text"]), r["y"]) for r in rows.collect()]


def score_batches(net_b, text_at: int):
    """Batches with a ``score`` column put after their own columns."""
    def run(batches):
        net: Network = net_b.value
        for batch in batches:
            data, off = B.string_buffers(batch.column(text_at))
            parts = [net.scores(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                     for lo, hi in B.slices(data, off, 1 << 19, 4096)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(score, pa.float64())],
                                             names=batch.schema.names + ["score"])
    return run


def with_score(docs: DataFrame, net: Network, name: str = "_quality_score") -> DataFrame:
    """The rows of ``docs`` with a column ``name`` behind them; the network (about 50 kB) is broadcast."""
    rows = numbered(docs)
    schema = rows.withColumn("score", F.lit(0.0)).schema
    net_b = docs.sparkSession.sparkContext.broadcast(net)
    return rows.mapInArrow(score_batches(net_b, docs.columns.index("text")), schema).toDF(*docs.columns, name)


def fit_quality(docs: DataFrame, labels: DataFrame, **options) -> Network:
    """Train on labelled documents outside the held-out fold (remainder 2 of 4)."""
    held_out = fold_of(F.col("doc_id"), 4) == 2
    sample = training_sample(docs, labels, held_out=held_out, **options)
    return train([t for t, _ in sample], np.array([y for _, y in sample]))


def score_quality(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                  F.col("text").cast("string").alias("text")), net)
    return rows.select("doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"),
                       F.col("_quality_score").alias("score"),
                       (F.col("_quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns (of any name), that the network does not reject."""
    name = unused(docs, "_quality_score")
    return with_score(docs, net, name).filter(F.col(name) >= threshold).drop(name)
