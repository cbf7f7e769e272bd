import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from posting_analytics.llm import quality_cnn as Q


def corpus(n, seed=1):
    rng = random.Random(seed)
    vowel = "aeiou"
    word = lambda: "".join(rng.choice("bdklmnrst") + rng.choice(vowel) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 200))]
        bad = i % 3 == 0
        if bad:
            words = [w + rng.choice(["$$$", "%%%", "***"]) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_held_out_accuracy_and_folds(llm, docs_of):
    rows, labels = corpus(400)
    docs = docs_of(rows + [(1000, ""), (1001, None), (1002, "x" * 200_000), (None, "ka lo")])
    lab = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    net = Q.fit_quality(docs, lab)
    got = {r["doc_id"]: r for r in Q.score_quality(docs, net).collect()}
    assert len(got) == 404
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i, _ in rows)
    right = sum(got[i]["predicted"] == labels[i][1] for i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    kept = {r["doc_id"] for r in Q.good_documents(docs, net).collect()}
    assert kept == {i for i, r in got.items() if r["predicted"]}
    assert Q.good_documents(docs, net).columns == docs.columns


def test_labels_of_the_held_out_fold_are_not_learned(llm, docs_of):
    rows, labels = corpus(60)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y, t) for i, y, t in labels]
    docs = docs_of(rows)
    nets = [Q.fit_quality(docs, llm.createDataFrame(x, "doc_id long, quality int, toxic int"), per_class=50)
            for x in (labels, flipped)]
    assert all(np.array_equal(nets[0].p[k], nets[1].p[k]) for k in nets[0].p)


def test_without_labels_the_score_is_the_prior(llm, docs_of):
    docs = docs_of([(0, "a b"), (1, None)])
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in Q.score_quality(docs, Q.fit_quality(docs, none)).collect()} == {0.5}
    one = llm.createDataFrame([(0, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert len(Q.score_quality(docs, Q.fit_quality(docs, one)).collect()) == 2


def test_empty_table(llm, docs_of):
    net = Q.Network()
    assert Q.score_quality(docs_of([]), net).collect() == []


def test_chunks_cover_every_byte_and_pooling_matches_a_plain_convolution():
    rng = np.random.default_rng(0)
    sizes = [0, 1, Q.CHUNK, Q.CHUNK + 1, 5000]
    off = np.concatenate([[0], np.cumsum(sizes)])
    data = rng.integers(0, 256, off[-1]).astype(np.uint8)
    codes, first = Q.chunks(data, off)
    step = Q.CHUNK - Q.OVERLAP
    for i, n in enumerate(sizes):
        seen = np.zeros(n, bool)
        for c in range(first[i], first[i + 1]):
            at = (c - first[i]) * step
            m = min(Q.CHUNK, n - at)
            assert (codes[c, :m] == data[off[i] + at:off[i] + at + m]).all() and (codes[c, m:] == 256).all()
            seen[at:at + m] = True
        assert seen.all()
    net = Q.Network(3)
    r = net.responses(codes[:2])
    for c in range(2):
        for w in range(r.shape[1]):
            x = net.p["embed"][codes[c, w * Q.STRIDE:w * Q.STRIDE + Q.WIDTH]].ravel()
            assert np.allclose(r[c, w], x @ net.p["filters"], atol=1e-4)


def test_gradients_match_differences():
    rng = np.random.default_rng(5)
    off = np.array([0, 700, 900, 1000])
    data, y = rng.integers(0, 256, 1000).astype(np.uint8), np.array([1, 0, 1], np.float32)
    net = Q.Network(2)
    net.p["out"] = rng.normal(0, 0.5, net.p["out"].shape).astype(np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        s = net.scores(data, off)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grad = net.gradients(data, off, y)
    for name in ("filters", "bias", "out", "embed", "out_bias"):
        flat = net.p[name].reshape(-1)
        for j in rng.choice(flat.size, min(6, flat.size), replace=False):
            old, eps = flat[j], 1e-6
            flat[j] = old + eps
            up = loss()
            flat[j] = old - eps
            down = loss()
            flat[j] = old
            assert abs((up - down) / (2 * eps) - np.asarray(grad[name]).reshape(-1)[j]) < 2e-4


def test_fold_matches_crc32(llm):
    ids = llm.createDataFrame([(i,) for i in (0, 5, -7, 123456789)], "doc_id long")
    got = {r[0]: r[1] for r in ids.select("doc_id", Q.fold_of(F.col("doc_id"), 4)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 for i in got}
