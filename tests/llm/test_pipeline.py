import random
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("corpus_pipeline")
import corpus_pipeline as P  # noqa: E402

from posting_analytics.llm import ngram_join, quality_cnn, sharding  # noqa: E402

from .test_decontam_tiling import brute as contaminated  # noqa: E402
from .test_ngram_join import brute as components  # noqa: E402


@pytest.fixture(scope="module")
def tables(llm, tmp_path_factory):
    rng = random.Random(3)
    vocab = [f"{a}{b}" for a in "bdklmnrst" for b in "aeiou"] + ["the", "of", "and"]
    word = lambda: "".join(rng.choices(vocab, k=rng.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(4)]
    docs, labels = [], []
    for i in range(240):
        w = [word() for _ in range(rng.randint(30, 90))]
        bad = i % 5 == 0
        if bad:
            w = [x + "$$$" for x in w]
        if i % 11 == 1:
            w = w + items[i % 4][1].split()
        docs.append((i, " ".join(w), "en", f"s{i % 4}" if i % 3 else "hot", 0))
        labels.append((i, 0 if bad else 1, 0))
    for i in range(240, 270):
        docs.append((i, docs[i - 200][1] + " extra", "en", "hot", 0))
    docs += [(400, None, None, None, None), (401, "", "en", "s1", 0)]
    at = str(tmp_path_factory.mktemp("tables"))
    llm.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    llm.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, docs, items


def test_every_stage_against_brute_force(llm, tables):
    at, rows, items = tables
    docs = llm.read.parquet(f"{at}/documents.parquet")
    cols, names = docs.columns, [n for n, _ in P.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mix", "shard"]
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())

    one = P.quality(llm, docs, at)
    net = quality_cnn.fit_quality(docs, llm.read.parquet(f"{at}/labels.parquet"))
    good = [r["doc_id"] for r in quality_cnn.score_quality(docs, net).collect() if r["predicted"]]
    assert ids(one) == sorted(good) and one.columns == cols
    clean = [i for i, *_ in rows if i < 240 and i % 5]
    assert len(set(clean) & set(good)) >= 0.97 * len(clean)
    assert len([i for i in good if i < 240 and i % 5 == 0]) <= 2

    kept = [(r[0], r[1]) for r in rows if r[0] in set(good)]
    two = P.near_duplicates(llm, one, at)
    found = components(kept)
    assert ids(two) == sorted({c for _, n, c in found if n} | {d for d, n, _ in found if not n}) and two.columns == cols

    left = [(r["doc_id"], r["text"]) for r in two.collect()]
    three = P.decontamination(llm, two, at)
    assert ids(three) == sorted(i for i, (n, _) in contaminated(left, items).items() if not n) and three.columns == cols

    four = P.mix(llm, three, at)
    assert four.columns == cols
    mixed, have = ids(four), set(ids(three))
    assert set(mixed) <= have and max(mixed.count(i) for i in set(mixed)) <= 2
    again = ids(P.mix(llm, three.repartition(3), at))
    assert mixed == again

    five = P.shard(llm, four, at)
    assert ids(five) == mixed
    slots = {}
    for r in five.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sorted(map(tuple, P.run(llm, at).collect())) == sorted(map(tuple, five.collect()))


def test_empty_documents(llm, tables, tmp_path):
    at, *_ = tables
    none = llm.read.parquet(f"{at}/documents.parquet").filter("doc_id < 0")
    docs = none
    for _, stage in P.STAGES:
        docs = stage(llm, docs, at)
        assert docs.collect() == []


def test_repeated_rows_and_extra_columns(llm, tables):
    at, *_ = tables
    docs = llm.read.parquet(f"{at}/documents.parquet")
    docs = docs.unionAll(docs.limit(20)).selectExpr("*", "1 AS shard", "'x' AS size", "zeroifnull(n_chars) AS contaminated")
    for name, stage in P.STAGES[:4]:
        out = stage(llm, docs, at)
        assert out.columns == docs.columns, name
        docs = llm.createDataFrame(out.collect(), out.schema)
    assert docs.count() > 0


CLASHING = ["target", "edge", "epochs", "rest", "last", "before", "source_size", "its_source", "ahead", "_source", "_SIZE",
            "_key", "_bucket", "_copies", "_copy", "_row", "_weight", "keep_id", "keep_sig", "many_id", "_sig", "_n", "sig",
            "n", "comp", "none", "w", "_quality_score", "__quality_score", "score", "_tiling_items", "_Tiling_Words",
            "held_out", "shard", "sub", "place", "start", "spot", "a b", "x.y"]


def test_any_extra_column_is_carried_unchanged(llm, tables):
    at, *_ = tables
    plain = llm.read.parquet(f"{at}/documents.parquet")
    plain = plain.unionAll(plain.limit(12))
    docs = plain.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("-"),
                                        F.coalesce("source", F.lit(""))).alias(c) for c in CLASHING])
    for name, stage in P.STAGES[:4]:
        out, without = stage(llm, docs, at), stage(llm, plain, at)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in without.collect()), name
        for r in rows:
            want = f"-{'' if r['doc_id'] is None else r['doc_id']}-{r['source'] or ''}"
            assert all(r[c] == c + want for c in CLASHING), name
    sharded = P.shard(llm, docs, at)
    assert sorted(map(tuple, sharded.collect())) == sorted(map(tuple, P.shard(llm, plain, at).collect()))


def test_registered_queries(llm):
    import __spark_entry__ as E
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and E.queries()["pipeline"] is P.run
    assert zlib.crc32(b"0") % 4 in range(4) and ngram_join.K == 4 and sharding.tree(24)
