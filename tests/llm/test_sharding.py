import random
import zlib

from posting_analytics.llm import sharding as S


def rows(n=800):
    rng = random.Random(8)
    out = [(i * 7919 % 100_003, "t" * rng.randint(0, 50) + "é") for i in range(n)]
    return out + [(5, None), (6, ""), (None, "x"), (None, None)] + [(9, "same")] * 20


def test_contract(docs_of):
    data = rows()
    got = S.assign_shards(docs_of(data)).collect()
    assert len(got) == len(data)
    by = {}
    for r in got:
        assert r["law"] == "key" and 0 <= r["shard"] < 24
        assert r["grown_shard"] == r["shard"] or r["grown_shard"] == 24
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert any(r["grown_shard"] == 24 for r in got) and len(by) == 24
    want = sorted(((i is not None, i or 0), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in data)
    assert sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["size"], r["text_crc32"]) for r in got) == want
    key = {}
    assert all(key.setdefault(r["doc_id"], r["shard"]) == r["shard"] for r in got)


def test_doc_id_and_count_alone_decide(docs_of):
    a = {r["doc_id"]: r["shard"] for r in S.assign_shards(docs_of([(i, "x") for i in range(200)])).collect()}
    b = {r["doc_id"]: r["shard"] for r in S.assign_shards(docs_of([(i, "other") for i in range(150)]).repartition(3)).collect()}
    assert all(a[i] == s for i, s in b.items())


def test_every_growth_step_moves_rows_only_into_the_new_shard(docs_of):
    docs = docs_of([(i, "") for i in range(400)])
    last = None
    for n in (1, 4, 5, 8, 9, 23, 24, 25):
        got = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in S.assign_shards(docs, n).collect()}
        assert all(g in (s, n) for s, g in got.values())
        if last and last[0] == n - 1:
            assert all(got[i][0] == g for i, (_, g) in last[1].items())
        last = (n, got)


def test_a_weight_moves_rows_only_between_its_shard_and_others(docs_of):
    docs = docs_of([(i, "") for i in range(3000)])
    a = {r["doc_id"]: r["shard"] for r in S.assign_shards(docs, 12).collect()}
    b = {r["doc_id"]: r["shard"] for r in S.assign_shards(docs, 12, weights={3: 4.0}).collect()}
    assert all(a[i] == b[i] or b[i] == 3 for i in a)
    n = [sum(s == k for s in b.values()) for k in range(12)]
    assert abs(n[3] - 3000 * 4 / 15) < 120 and all(abs(x - 200) < 70 for k, x in enumerate(n) if k != 3)


def test_descent_follows_the_tree():
    t = S.tree(25)
    assert [sum(len(r) for r in region) for region in t] == [8, 8, 8, 1]
    assert [i for region in t for rack in region for i, _ in rack] == list(range(25))


def test_empty_and_native(docs_of):
    assert S.assign_shards(docs_of([])).collect() == []
    plan = S.assign_shards(docs_of(rows(20)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_movement_stays_in_subtrees_whose_weight_changes(docs_of):
    docs = docs_of([(i, "") for i in range(3000)])
    at = lambda w: {r["doc_id"]: r["shard"] for r in S.assign_shards(docs, 24, weights=w).collect()}
    even, more, less = at(None), at({9: 3.0}), at({9: 0.25})
    for a, b in ((even, more), (less, even)):
        moved = [(a[i], b[i]) for i in a if a[i] != b[i]]
        assert moved and all(new == 9 for _, new in moved)
        for width in (8, 4, 1):  # regions, racks, shards: a key that leaves a node goes into the changed one
            assert all(new // width == 9 // width for old, new in moved if old // width != new // width)


def test_levels_decide(llm):
    """In a whole tree the region, the rack and the shard are those of least draw at their level."""
    from pyspark.sql import functions as F
    key, seed = F.col("id"), 29
    draw = lambda level, n: F.round(S._draw(key, level, F.lit(n), seed), 12)
    rows = llm.range(500).select(
        S.descend(S.tree(24), key).alias("shard"),
        F.array(*[draw(0, n) for n in range(3)]).alias("regions"), F.array(*[draw(1, n) for n in range(6)]).alias("racks"),
        F.array(*[draw(2, n) for n in range(24)]).alias("shards")).collect()
    for r in rows:
        region = min(range(3), key=lambda n: r["regions"][n])
        rack = min(range(2 * region, 2 * region + 2), key=lambda n: r["racks"][n])
        assert r["shard"] == min(range(4 * rack, 4 * rack + 4), key=lambda n: r["shards"][n])
    assert len({r["shard"] for r in rows}) == 24


def test_shares_of_partly_filled_trees(docs_of):
    docs = docs_of([(i, "") for i in range(6000)])
    for n in (7, 13, 22):
        count = [0] * n
        for r in S.assign_shards(docs, n).collect():
            count[r["shard"]] += 1
        mean = 6000 / n
        assert all(abs(c - mean) < 5 * mean ** 0.5 for c in count), (n, count)
