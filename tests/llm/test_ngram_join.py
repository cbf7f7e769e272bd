import collections
import itertools
import random

import numpy as np
import pytest

from posting_analytics.llm import ngram_join as N

from .conftest import ascii_lower, space_words


def sets_of(rows, k=4):
    out = []
    for _, t in rows:
        w = space_words(ascii_lower(t or ""))
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def brute(rows):
    s = sets_of(rows)
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if s[a] and s[b]:
            both = len(s[a] & s[b])
            if 100 * both >= 85 * (len(s[a]) + len(s[b]) - both):
                label[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def run(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.near_duplicates(df).collect()), key=str)


def corpus(seed, groups=30):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    shared = rng.choices(vocab, k=70)
    rows, ids = [], iter(rng.sample(range(10_000), 3000))
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.choice([3, 5, 8, 30, 90, 250, 900]))
        if rng.random() < 0.3:
            base = base + shared  # a passage that many documents hold
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.3:
                w = w[:len(w) - rng.randint(0, len(w) // 8)]
            rows.append((next(ids), rng.choice([" ", "\n", "  "]).join(w).replace("w", rng.choice("wW"))))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(docs_of, seed):
    rows = corpus(seed)
    assert run(docs_of(rows)) == brute(rows)


def test_a_large_group_of_near_copies_uses_many_leaves(docs_of, monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(N, "LEAF", 8)  # driver side: how leaves are cut
    base = [f"k{i}" for i in range(200)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(200)] = f"z{rng.randint(0, 50)}"
        rows.append((i * 3 + 1, " ".join(w[:200 - rng.randint(0, 20)])))
    rows += corpus(9, groups=12)
    assert run(docs_of(rows)) == brute(rows)


def test_near_copies_of_one_part_send_no_leaf_pairs(docs_of, monkeypatch):
    """Leaves of what hubs connect are not joined with each other; points outside the part still meet it."""
    rng = random.Random(11)
    monkeypatch.setattr(N, "LEAF", 8)
    base = [f"k{i}" for i in range(200)]
    rows = []
    for i in range(160):  # near copies: every pair links
        w = list(base)
        w[rng.randrange(200)] = f"z{i}"
        rows.append((i, " ".join(w)))
    for i in range(6):  # a chain that leads away from them, a few words more each time
        rows.append((200 + i, " ".join(base + [f"y{j}" for j in range(20 * (i + 1))])))
    seen = []
    pairs = N._leaf_pairs
    monkeypatch.setattr(N, "_leaf_pairs", lambda leaves: (seen.append((leaves, pairs(leaves))), seen[-1][1])[1])
    assert run(docs_of(rows)) == brute(rows)
    leaves, found = seen[0]
    own = {r["leaf"]: r["own"] for r in leaves.filter("band >= 0").select("leaf", "own").collect()}
    inside = sum(v is not None for v in own.values())
    assert inside >= 160 // 8
    sent = [(r["leaf"], r["leaf2"]) for r in found.collect()]
    assert all(own[a] is None or own[a] != own[b] for a, b in sent)
    assert len(sent) <= inside * (len(own) - inside + 1)  # not with the square of the group


def test_chains_exact_threshold_and_special_rows(docs_of):
    base = [f"a{i}" for i in range(43)]  # 40 shingles
    rows = [(5, " ".join(base)), (4, " ".join(base + ["q1", "q2", "q3"])), (3, " ".join(base + [f"q{i}" for i in range(1, 8)])),
            (2, " ".join(base + [f"q{i}" for i in range(1, 9)])), (10, " ".join(base + [f"q{i}" for i in range(1, 12)])),
            (20, None), (21, ""), (22, " \n"), (23, "one"), (24, "ONE"), (25, "one two"), (26, "one two three"),
            (27, "one two three four"), (5, " ".join(base)), (None, "one"), (None, "lonely words are here now"), (30, "x y z w " * 20_000),
            (31, "x y z w " * 10_000)]
    assert run(docs_of(rows)) == brute(rows)


def test_one_of_each_group_stays(docs_of):
    rows = corpus(4, groups=15)
    kept = N.one_of_each(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})
    text = dict(rows)
    assert all(r["text"] == text[r["doc_id"]] for r in kept.collect())


def test_one_of_each_with_shared_and_null_ids(docs_of):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "other words stand here"), (2, "a b c d e"), (None, "null id text here"),
            (None, "null id text here"), (None, "a b c d e"), (3, ""), (3, None), (3, ""), (4, "single words of its own")]
    got = sorted(((r["doc_id"], r["text"]) for r in N.one_of_each(docs_of(rows)).collect()), key=str)
    want = sorted([(1, "a b c d e"), (1, "other words stand here"), (None, "null id text here"), (3, ""), (3, None), (3, ""),
                   (4, "single words of its own")], key=str)
    assert got == want


def test_empty_table(docs_of):
    assert run(docs_of([])) == [] and N.one_of_each(docs_of([])).collect() == []


def test_tree_search_finds_every_partner():
    rng = np.random.default_rng(3)
    keys = []
    for _ in range(60):
        base = rng.integers(0, 1 << 52, rng.integers(5, 300)).astype(np.uint64)
        for _ in range(3):
            drop = rng.random(len(base)) > 0.04
            keys.append(np.unique(np.concatenate([base[drop], rng.integers(0, 1 << 52, 1).astype(np.uint64)])))
    sizes = np.array([len(k) for k in keys])
    tree = N.Tree(np.stack([N.count_vector(k) for k in keys]), sizes)
    tested = 0
    for i, k in enumerate(keys):
        found = {int(tree.order[p]) for p in tree.search(N.count_vector(k), len(k), np.ones(len(keys), bool))}
        tested += len(found)
        for j, o in enumerate(keys):
            both = len(np.intersect1d(k, o))
            if 100 * both >= 85 * (len(k) + len(o) - both):
                assert j in found
    assert tested < 0.2 * len(keys) ** 2  # the bound does prune


def test_planes_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert (N._unplanes(N._planes(x)) == x).all()


def test_components_of_long_chains(llm):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 102), (102, 101), (7, 7)]
    got = {r["node"]: r["label"] for r in N.components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
    assert collections.Counter(got.values()) == {0: 61, 100: 3}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(150)], [(i + 1, i) for i in range(150)], [(0, i) for i in range(1, 60)],
    [(99, i) for i in range(60)], [(i, i + 2) for i in range(80)] + [(7, 7), (5, 3), (3, 5)],
    [(i * 37 % 101, i * 53 % 101) for i in range(60)] + [(-5, 2 ** 62), (2 ** 62, -7)]])
def test_components(llm, edges):
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    got = N.components(llm.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.label for r in got.collect()} == {x: top(x) for x in parent} and got.count() == len(parent)


@pytest.mark.parametrize("most", [0, 3, 40])
def test_components_by_rounds_and_what_they_leave(llm, monkeypatch, most):
    """Rounds over all edges, or until a few are left, give the same as one task for all."""
    rng = random.Random(most)
    edges = [(i, i + 1) for i in range(70)] + [(rng.randrange(100, 190), rng.randrange(100, 190)) for _ in range(60)]
    df = llm.createDataFrame(edges + [(-5, 2 ** 62), (2 ** 62, -7)], "a long, b long")
    want = sorted(tuple(r) for r in N.components(df).collect())
    monkeypatch.setattr(N, "EDGES", most)
    assert sorted(tuple(r) for r in N.components(df).collect()) == want
    assert [x for x in want if x[0] < 71] == [(-7, -7), (-5, -7)] + [(i, 0) for i in range(71)]


def test_components_of_few_edges_take_few_jobs(llm):
    """The driver keeps plans, threads and broadcasts of every job: a short edge list makes no rounds."""
    df = llm.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    llm.sparkContext.setJobGroup("few-edges", "components")
    try:
        got = N.components(df).collect()
    finally:
        llm.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["label"] for r in got} == {0} and len(got) == 301
    assert len(llm.sparkContext.statusTracker().getJobIdsForGroup("few-edges")) <= 10
