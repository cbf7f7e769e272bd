import random

import numpy as np

from posting_analytics.llm import decontam_tiling as D

from .test_license_index import words


def greedy(doc, item, least):
    """Greedy string tiling as defined: longest unmarked common runs first."""
    used_d, used_i, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best, found = least - 1, []
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while (a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n]
                       and not used_d[a + n] and not used_i[b + n]):
                    n += 1
                if n > best:
                    best, found = n, [(a, b)]
                elif n == best and n >= least:
                    found.append((a, b))
        if not found:
            return tiles
        for a, b in found:
            if not any(used_d[a:a + best]) and not any(used_i[b:b + best]):
                used_d[a:a + best], used_i[b:b + best] = [True] * best, [True] * best
                tiles.append((a, b, best))


def brute(docs, items, least=D.MIN_MATCH, share=D.COVERAGE):
    out = {}
    for n, text in docs:
        w, hits = words(text), []
        for i, t in items:
            v = words(t)
            if i is None or t is None or not v:
                continue
            covered = sum(x[2] for x in greedy(w, v, min(least, len(v))))
            if covered >= share * len(v) and covered:
                hits.append((covered / len(v), -i))
        out[n] = (len({i for _, i in hits}), max(hits)) if hits else (0, None)
    return out


def bench(llm, items):
    return llm.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def test_planted_passages_against_greedy_tiling(llm, docs_of):
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(12, 40)))) for i in range(12)] + [(50, "Short one."), (51, None), (52, "")]
    docs = []
    for i in range(60):
        body = rng.choices(vocab, k=rng.randint(0, 80))
        _, t = items[rng.randrange(12)]
        w, kind = t.split(), i % 6
        if kind == 1:
            body[len(body) // 2:0] = w
        elif kind == 2:  # reordered
            h = len(w) // 2
            body = body + w[h:] + rng.choices(vocab, k=5) + w[:h]
        elif kind == 3:  # a part below the threshold
            body = body + w[:len(w) // 3]
        elif kind == 4:  # with changed words
            body = body + [x if k % 9 else "zzz" for k, x in enumerate(w)]
        docs.append((i, " ".join(body).upper() if kind == 5 else ", ".join(body)))
    docs += [(100, None), (101, ""), (102, "this is SHORT, one."), (103, "w " * 20_000 + items[0][1])]
    got = {r["doc_id"]: r for r in D.decontaminate(docs_of(docs), bench(llm, items)).collect()}
    want = brute([d for d in docs if d[0] != 103], items)
    for i, (n, best) in want.items():
        r = got[i]
        assert r["contaminated"] == bool(n) and r["n_items"] == n, (i, r, n, best)
        if n:
            assert abs(r["coverage"] - best[0]) < 1e-12 and r["item_id"] == -best[1]
        else:
            assert r["item_id"] is None and r["coverage"] == 0
    assert got[103]["contaminated"] and got[103]["item_id"] == 0
    kept = D.clean_documents(docs_of(docs), bench(llm, items))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["contaminated"]}
    assert kept.columns == docs_of(docs).columns


def test_tiles_on_few_words_equal_the_definition_in_coverage_order():
    rng = random.Random(2)
    from posting_analytics.llm import bytetext as B
    for _ in range(200):
        doc = [rng.choice("abcd") for _ in range(rng.randint(5, 40))]
        item = [rng.choice("abcd") for _ in range(rng.randint(5, 25))]
        hd, hi = (B.hash_words(" ".join(x)) for x in (doc, item))
        pairs = [(a, b) for a in range(len(doc) - 2) for b in range(len(item) - 2) if doc[a:a + 3] == item[b:b + 3]]
        got = D.tiles(hd, hi, np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]), 3) if pairs else []
        marked_d, marked_i, last = set(), set(), 10**9
        for a, b, n in got:
            assert doc[a:a + n] == item[b:b + n] and n >= 3 and n <= last
            last = n
            assert not marked_d & set(range(a, a + n)) and not marked_i & set(range(b, b + n))
            marked_d |= set(range(a, a + n))
            marked_i |= set(range(b, b + n))
        first = greedy(doc, item, 3)
        assert (got[0][2] if got else 0) == (first[0][2] if first else 0)
        # nothing is left to mark
        for a, b in pairs:
            n = 3
            assert set(range(a, a + n)) & marked_d or set(range(b, b + n)) & marked_i


def test_blocks_of_a_large_benchmark_agree(llm, docs_of):
    rng = random.Random(1)
    items = [(i, " ".join(f"x{rng.randint(0, 99)}" for _ in range(20))) for i in range(15)]
    docs = docs_of([(i, "a b c " + items[i % 15][1] + " " + items[(i + 4) % 15][1]) for i in range(30)])
    rows = lambda **o: sorted(map(tuple, D.decontaminate(docs, bench(llm, items), **o).collect()))
    assert rows() == rows(block_seeds=30)


def test_empty_sides_null_ids_and_repeats(llm, docs_of):
    one = "one two three four five six seven"
    docs = docs_of([(None, one), (None, "clean text"), (1, one), (1, "other")])
    items = bench(llm, [(7, one), (7, one)])
    got = sorted((r["doc_id"] is None, r["contaminated"], r["n_items"]) for r in D.decontaminate(docs, items).collect())
    assert got == [(False, False, 0), (False, True, 1), (True, False, 0), (True, True, 1)]
    assert not any(r["contaminated"] for r in D.decontaminate(docs, bench(llm, [])).collect())
    assert D.decontaminate(docs_of([]), items).collect() == []
    assert len(D.clean_documents(docs, items).collect()) == 2


def test_passes_give_the_tiles_of_the_listed_places():
    rng = random.Random(6)
    from posting_analytics.llm import bytetext as B
    for n in range(300):
        letters = "ab" if n % 2 else "abcdef"
        doc = [rng.choice(letters) for _ in range(rng.randint(3, 60))]
        item = [rng.choice(letters) for _ in range(rng.randint(3, 30))]
        hd, hi = (B.hash_words(" ".join(x)) for x in (doc, item))
        got = D.passed_tiles(hd, hi, 3)
        assert got == greedy(doc, item, 3), (doc, item)


def test_equal_words_take_memory_of_their_number_only():
    import tracemalloc
    from posting_analytics.llm import bytetext as B
    block = D.Block([(1, B.hash_words("same " * 400)), (2, B.hash_words("same other " * 200))], 5)
    data = np.frombuffer(("same " * 40_000).encode(), np.uint8)
    w = B.words(data, np.array([0, len(data)]), B.ALNUM)
    tracemalloc.start()
    hits = D._hits(block, w, 5, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hits == {0: [(1, 400, 400, 400)]} and peak < 50 << 20, (hits, peak)


def test_repeated_words_through_spark(llm, docs_of):
    rows = [(1, "a b " * 5000), (2, "a " * 10_000), (3, "a b c d " * 500)]
    items = [(1, "a b " * 40), (2, "a " * 60), (3, "b a " * 30 + "z z z")]
    got = {r["doc_id"]: r["n_items"] for r in D.decontaminate(docs_of(rows), bench(llm, items)).collect()}
    assert got == {1: 2, 2: 1, 3: 0}
