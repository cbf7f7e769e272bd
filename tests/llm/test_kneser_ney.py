import collections
import math
import random
import zlib

from pyspark.sql import functions as F

from posting_analytics.llm import kneser_ney as N

from .conftest import ascii_lower, space_words


def brute(rows, held):
    """Interpolated modified Kneser-Ney from its formulas, with dictionaries."""
    tokens = [space_words(ascii_lower(t or "")) + [None] for _, t in rows]
    uni, bi = collections.Counter(), collections.Counter()
    for w, h in zip(tokens, held):
        if not h:
            uni.update(w)
            bi.update(zip(["<"] + w[:-1], w))
    n, v = sum(uni.values()), len(uni)
    before = collections.Counter(w for _, w in bi)

    def discount(values):
        c = collections.Counter(values)
        if not (c[1] and c[2] and c[3]):
            return lambda k: (0, 0.5, 1.0, 1.5)[min(k, 3)]
        y = c[1] / (c[1] + 2 * c[2])
        table = [0] + [min(max(k - (k + 1) * y * c[k + 1] / c[k], 0), k) for k in (1, 2, 3)]
        return lambda k: table[min(k, 3)]

    d, dt, types = discount(bi.values()), discount(before.values()), len(bi)
    context, spare = collections.Counter(), collections.Counter()
    for (u, _), k in bi.items():
        context[u] += k
        spare[u] += d(k)
    left = sum(dt(k) for k in before.values())

    def p(u, w):
        low = (max(before[w] - dt(before[w]), 0) / types + left / types / (v + 1)) if types else 1 / (v + 1)
        return (max(bi[u, w] - d(bi[u, w]), 0) + spare[u] * low) / context[u] if context[u] else low

    out = []
    for (i, _), w, h in zip(rows, tokens, held):
        out.append((i, h, len(w), sum(uni[x] > 0 for x in w), n,
                    sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w),
                    sum(math.log10(p(u, x)) for u, x in zip(["<"] + w[:-1], w))))
    return out


def check(docs_of, rows, held):
    flag = {i: h for (i, _), h in zip(rows, held)}
    marks = [i for i, h in flag.items() if h]
    df = N.score_corpus(docs_of(rows), F.col("doc_id").isin(marks) if marks else F.lit(False))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    got = sorted([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                  for r in df.collect()], key=key)
    want = sorted(brute(rows, held), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert abs(g[5] - w[5]) < 1e-6 and abs(g[6] - w[6]) < 1e-6


def test_against_formulas(docs_of):
    rng = random.Random(4)
    vocab = [f"w{i}é" for i in range(40)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (k + 1) for k in range(40)], k=rng.randint(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "W0É w0É W1é\x0bw1é"), (104, rows[3][1]),
             (105, "unseen words here"), (106, "w1é " * 30_000)]
    check(docs_of, rows, [zlib.crc32(str(i).encode()) % 7 == 2 or i in (104, 105) for i, _ in rows])


def test_nothing_to_learn_from_and_few_counts(docs_of):
    check(docs_of, [(1, "a b"), (2, None)], [True, True])
    check(docs_of, [(1, "a b a b"), (2, "b c")], [False, True])


def test_repeated_rows_and_empty_table(docs_of):
    check(docs_of, [(1, "a b"), (1, "a b"), (1, "c"), (2, "d")], [False, False, False, True])
    assert N.score_corpus(docs_of([]), F.lit(False)).collect() == []


def test_probabilities_of_a_context_sum_to_one(docs_of):
    rows = [(0, "a b a c a b b c d a b"), (1, "b a d d c a")]
    words = ["a", "b", "c", "d", "zz"]
    probes = [(10 + i, f"a {w}") for i, w in enumerate(words)] + [(30, "a")]
    df = N.score_corpus(docs_of(rows + probes), F.col("doc_id") >= 10)
    s = {r["doc_id"]: r["score"] for r in df.collect()}
    # p(x | a) = p(a x end) / (p(a | start) p(end | x)); check the sum by brute force of the same rows
    want = {r[0]: r[6] for r in brute(rows + probes, [i >= 10 for i, _ in rows + probes])}
    assert all(abs(s[i] - want[i]) < 1e-9 for i in want)


def test_the_routed_exchange_is_shared(docs_of):
    df = N.score_corpus(docs_of([(0, "a b"), (1, "b")]), F.lit(False))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
