import math
import random
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from posting_analytics.llm import topk_search
from posting_analytics.llm.topk_search import exact_top_k


def brute(rows, k, step, scale=256):
    ok = [(i, [int(math.floor(scale * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    least = {}
    for i, v in sorted((r for r in rows if r[0] is not None and r[0] % step == 0 and (r[0], None) != r and r[1] is not None
                        and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0], r[1])):
        least.setdefault(i, [int(math.floor(scale * float(x))) for x in v])
    out = set()
    for q, v in least.items():
        found = sorted(((-sum(a * b for a, b in zip(v, c)), i) for i, c in ok if i != q and len(c) == len(v)))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    return out


def run(llm, rows, k=5, step=5):
    df = llm.createDataFrame([(i, v, "e") for i, v in rows], "vec_id long, embedding array<float>, score string")
    return sorted(map(tuple, exact_top_k(df, F.col("vec_id") % step == 0, k).collect()))


def test_random_with_ties_nulls_and_odd_vectors(llm):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.uniform(-1, 1))) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[10][1]) for i in range(30)]  # many equal vectors: ties by id
    rows += [(300, None), (305, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (310, [float("nan")] * 6),
             (315, [float("inf")] + [0.0] * 5), (320, []), (325, [0.5, 0.25]), (330, [0.25, 0.5]), (None, rows[0][1])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(llm, rows) == sorted(brute(rows, 5, 5))


def test_repeated_ids_are_queried_once(llm):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.5]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.0, 2.0])]
    assert run(llm, rows, k=3) == sorted(brute(rows, 3, 5))


def test_large_components_stay_exact(llm):
    rows = [(0, [2.0 ** 40, 1.0]), (1, [2.0 ** 40, 3.0]), (2, [2.0 ** 40, 2.0]), (3, [-2.0 ** 40, 0.0])]
    got = {(r[2], r[1]) for r in run(llm, rows)}
    assert got == {(1, 1), (2, 2), (3, 3)} or got == {(1, 1), (2, 2), (3, 3)}


def test_few_candidates_and_empty_table(llm):
    assert run(llm, [(0, [1.0])]) == []
    assert run(llm, [(0, [1.0]), (7, [2.0])]) == [(0, 1, 7, 256 * 512)]
    assert run(llm, []) == []


@pytest.mark.parametrize("k", [1, 40])
def test_other_k(llm, k):
    rng = random.Random(k)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(60)]
    assert run(llm, rows, k=k, step=7) == sorted(brute(rows, k, 7))


def test_the_ranges_of_a_block_meet_its_histogram_once(llm, monkeypatch, tmp_path):
    made = topk_search._narrow

    def narrow(width):
        run = made(width)

        def measured(one, other):
            tables = [t for t in (one, other) if isinstance(t, pa.Table)]
            (tmp_path / uuid.uuid4().hex).write_text(str(sum(t.nbytes for t in tables)))
            return run(*tables)
        return measured

    monkeypatch.setattr(topk_search, "_narrow", narrow)
    rng = random.Random(8)
    rows = [(i, [float(np.float32(rng.uniform(-1, 1))) for _ in range(4)]) for i in range(400)]
    assert run(llm, rows, k=3, step=1) == sorted(brute(rows, 3, 1))
    read = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert read and max(read) < 2_000_000  # 400 queries with a copy of all ranges beside each bin: 40 MB


@pytest.mark.parametrize("k", [2, 40])
def test_many_cells_of_candidates_and_queries(llm, monkeypatch, k):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk_search, "CELL", 200)
    rng = random.Random(k)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(6 if i % 9 else 2)]) for i in range(300)]
    rows += [(400 + i, [1.0, 2.0, 0.0, -1.0, 1.0, 0.5 * (i % 2)]) for i in range(60)]
    rows += [(500 + i, [300.0 * i, 1.0, 0.0, 0.0, 0.0, 70000.0 * (i % 3)]) for i in range(30)]  # wider numbers
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(9)
    got = sorted(map(tuple, exact_top_k(df, F.col("vec_id") % 5 == 0, k).collect()))
    assert got == sorted(brute(rows, k, 5))


@pytest.mark.parametrize("order", [1, -1])
def test_candidates_of_rising_and_falling_scores(llm, order):
    rows = [(i, [1.0 + order * (i // 3) / 1000, 1.0]) for i in range(4000)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    got = sorted(map(tuple, exact_top_k(df, F.col("vec_id") % 500 == 0, 5).collect()))
    assert got == sorted(brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 5, 500))
