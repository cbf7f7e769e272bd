"""Mined phrases against counting of word tuples."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from posting_analytics.llm import bytetext as B
from posting_analytics.llm import collocations as C

from .conftest import ascii_lower


def plain(rows, max_words=3, min_count=10, cover=50, per_lang=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", ascii_lower(text or "")):
            w = tuple(x for x in re.split("[ \t]+", piece) if x)
            n[lang] += len(w)
            f.update((lang, w[i:i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    hidden = set()
    for (lang, long), b in found.items():
        for k in range(2, len(long)):
            for i in range(len(long) - k + 1):
                short = (lang, long[i:i + k])
                if 100 * b >= cover * found[short]:
                    hidden.add(short)
    out = []
    for (lang, w), a in found.items():
        if (lang, w) not in hidden:
            score, k = min((10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    seen, ranked = Counter(), []
    for lang, score, a, phrase, left, right, total in sorted(out):
        seen[lang] += 1
        if seen[lang] <= per_lang:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, total, -score))
    return ranked


def mined(spark, rows, extra=(), **params):
    d = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)],
                              "doc_id long, text string, lang string, phrase string, rank int").repartition(3)
    return sorted(tuple(r) for r in C.collocations(d, **params).collect())


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["New", "york", "city", "É", "sea", "a", "b", "the", "of x", "あ"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "!", " "]
    return [("".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(30))),
             rng.choice(["en", "de", "und", None, "a\tb c"])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_counting(llm, seed):
    rows = corpus(seed) + [(None, "en"), ("", None), (" .,; ", "fr"), ("x", "x")] + corpus(seed)[:20]
    assert mined(llm, rows) == sorted(plain(rows))


def test_longer_phrases_and_limits(llm):
    rows = corpus(3, 80)
    params = dict(max_words=5, min_count=3)
    assert mined(llm, rows, **params, cover_percent=30, per_lang=7) == sorted(plain(rows, 5, 3, 30, 7))
    assert mined(llm, rows, max_words=2, min_count=1, per_lang=None) == sorted(plain(rows, 2, 1, per_lang=10 ** 9))


def test_overlaps_ties_and_cover(llm):
    rows = [("a a a a a a a a a a a a a", "en"), ("b c. " * 12, "en"), ("d e f, " * 11, "en"), ("d e, " * 30, "en")]
    got = mined(llm, rows)
    assert got == sorted(plain(rows))
    assert {r[2] for r in got} == {"b c", "d e", "d e f", "a a a"}


def test_many_small_runs_and_buckets(llm, monkeypatch):
    """Runs cut inside texts and many buckets give the same phrases (sizes are read on the driver)."""
    monkeypatch.setattr(C, "PER_BUCKET", 5)
    rows = corpus(5, 120)
    assert mined(llm, rows) == sorted(plain(rows))


def test_long_texts_are_cut_between_pieces():
    text = "one two three. four five, six " * 200 + "no end " * 300 + "! last words"
    data, off = B.string_buffers(pa.array(["x y", text, "", "z. z"]))
    cut, of = C._cut_long(data, off, 100)
    assert len(cut) > 50 and cut[0] == 0 and cut[-1] == off[-1] and (np.diff(cut) >= 0).all()
    assert [int(of[np.searchsorted(cut, o, "left")]) for o in off[:-1]][:2] == [0, 1]
    whole, parts = C.occurrences(data, off, pa.array(["l"] * 4)), C.occurrences(data, cut, pa.array(["l"] * len(of)))
    assert parts["entries"] == whole["entries"] and parts["totals"] == whole["totals"]
    gaps = lambda r: np.diff(C.unpack(r["place"]).astype(np.int64))
    assert np.array_equal(gaps(whole), gaps(parts))


def test_later_runs_of_a_batch():
    """A run that does not begin at the batch's first byte has the words it has by itself."""
    texts, langs = pa.array(["x y", "new york city. sea", "", "z. \u00c9 a b"]), pa.array(["en", "de", "en", "fr"])
    data, off = B.string_buffers(texts)
    for a in range(4):
        for b in range(a + 1, 5):
            alone, alone_off = B.string_buffers(texts.slice(a, b - a).take(pa.array(range(b - a))))
            assert C.occurrences(data, off[a:b + 1], langs.slice(a, b - a)) == C.occurrences(
                alone, alone_off, langs.slice(a, b - a))


def test_batches_of_several_runs(llm):
    """More text in one batch than a run takes: every run's phrases count."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    rows = [(" ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(60)), rng.choice(["en", "de"]))
            for _ in range(300)]
    rows = [(t + " " + "q" * 100_000 + str(i % 9), lang) for i, (t, lang) in enumerate(rows)]  # 30 MB, four runs
    d = llm.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    assert sorted(tuple(r) for r in C.collocations(d.coalesce(1)).collect()) == sorted(plain(rows))


def test_packing():
    for top in (0, 255, 256, 65535, 65536, (1 << 32) - 1, 1 << 32, 1 << 62):
        x = np.array([0, top, 1], np.int64)
        assert C.unpack(C.pack(x)).astype(np.int64).tolist() == x.tolist()
    assert len(C.unpack(C.pack(np.zeros(0, np.int64)))) == 0


def test_large_counts_are_exact(llm):
    """Scores whose products pass 64 bits."""
    a, left, right = 3_000_000_019, 7_000_000_001, 9_000_000_011
    row = llm.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = row.selectExpr("cast(1000000 as decimal(7,0)) * (cast(a as decimal(19,0)) * cast(a as decimal(19,0))) div "
                         "(cast(l as decimal(19,0)) * cast(r as decimal(19,0))) s").first().s
    assert got == 10 ** 6 * a * a // (left * right)


def test_cases(llm):
    assert mined(llm, []) == [] and mined(llm, [(None, None), ("", "en")]) == []
    with pytest.raises(ValueError):
        mined(llm, [], max_words=1)
