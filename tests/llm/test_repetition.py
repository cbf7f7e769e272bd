"""Repetition measures against plain counting of word tuples and lines."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from posting_analytics.llm import bytetext as B
from posting_analytics.llm import repetition as R

from .conftest import space_words

TOP, DUP = (2, 3, 4), tuple(range(5, 11))


def plain(text):
    words = space_words(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)),
           "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": 0, "dup_line_chars": 0}
    seen = set()
    for line in text.split("\n"):
        if not space_words(line):
            continue
        if line in seen:
            out["n_dup_lines"] += 1
            out["dup_line_chars"] += sum(map(len, space_words(line)))
        seen.add(line)

    def grams(n):
        return [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]

    def covered(n, first):
        times, before, inside = Counter(grams(n)), set(), set()
        for i, g in enumerate(grams(n)):
            if times[g] > 1 and (first or g in before):
                inside |= set(range(i, i + n))
            before.add(g)
        return inside

    out["n_repeat_words"] = len(covered(3, True))
    out["top"] = {n: max([k * len("".join(g)) for g, k in Counter(grams(n)).items() if k > 1], default=0)
                  for n in TOP}
    out["dup"] = {n: sum(len(words[i]) for i in covered(n, False)) for n in DUP}
    return out


TEXTS = ["", "a", "a a a a a a a a a a a a a", "x\n\nx\n x\nx", "a b c a b c\na b c\n", "  ", "\n", "é é é # é\x85é é é",
         "w" * 900 + " " + "w" * 900 + "\n" + "w" * 900, ("long line " * 60 + "\n") * 3, "a\vb\fc\rd a\vb\fc\rd"]


def _texts():
    rng = random.Random(11)
    out = list(TEXTS)
    for _ in range(250):
        out.append("".join(rng.choice("ab \n\t|é") for _ in range(rng.randrange(90))))
    for _ in range(60):  # sentences said again
        lines = [" ".join(rng.choice(("the", "of", "sea", "ship", "a")) for _ in range(rng.randrange(1, 14)))
                 for _ in range(6)]
        out.append("\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 20))))
    return out


@pytest.mark.parametrize("most_bytes", [1, 700, 1 << 20])
def test_measures_equal_plain_counting(most_bytes):
    texts = _texts()
    data, off = B.string_buffers(pa.array(texts))
    for a, b in B.slices(data, off, most_bytes, 50):
        m = R.measures(data, off[a:b + 1], TOP, DUP)
        for i in range(a, b):
            want = plain(texts[i])
            got = {k: ({n: int(x[i - a]) for n, x in m[k].items()} if k in ("top", "dup") else int(m[k][i - a]))
                   for k in want}
            assert got == want, texts[i]


def test_window_hashes_do_not_run_over_documents():
    hashes = np.tile(np.arange(1, 5, dtype=np.uint64), 2)  # the same four words in two documents
    win = R.Windows(hashes, np.array([0, 4, 8]))
    assert len(win.twice(2, np.arange(8))[0]) == 0
    assert sorted(R.Windows(hashes, np.array([0, 8])).twice(4, np.arange(8))[0]) == [0, 4]


def test_thresholds(llm, docs_of):
    fresh = " ".join(f"w{i}" for i in range(60))
    rows = [(1, fresh), (2, " ".join(fresh.split()[:49])), (3, "a b c " * 40), (4, None), (5, ""), (None, fresh),
            (6, (fresh + "\n") * 2), (7, fresh + " " + " ".join(fresh.split()[:9])), (1, fresh)]
    got = sorted(((r.doc_id or 0, r.kept, tuple(r.failed)) for r in R.verdicts(docs_of(rows)).collect()))
    by_id = {g[0]: g for g in got}
    assert len(got) == len(rows) and [g[:2] for g in got if g[0] in (0, 1)] == [(0, True), (1, True), (1, True)]
    assert by_id[2][2] == ("min_words",) and by_id[4][2] == by_id[5][2] == ("min_words",)
    assert "repeat_words" in by_id[3][2] and "dup_5gram" in by_id[3][2]
    assert "dup_lines" in by_id[6][2] and "dup_10gram" in by_id[6][2] and not by_id[6][1]
    assert by_id[7][1]  # nine words said again: under every share


def test_limits_are_parameters(llm, docs_of):
    d = docs_of([(1, "a b c d e f g h a b c d")])
    assert R.verdicts(d, top={}, dup={4: 0.5}, min_words=1, max_repeat_percent=100).first().kept
    assert not R.verdicts(d, top={}, dup={4: 0.3}, min_words=1, max_repeat_percent=100).first().kept
    with pytest.raises(ValueError):
        R.verdicts(d, dup={1: 0.5})


def test_kept_documents_carries_any_column(llm):
    fresh = " ".join(f"w{i}" for i in range(60))
    names = ["doc_id", "text", "repetition", "_repetition", "m", "kept", "c1", "a.b"]
    rows = [(1, fresh, "a", 1, 2.0, False, "x", None), (2, "a b", "b", 2, 3.0, True, "y", None)]
    d = llm.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in zip(
        names, ("long", "string", "string", "int", "double", "boolean", "string", "int"))))
    out = R.kept_documents(d)
    assert out.columns == names and [tuple(r) for r in out.collect()] == rows[:1]


def test_empty_table(llm, docs_of):
    assert R.verdicts(docs_of([(1, "a")]).limit(0)).count() == 0
    assert R.kept_documents(docs_of([(1, "a")]).limit(0)).count() == 0


def test_long_text_is_measured_whole():
    text = " ".join(f"w{i}" for i in range(300_000)) + " " + " ".join(f"w{i}" for i in range(20))
    data, off = B.string_buffers(pa.array([text]))
    m = R.measures(data, off, TOP, DUP)
    assert m["n_repeat_words"][0] == 40 and m["dup"][10][0] == len(re.sub(" ", "", " ".join(f"w{i}" for i in range(20))))
