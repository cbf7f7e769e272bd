"""Aligned tokens against cutting both token lists by their decoded bytes."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from posting_analytics.llm import token_alignment as T

pytestmark = pytest.mark.skipif(not os.path.exists(T.A_PATH), reason="no tokenizer files")


@pytest.fixture(scope="module")
def models():
    return T._tokenizer(T.A_PATH), T._tokenizer(T.B_PATH)


def plain_tokens(text, models):
    """(id, bytes) of both tokenizers, or None where they do not give the text back."""
    a, b = models
    byte = T.byte_of_char()
    ids = a.model.encode(" " + text, add_special_tokens=False).ids
    left = [(i, bytes(byte[c] for c in a.model.id_to_token(i))) for i in ids]
    right = []
    for i in b.model.encode(text):
        piece = b.model.id_to_piece(i)
        right.append((i, bytes.fromhex(piece[3:5]) if b.model.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (left, right) if all(b"".join(x for _, x in s) == raw for s in (left, right)) else None


def plain(rows, models):
    kept, count = [], Counter()
    for doc, text in rows:
        tokens = plain_tokens(text, models) if text else None
        if tokens is None:
            kept.append((doc, None))
            continue
        ends = []
        for side in tokens:
            at, here = 0, []
            for _, x in side:
                at += len(x)
                here.append(at)
            ends.append(here)
        both = set(ends[0]) & set(ends[1])
        groups, links, open_a, open_b, j = [], [], [], [], 0
        for (i, _), e in zip(tokens[0], ends[0]):
            open_a.append(i)
            if e in both:
                while True:
                    open_b.append(tokens[1][j][0])
                    j += 1
                    if ends[1][j - 1] == e:
                        break
                groups.append(f"{','.join(map(str, open_a))}|{','.join(map(str, open_b))}")
                links.append((open_a[-1], open_b[-1]))
                open_a, open_b = [], []
        count.update(links)
        kept.append((doc, (len(tokens[0]), len(tokens[1]), links, ";".join(groups))))
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for doc, x in kept:
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, links, text = x
            out.append((doc, n_a, n_b, len(links), len(links), sum(count[p] == best[p[1]] for p in links),
                        sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


CASES = [None, "", " ", "  ", "\n", "a", " lead", "  two  gaps ", "\x00", "<|endoftext|> <s> </s> <unk> <0x41>",
         "▁x", "a▁b", "café 日本\U0001d4b3 \U0001f469‍\U0001f467", "́́", "ﬁ ½ ①", "x" * 5000,
         "tab\tand\r\nline  end", "don't I'll we're", " 　x"]


def _rows():
    rng = random.Random(13)
    rows = list(enumerate(CASES))
    for k in range(200):
        rows.append((100 + k, "".join(rng.choice("ab é日\U0001d4b3▁\n\t <|>́ﬁ\r\x00") for _ in range(rng.randrange(50)))))
    for k in range(60):
        words = ("the", "ship", "été", "日本", "2,000", "it's", "\U0001f600")
        rows.append((400 + k, " ".join(rng.choice(words) for _ in range(rng.randrange(80)))))
    return rows + rows[:40] + [(None, "no id"), (None, None)]


def test_equals_plain_cutting(llm, models):
    rows = _rows()
    d = llm.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, a int, run string")
    got = sorted((tuple(r) for r in T.align_corpus(d.repartition(4)).collect()), key=str)
    assert got == sorted(plain(rows, models), key=str)


def test_units_give_the_tokens_of_the_whole_text(models):
    """Groups of the units joined are those of the text tokenised as one unit."""
    texts = [t for _, t in _rows() if t]
    cut, whole = T.Units(*models), T.Units(*models)
    unit, n = cut.numbers([t.encode() for t in texts])
    for text in texts:
        whole._learn([text])
    edge = np.concatenate([[0], np.cumsum(n)])
    for i, text in enumerate(texts):
        own = unit[edge[i]:edge[i + 1]]
        assert bool(cut.bad[own].any()) == bool(whole.bad[i]), text
        if not whole.bad[i]:
            assert b";".join(cut.groups[u] for u in own) == whole.groups[i]
            assert cut.n_links[own].sum() == whole.n_links[i] and cut.n_a[own].sum() == whole.n_a[i]


def test_forgetting_and_small_batches(models, monkeypatch):
    texts = [(t or "").encode() for _, t in _rows()]
    want = T.aligned_run(texts, T.Units(*models))
    monkeypatch.setattr(T, "_BATCH_CHARS", 30)
    known = T.Units(*models)
    assert T.aligned_run(texts, known) == want
    monkeypatch.setattr(T, "REMEMBERED", 60)
    for _ in range(3):  # units may be numbered otherwise
        got = T.aligned_run(texts, known)
        assert all(got[c] == want[c] for c in ("n_a", "n_b", "n_links", "n_units", "digest", "a", "b", "n"))
    known.forget()
    assert 0 < len(known.number) == len(known.groups) == len(known.seen) <= 30


def test_spans_and_bytes_agree(models):
    """Refined from spans, ends are those of the decoded bytes wherever the text comes back."""
    for _, text in _rows():
        if not text or plain_tokens(text, models) is None:
            continue
        for t in models:
            ids, start, end = t.encode(text)
            assert T.refined_ends(start, end, t.size[ids]).tolist() == np.cumsum(t.size[ids]).tolist()
            assert (np.diff(end) >= 0).all()


def test_a_character_of_several_tokens():
    # one token, then a four-byte character of three tokens that all carry its span, then one token
    start, end = np.array([0, 1, 1, 1, 5]), np.array([1, 5, 5, 5, 7])
    assert T.refined_ends(start, end, np.array([1, 1, 2, 1, 2])).tolist() == [1, 2, 4, 5, 7]
    # bytes fallen back to: empty spans, the last with the character
    start, end = np.array([0, 1, 1, 1, 5]), np.array([1, 1, 1, 5, 6])
    assert T.refined_ends(start, end, np.array([1, 2, 1, 1, 1])).tolist() == [1, 3, 4, 5, 6]


def test_groups_give_the_text_back(llm, models):
    rows = _rows()
    d = llm.createDataFrame(rows, "doc_id long, text string")
    seen = 0
    for r, (doc, text) in zip(T.token_groups(d.coalesce(1)).collect(), rows):
        assert r.doc_id == doc
        if not r.groups:
            assert not text or plain_tokens(text, models) is None
            continue
        seen += 1
        raw, at = (" " + text).encode(), 0
        for g in r.groups:
            for side, t in (("a", models[0]), ("b", models[1])):
                assert b"".join(t.bytes[i] for i in g[side]) == raw[at:g.end]
            at = g.end
        assert at == len(raw)
    assert seen > 100


def test_invalid_bytes_and_empty_table(llm):
    d = llm.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text UNION ALL SELECT 2L, 'ok'")
    got = sorted(tuple(r) for r in T.align_corpus(d).collect())
    assert got[0] == (1, 0, 0, 0, 0, 0, 0, "") and got[1][1] > 0
    assert T.align_corpus(d.limit(0)).count() == 0
    assert T.token_groups(d.limit(0)).count() == 0


def test_units():
    text = "aa bb  ccあ dd ee\n ff gg"
    assert T.units_of(text) == ["aa", "bb  ccあ", "dd", "ee\n ff", "gg"]
    assert " ".join(T.units_of(text)) == text and T.units_of("") == []
