import random

from posting_analytics.llm import license_index as L

from .conftest import ascii_lower


def words(text):
    out, word = [], ""
    for c in ascii_lower(text or ""):
        if c.isascii() and not ("0" <= c <= "9" or "a" <= c <= "z"):
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out


def brute_base(text):
    w, found = words(text), []
    for phrase, label in L.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    places = [i for i, _ in found]
    return (len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found})))


def brute_labels(text):
    """Every notice whose mandatory phrases stand at their places."""
    w, labels = words(text), set(filter(None, brute_base(text)[4].split(",")))
    for label, notice, phrases in L.NOTICES:
        n = words(notice)
        must = {}
        for phrase in phrases:
            p = words(phrase)
            at = next(i for i in range(len(n)) if n[i:i + len(p)] == p)
            must.update({at + j: x for j, x in enumerate(p)})
        lo, hi = min(must), max(must)
        if any(all(w[s + j] == x for j, x in must.items()) for s in range(-lo, len(w) - hi)):
            labels.add(label)
    return ",".join(sorted(labels))


def test_against_plain_search(docs_of):
    rng = random.Random(6)
    notices = [n for _, n, _ in L.NOTICES] + [p for p, _ in L.BASE]
    filler = "the license mit apache public general version 2 3 of gnu is granted cc by é ü".split()
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                parts.append(rng.choice(notices))
            elif kind < 0.6:
                n = rng.choice(notices).split()
                parts.append(" ".join(n[rng.randint(0, 3):len(n) - rng.randint(0, 3)]))
            else:
                parts.append(" ".join(rng.choices(filler, k=rng.randint(1, 30))))
        text = rng.choice([" ", "\n", " - ", ", "]).join(parts)
        rows.append((i, text.upper() if rng.random() < 0.2 else text.replace(" ", rng.choice([" ", "  ", ".\n"]))))
    rows += [(900, None), (901, ""), (902, "mit"), (903, "MIT License"), (904, "license mit license mit license"),
             (905, "mit licensé mit license"), (906, "a " * 50_000 + "Apache License, Version 2.0"),
             (907, "mıt license MİT license")]
    got = {r["doc_id"]: r for r in L.scan_licenses(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t), t
        assert r["labels"] == brute_labels(t), t
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_a_phrase_never_spans_two_files(docs_of):
    got = L.scan_licenses(docs_of([(1, "the mit"), (2, "license"), (3, "general public"), (4, "license mit")])).collect()
    assert all(r["n_base"] == 0 and r["labels"] == "" for r in got)


def test_own_labels(docs_of):
    text = "Licensed under CC BY-NC 4.0."
    got = L.scan_licenses(docs_of([(1, text), (1, text)])).collect()
    assert [r["labels"] for r in got] == ["cc-by-nc-4.0"] * 2 and all(r["score"] == 1.0 and r["n_base"] == 0 for r in got)
    gpl = L.scan_licenses(docs_of([(1, "licensed under the GNU General Public License, version 3.")])).first()
    assert gpl["labels"] == "gpl,gpl-3.0" and gpl["base_labels"] == "gpl"


def test_empty_table(docs_of):
    assert L.scan_licenses(docs_of([])).collect() == []
