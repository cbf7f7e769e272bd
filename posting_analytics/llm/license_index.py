"""License scans with a positional rare-token index.

Templates are short licence notices.  Every template word gets an inverse
document frequency over the templates, and the index keeps, per word, its
postings ``(template, position)``.  For a file, its licence words of highest
IDF are looked up; each occurrence and posting give the place at which the
template would start, postings are intersected by that relative position, and a
template counts where enough of its rare words agree and every mandatory key
phrase stands at its place.  Base phrases are templates whose whole text is
mandatory, so the same lookup finds every place where they stand.

Cases: a null or empty text has no words and no label; a text of any length is
scanned whole; repeated rows are files of their own; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as B

#: Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"),
        ("general public license", "gpl"))

#: Notices: label, text, mandatory key phrases.  Common public wordings.
NOTICES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files",
     ("permission is hereby granted", "free of charge")),
    ("apache-2.0", "licensed under the apache license version 2 0",
     ("apache license", "version 2 0")),
    ("gpl-3.0", "licensed under the gnu general public license version 3",
     ("general public license", "version 3")),
    ("gpl-2.0", "licensed under the gnu general public license version 2",
     ("general public license", "version 2")),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms "
            "of the gnu general public license", ("free software", "general public license")),
    ("lgpl", "licensed under the gnu lesser general public license",
     ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license",
     ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms", "conditions are met")),
    ("bsd", "licensed under the bsd license", ("bsd license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted", ("permission to use copy modify", "hereby granted")),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("unencumbered software", "public domain")),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    ("cc0", "licensed under cc0 1 0 universal", ("cc0 1 0",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution",)),
)


@dataclass
class Template:
    label: str
    words: np.ndarray
    mandatory: np.ndarray  # positions that must agree
    base: bool
    rare: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # anchor positions


@dataclass
class Index:
    """Sorted word hashes with their postings; ``idf`` per word."""

    vocabulary: np.ndarray
    idf: np.ndarray
    templates: list[Template]
    #: per template and anchor position: (vocabulary id, template, position)
    postings: dict[int, list[tuple[int, int]]]


def _mandatory(words: list[int], phrases: tuple[str, ...]) -> np.ndarray:
    found: set[int] = set()
    for phrase in phrases:
        p = B.hash_words(phrase, B.ALNUM).tolist()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        if not at:
            raise ValueError(f"key phrase {phrase!r} is not in its notice")
        found.update(range(at[0], at[0] + len(p)))
    return np.array(sorted(found), np.int64)


def build_index(base=BASE, notices=NOTICES, anchors: int = 3) -> Index:
    """Index the templates; each is anchored at its ``anchors`` words of highest IDF."""
    templates = []
    for phrase, label in base:
        w = B.hash_words(phrase, B.ALNUM)
        templates.append(Template(label, w, np.arange(len(w)), True))
    for label, text, phrases in notices:
        w = B.hash_words(text, B.ALNUM)
        templates.append(Template(label, w, _mandatory(w.tolist(), phrases), False))
    vocabulary = np.unique(np.concatenate([t.words for t in templates]))
    df = np.zeros(len(vocabulary))
    for t in templates:
        df[np.searchsorted(vocabulary, np.unique(t.words))] += 1
    idf = np.log(len(templates) / df)
    postings: dict[int, list[tuple[int, int]]] = {}
    for i, t in enumerate(templates):
        ids = np.searchsorted(vocabulary, t.words)
        # Only mandatory words may anchor, so no match of a template is missed.
        order = t.mandatory[np.argsort(-idf[ids[t.mandatory]], kind="stable")]
        t.rare = np.sort(order[:min(anchors, len(order))] if not t.base else order)
        for p in t.rare.tolist():
            postings.setdefault(int(ids[p]), []).append((i, p))
    return Index(vocabulary, idf, templates, postings)


def scan(index: Index, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matches in a run of files: arrays ``template, word position in the run, share matched``."""
    at = np.searchsorted(index.vocabulary, hashes)
    at[at == len(index.vocabulary)] = 0
    known = np.flatnonzero(index.vocabulary[at] == hashes)
    ids = np.full(len(hashes), -1, np.int32)
    ids[known] = at[known]
    if not len(known):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    occurrences = ids[known]
    order = np.argsort(occurrences, kind="stable")
    by_word, places = occurrences[order], known[order]
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out_t, out_p, out_s = [], [], []
    starts: dict[int, list[np.ndarray]] = {}
    for word, post in index.postings.items():
        a, b = np.searchsorted(by_word, [word, word + 1])
        for template, position in post:
            starts.setdefault(template, []).append(places[a:b] - position)
    for template, found in starts.items():
        t = index.templates[template]
        # Intersect the postings of the rare words by relative position.
        place, votes = np.unique(np.concatenate(found), return_counts=True)
        place = place[votes >= len(t.rare)]
        # The mandatory span must lie inside one file.
        lo, hi = int(t.mandatory[0]), int(t.mandatory[-1])
        place = place[(place + lo >= 0) & (place + hi < len(hashes))]
        place = place[doc[place + lo] == doc[place + hi]] if len(place) else place
        for p in t.mandatory.tolist():
            place = place[hashes[place + p] == t.words[p]]
        if not len(place):
            continue
        home, agree = doc[place + lo], np.zeros(len(place))
        for p in range(len(t.words)):
            j = place + p
            ok = (j >= 0) & (j < len(hashes))
            jj = np.where(ok, j, 0)
            agree += ok & (hashes[jj] == t.words[p]) & (doc[jj] == home)
        out_t.append(np.full(len(place), template))
        out_p.append(place + lo)
        out_s.append(agree / len(t.words))
    if not out_t:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    return np.concatenate(out_t), np.concatenate(out_p), np.concatenate(out_s)


_RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
           "base_labels string, labels string, score double, "
           "matches array<struct<label:string,word:long,share:double>>")


def _scan_batches(batches):
    index = build_index()
    is_base = np.array([t.base for t in index.templates])
    label = np.array([t.label for t in index.templates], dtype=object)
    match = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("share", pa.float64())]))
    for batch in batches:
        data, off = B.string_buffers(batch.column(1))
        for lo, hi in B.slices(data, off, 4 << 20, 1 << 14):
            w = B.words(data, off[lo:hi + 1], B.ALNUM)
            t, place, share = scan(index, w.hash, w.first)
            n = hi - lo
            doc = np.searchsorted(w.first, place, "right") - 1
            word = place - w.first[doc] if len(place) else place
            base = is_base[t] if len(t) else np.zeros(0, bool)
            n_base = np.bincount(doc[base], minlength=n) if len(t) else np.zeros(n, np.int64)
            per: dict[int, list[tuple[str, int, float, bool]]] = {}
            for i in np.lexsort((t, word, doc)).tolist() if len(t) else []:
                per.setdefault(int(doc[i]), []).append(
                    (label[t[i]], int(word[i]), float(share[i]), bool(base[i])))
            rows = [per.get(i, ()) for i in range(n)]
            b = [[m for m in r if m[3]] for r in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, n).cast(pa.int64()), pa.array(w.count, pa.int64()),
                pa.array(n_base, pa.int64()),
                pa.array([r[0][1] if r else None for r in b], pa.int64()),
                pa.array([r[-1][1] if r else None for r in b], pa.int64()),
                pa.array([",".join(sorted({m[0] for m in r})) for r in b], pa.string()),
                pa.array([",".join(sorted({m[0] for m in r})) for r in rows], pa.string()),
                pa.array([max((m[2] for m in r), default=0.0) for r in rows], pa.float64()),
                pa.array([[{"label": m[0], "word": m[1], "share": m[2]} for m in r] for r in rows], match),
            ], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                "score", "matches"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: words, base places, labels, the best matched share, all matches."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_scan_batches, _RESULT)
