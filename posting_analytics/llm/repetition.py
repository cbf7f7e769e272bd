"""Quality rules from repetition: characters inside duplicated n-grams and lines.

Words are runs of `[^\\x20\\x09-\\x0D]`.  Every word has a 64-bit hash, and one
prefix sum of them gives the Karp-Rabin hash of the window of any length at any
word, so all n-gram lengths come from one pass over a text.  A window of n + 1
words can only be found twice where both its windows of n words are, so each
length sorts the windows that the one before left.

Measures of a document (whole texts; the shares are of ``word_chars``):

* ``top_chars[n]``  characters in all occurrences of the n-gram that takes up the
  most, among those found twice or more; 0 if there is none
* ``dup_chars[n]``  characters inside windows of n words that stood in the text
  before; a character under several windows counts once
* ``n_dup_lines``, ``dup_line_chars``  lines with a word that equal an earlier
  line, and the characters of their words
* ``n_words, word_chars, n_symbols, n_repeat_words``  words, their code points,
  characters of `[#*$%&|<>]`, and words in 3-word windows found twice or more

``verdict`` compares them with limits: the published ones for web text by
default, all parameters.

Cases: a null text has no words, like an empty one, and fails the least number
of words; repeated rows and rows with a null doc_id are documents of their own;
texts of any length are measured whole, in about 20 bytes of memory a byte of
text; an empty table gives an empty result; extra columns are ignored by
``measure`` and carried along by ``kept_documents``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytetext as B
from .common import numbered, unused

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
_UNBASE = U(pow(int(_BASE), -1, 1 << 64))
_RUN_BYTES, _RUN_DOCS = 4 << 20, 1 << 16
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LONG = 256  # spans of more bytes are hashed one by one

#: Share of a document's characters that the n-gram taking up the most may fill.
TOP_SHARES: dict[int, float] = {2: 0.20, 3: 0.18, 4: 0.16}
#: Share of a document's characters that may lie inside repeated n-grams.
DUP_SHARES: dict[int, float] = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Share of a document's characters that may stand in repeated lines.
LINE_SHARE = 0.20

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "dup_line_chars", "n_repeat_words")
_STRUCT = pa.struct([*[(c, pa.int64()) for c in _COUNTS],
                     ("top_chars", pa.map_(pa.int32(), pa.int64())),
                     ("dup_chars", pa.map_(pa.int32(), pa.int64()))])
_STRUCT_SQL = ("struct<" + ", ".join(f"{c}: bigint" for c in _COUNTS)
               + ", top_chars: map<int, bigint>, dup_chars: map<int, bigint>>")


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans of any length."""
    long = np.flatnonzero(end - start > _LONG)
    if not len(long):
        return B.hash_spans(data, start, end)
    cut = end.copy()
    cut[long] = start[long]
    out = B.hash_spans(data, start, cut)
    for i in long.tolist():
        digest = hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


class Windows:
    """Karp-Rabin hashes of the word windows of a run of documents."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        n = len(hashes)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.left = first[1:][doc] - np.arange(n)  # words from here to the document's end
        self.doc = doc
        step = np.full(n, _UNBASE)
        if n:
            step[0] = 1
        self.sums = np.zeros(n + 1, U)  # hash i weighs _BASE ** -i
        np.cumsum(hashes * np.cumprod(step), out=self.sums[1:])
        step[1:] = _BASE
        self.power = np.cumprod(step)
        self.tag = B.mix(np.arange(len(first), dtype=U) + _BASE)  # windows of two documents are never equal

    def twice(self, n: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows of ``n`` words at ``at`` those found twice or more in their document.

        Their places grouped by window, where each group starts, and each group's first place.
        """
        at = at[self.left[at] >= n]
        key = B.mix((self.sums[at + n] - self.sums[at]) * self.power[at] + self.tag[self.doc[at]])
        order = np.argsort(key)
        key, at = key[order], at[order]
        same = np.zeros(len(at) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        again = same[1:] | same[:-1]
        begin = np.flatnonzero(~same[:-1][again])
        at = at[again]
        return at, begin, np.minimum.reduceat(at, begin) if len(at) else at


def _covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """The words inside windows of ``n`` words at ``starts``."""
    edge = np.zeros(n_words + 1, np.int32)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def _per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of a word's values by document."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _lines(data: np.ndarray, off: np.ndarray, w: B.Words, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of their document, and the characters of their words."""
    n_docs = len(off) - 1
    if not len(data):
        return np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([off[:-1], breaks + 1]))
    start = start[start < len(data)]
    doc = np.searchsorted(off, start, "right") - 1
    end = np.append(start[1:], len(data))
    end = end - (data[end - 1] == 10)
    a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    has = np.flatnonzero(b > a)
    start, end, doc, a, b = start[has], end[has], doc[has], a[has], b[has]
    key = B.mix(span_hashes(data, start, end) + B.mix(doc.astype(U) + _BASE))
    _, once = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[once] = False
    total = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(chars, out=total[1:])
    n_lines = np.bincount(doc[again], minlength=n_docs)
    line_chars = np.zeros(n_docs, np.int64)
    np.add.at(line_chars, doc[again], (total[b] - total[a])[again])
    return n_lines.astype(np.int64), line_chars


def measures(data: np.ndarray, off: np.ndarray, top: tuple[int, ...], dup: tuple[int, ...]) -> dict:
    """All measures of the documents ``data[off[i]:off[i + 1]]``."""
    data, off = data[off[0]:off[-1]], off - off[0]
    w = B.words(data, off, B.NOT_SPACE, lower=False, hashed=False)
    n, first, n_docs = len(w.start), w.first, len(off) - 1
    chars = np.zeros(0, np.int64)
    if n:
        ends = np.append(np.stack([w.start, w.end], 1).ravel(), len(data))
        lead = np.append((data & 0xC0) != 0x80, False)  # one more, so that the last end is inside
        chars = np.add.reduceat(lead, ends, dtype=np.int64)[:-1:2]
    symbols = np.flatnonzero(_SYMBOL[data])
    out = {"n_words": np.diff(first), "word_chars": _per_doc(chars, first),
           "n_symbols": np.diff(np.searchsorted(symbols, off))}
    out["n_dup_lines"], out["dup_line_chars"] = _lines(data, off, w, chars)
    win = Windows(span_hashes(data, w.start, w.end), first)
    total = np.zeros(n + 1, np.int64)
    np.cumsum(chars, out=total[1:])
    out["top"], out["dup"] = {}, {}
    at, seen = np.arange(n), 1
    for size in sorted({3, *top, *dup}):
        while seen < size:  # lengths between are only passed through
            seen += 1
            at, begin, head = win.twice(seen, at)
            inside = np.zeros(n + 1, bool)
            inside[at] = True
            at_next = np.flatnonzero(inside[:-1] & inside[1:])
            if seen < size:
                at = at_next
        if size == 3:
            out["n_repeat_words"] = _per_doc(_covered(at, 3, n), first)
        if size in top:
            most = np.zeros(n_docs, np.int64)
            if len(at):
                count = np.diff(np.append(begin, len(at)))
                np.maximum.at(most, win.doc[head], count * (total[head + size] - total[head]))
            out["top"][size] = most
        if size in dup:
            inside[head] = False
            out["dup"][size] = _per_doc(np.where(_covered(np.flatnonzero(inside), size, n), chars, 0), first)
        at = at_next
    return out


def _maps(parts: dict[int, np.ndarray], n_docs: int) -> pa.Array:
    sizes = sorted(parts)
    keys = np.tile(np.array(sizes, np.int32), n_docs)
    values = np.stack([parts[s] for s in sizes], 1).ravel() if sizes else np.zeros(0, np.int64)
    off = pa.array(np.arange(n_docs + 1) * len(sizes), pa.int32())
    return pa.MapArray.from_arrays(off, pa.array(keys, pa.int32()), pa.array(values, pa.int64()))


def _measure(text: str, top: tuple[int, ...], dup: tuple[int, ...], name: str, drop_text: bool):
    """Batches with the measures as a last column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(text)
            data, off = B.string_buffers(col)
            for a, b in B.slices(data, off, _RUN_BYTES, _RUN_DOCS):
                m = measures(data, off[a:b + 1], top, dup)
                struct = pa.StructArray.from_arrays(
                    [*[pa.array(m[c], pa.int64()) for c in _COUNTS],
                     _maps(m["top"], b - a), _maps(m["dup"], b - a)], fields=list(_STRUCT))
                rest = batch.slice(a, b - a)
                own = [x for x in rest.schema.names if not (drop_text and x == text)]
                yield pa.RecordBatch.from_arrays([*[rest.column(x) for x in own], struct], [*own, name])
    return run


def _sized(top: Mapping[int, float], dup: Mapping[int, float]) -> tuple[tuple[int, ...], tuple[int, ...]]:
    sizes = tuple(sorted(top)), tuple(sorted(dup))
    if min(2, *sizes[0], *sizes[1]) < 2:
        raise ValueError("n-grams have two words or more")
    return sizes


def measure(docs: DataFrame, *, top: Mapping[int, float] = TOP_SHARES,
            dup: Mapping[int, float] = DUP_SHARES) -> DataFrame:
    """``doc_id, m``: the measures of every document as a struct (see the module's head)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_measure("text", *_sized(top, dup), "m", True), f"doc_id long, m {_STRUCT_SQL}")


def failed_rules(m: Column, *, top: Mapping[int, float] = TOP_SHARES, dup: Mapping[int, float] = DUP_SHARES,
                 line_share: float = LINE_SHARE, min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    """The names of the rules that a document's measures ``m`` break, in a fixed order."""
    chars = m["word_chars"]
    rules = [("min_words", m["n_words"] < min_words),
             ("repeat_words", 100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"]),
             ("dup_lines", m["dup_line_chars"] > line_share * chars),
             *[(f"top_{n}gram", m["top_chars"][n] > share * chars) for n, share in sorted(top.items())],
             *[(f"dup_{n}gram", m["dup_chars"][n] > share * chars) for n, share in sorted(dup.items())]]
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]))


def verdicts(docs: DataFrame, **limits) -> DataFrame:
    """Every document's measures and the rules it breaks.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, dup_line_chars,
    n_repeat_words, top_chars, dup_chars, failed, kept``; ``limits`` are the
    parameters of ``failed_rules``.
    """
    lengths = {k: v for k, v in limits.items() if k in ("top", "dup")}
    out = measure(docs, **lengths).withColumn("failed", failed_rules(F.col("m"), **limits))
    return out.select("doc_id", "m.*", "failed", (F.size("failed") == 0).alias("kept"))


def kept_documents(docs: DataFrame, **limits) -> DataFrame:
    """The documents that break no rule, with all their columns."""
    lengths = {k: v for k, v in limits.items() if k in ("top", "dup")}
    m = unused(docs, "repetition")
    rows, top_dup = numbered(docs), _sized(lengths.get("top", TOP_SHARES), lengths.get("dup", DUP_SHARES))
    schema = rows.select("*", F.lit(None).cast(_STRUCT_SQL).alias("m")).schema
    text = rows.columns[docs.columns.index("text")]
    out = rows.mapInArrow(_measure(text, *top_dup, "m", False), schema).toDF(*docs.columns, m)
    return out.filter(F.size(failed_rules(F.col(m), **limits)) == 0).drop(m)
