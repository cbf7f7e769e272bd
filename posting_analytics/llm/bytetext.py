"""Vectorised words and hashes over the bytes of Arrow string columns.

Workers read texts straight from Arrow buffers: a slice of documents is one
byte array with document offsets, words are start and end positions in it, and
every word gets a 64-bit hash.  No Python string is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_C1, _C2, _C3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=U)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of a word for `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False

#: Bytes of a word for `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, a-z, all above ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * _C2
    x = (x ^ (x >> U(27))) * _C3
    return x ^ (x >> U(31))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    if bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def slices(data: np.ndarray, off: np.ndarray, most_bytes: int,
           most_docs: int) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``most_bytes`` (one longer text is a run)."""
    n, at = len(off) - 1, 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + most_bytes, "right")) - 1
        end = min(max(end, at + 1), at + most_docs, n)
        yield at, end
        at = end


@dataclass
class Words:
    """Words of a run of documents: byte spans, hashes, and the first word of each document."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # n_docs + 1 offsets into the words

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def words(data: np.ndarray, off: np.ndarray, kind: np.ndarray, lower: bool = True,
          hashed: bool = True) -> Words:
    """Words of the documents ``data[off[i]:off[i+1]]``, runs of bytes in ``kind``."""
    data = data[off[0]:off[-1]]
    off = off - off[0]
    if lower:
        data = LOWER[data]
    inside = kind[data]
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, np.zeros(0, U), np.zeros(len(off), np.int64))
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = off[(off > 0) & (off < n)]  # a word never runs over a document's end
    begin[cuts] = inside[cuts]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    finish[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    first = np.searchsorted(start, off)
    return Words(start, end, hash_spans(data, start, end) if hashed else np.zeros(0, U), first)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step."""
    size = end - start
    h = size.astype(U) * _C1
    if not len(start):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    left, at, which = size, start, None
    while True:
        w = eight[at] & _KEEP[np.minimum(left, 8)]
        if which is None:
            h = mix((h ^ w) + _C1)
        else:
            h[which] = mix((h[which] ^ w) + _C1)
        go = np.flatnonzero(left > 8)
        if not len(go):
            return h
        which = go if which is None else which[go]
        left, at = left[go] - 8, at[go] + 8


def hash_words(text: str | bytes, kind: np.ndarray = NOT_SPACE, lower: bool = True) -> np.ndarray:
    """Hashes of the words of one text."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    data = np.frombuffer(raw, np.uint8)
    return words(data, np.array([0, len(data)]), kind, lower).hash


def shingles(hashes: np.ndarray, first: np.ndarray, k: int,
             short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows of each document, and each window's document.

    With ``short`` a document of 1 to k-1 words gives one window of all its
    words; a document without words gives none.
    """
    n = len(hashes)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    if n >= k:
        h = np.full(n - k + 1, (k * int(_C1)) & 0xFFFFFFFFFFFFFFFF, dtype=U)
        for j in range(k):
            h = mix((h ^ hashes[j:n - k + 1 + j]) + _C1)
        keep = np.flatnonzero(doc[:n - k + 1] == doc[k - 1:])
        h, of = h[keep], doc[keep]
    else:
        h, of = np.zeros(0, U), np.zeros(0, np.int64)
    if short:
        few = np.flatnonzero((count > 0) & (count < k))
        if len(few):
            g = count[few].astype(U) * _C2
            for j in range(k - 1):
                has = np.flatnonzero(count[few] > j)
                g[has] = mix((g[has] ^ hashes[first[few[has]] + j]) + _C1)
            h, of = np.concatenate([h, g]), np.concatenate([of, few])
    return h, of
