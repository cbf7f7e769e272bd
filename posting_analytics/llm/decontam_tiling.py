"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed of ``min_match`` words are
compared by running Karp-Rabin matching with greedy string tiling: common runs
of words are found from the shared seed hashes, extended word by word, and the
longest ones are marked first; marked words take part in no later match, and
rounds go on with shorter runs down to ``min_match``.  A document is
contaminated when the tiles cover at least ``coverage`` of an item's words, in
whatever order the passages stand.

Where a text and an item repeat words so often that their equal places are many
more than their words, runs are found by Karp-Rabin passes over the unmarked words
for falling lengths instead of from the list of places: the same tiles in memory
that grows with the words.

Items shorter than ``min_match`` words match as one run of all their words.
Benchmark seeds travel as broadcasts of at most ``BLOCK_SEEDS`` seeds (a bounded
size); a larger benchmark takes further passes over the documents.

Cases: a null or empty text has no words and no match; a null or empty item
matches nothing; repeated items are compared once each; repeated documents are
documents of their own; an empty benchmark leaves every document clean; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as B
from .common import numbered, unused

MIN_MATCH, COVERAGE = 5, 0.5
#: Seeds of one broadcast: about 40 bytes each, 80 MB.
BLOCK_SEEDS = 2_000_000
#: Equal places of a text and an item that are listed, for each of their words; beyond, passes are made.
PLACES_PER_WORD = 16


class Block:
    """Word hashes of some items and the sorted index of their seeds."""

    def __init__(self, items: list[tuple[int, np.ndarray]], min_match: int):
        self.ids = np.array([i for i, _ in items], np.int64)
        self.words = [w for _, w in items]
        seeds, owner, place = [], [], []
        for n, w in enumerate(self.words):
            h, _ = B.shingles(w, np.array([0, len(w)]), min(min_match, len(w)))
            seeds.append(h)
            owner.append(np.full(len(h), n))
            place.append(np.arange(len(h)))
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        seed, owner, place = cat(seeds, B.U), cat(owner, np.int64), cat(place, np.int64)
        order = np.argsort(seed, kind="stable")
        seed, owner, self.place = seed[order], owner[order], place[order]
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (owner[1:] != owner[:-1])
        #: one entry per seed of an item: the seed, the item, its first place and the end of its places
        first = np.flatnonzero(new)
        self.seed, self.owner, self.first = seed[first], owner[first], first
        self.end = np.append(first[1:], len(seed)).astype(np.int64)
        #: lengths below min_match, whose items are one window of all words
        self.short = sorted({len(w) for w in self.words if 0 < len(w) < min_match})


def tiles(doc: np.ndarray, item: np.ndarray, d_at: np.ndarray, i_at: np.ndarray,
          size: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(document start, item start, length)``, longest first.

    ``d_at[k], i_at[k]`` are all the places of equal seeds of ``size`` words.  Seeds on
    one diagonal that follow each other form one maximal run; runs are taken by
    falling length, and a run that has lost words to a longer tile is cut into
    its unmarked pieces, which wait for their own turn.
    """
    diagonal = d_at - i_at
    order = np.lexsort((d_at, diagonal))
    d, g = d_at[order], diagonal[order]
    breaks = np.flatnonzero((np.diff(g) != 0) | (np.diff(d) != 1)) + 1
    starts = np.concatenate([[0], breaks])
    ends = np.concatenate([breaks, [len(d)]]) - 1
    runs: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(d[starts].tolist(), zip((d[starts] - g[starts]).tolist(), (d[ends] - d[starts] + size).tolist())):
        runs.setdefault(b[1], []).append((a, b[0]))
    used_d, used_i = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    out = []
    while runs:
        length = max(runs)
        for a, b in sorted(runs.pop(length)):
            taken = used_d[a:a + length] | used_i[b:b + length]
            if not taken.any():
                out.append((a, b, length))
                used_d[a:a + length] = used_i[b:b + length] = True
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[1], taken.astype(np.int8), [1]])))
            for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if y - x >= size:  # shorter than the run that was cut: a later round
                    runs.setdefault(y - x, []).append((a + x, b + x))
        if used_i.all():
            break
    return out


class _Rolling:
    """Hashes of the windows of any length of a sequence of words, from one prefix sum."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, words: np.ndarray):
        n = len(words)
        power = np.ones(n + 1, B.U)
        power[1:] = self.BASE
        power = np.cumprod(power)
        self.sum = np.zeros(n + 1, B.U)
        np.cumsum(words * power[:n], out=self.sum[1:])
        self.back = np.full(n + 1, pow(self.BASE, -1, 1 << 64), B.U)
        self.back[0] = 1
        self.back = np.cumprod(self.back)

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sum) - size
        return (self.sum[size:] - self.sum[:n]) * self.back[:n]


def passed_tiles(doc: np.ndarray, item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """The tiles of ``tiles`` without a list of equal places.

    Each round finds the longest run of unmarked words that both sides hold, by halving
    the length, and marks such runs in order of their places.  Marked words become 0 in the
    text and 1 in the item, so that no run with one is equal; runs are compared word by word.
    """
    doc, item = doc.astype(B.U, copy=True), item.astype(B.U, copy=True)
    out, most = [], min(len(doc), len(item))
    while most >= size:
        in_doc, in_item = _Rolling(doc), _Rolling(item)
        low, high = size - 1, most
        while low < high:
            middle = (low + high + 1) // 2
            if np.isin(in_item.windows(middle), in_doc.windows(middle)).any():
                low = middle
            else:
                high = middle - 1
        most = low
        if most < size:
            break
        h_doc, h_item = in_doc.windows(most), in_item.windows(most)
        free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
        starts: dict[int, deque[int]] = {}
        for b in np.flatnonzero(np.isin(h_item, h_doc)).tolist():
            starts.setdefault(int(h_item[b]), deque()).append(b)
        next_free = 0
        for a in np.flatnonzero(np.isin(h_doc, h_item)).tolist():
            if a < next_free:
                continue
            places = starts[int(h_doc[a])]
            # the runs marked in this round are all as long, so a run that lost words lost an end
            while places and not (free_i[places[0]] and free_i[places[0] + most - 1]):
                places.popleft()
            for b in places:
                if free_i[b] and free_i[b + most - 1] and np.array_equal(doc[a:a + most], item[b:b + most]):
                    out.append((a, b, most))
                    free_d[a:a + most] = free_i[b:b + most] = False
                    next_free = a + most
                    break
        if free_i.all():  # only equal hashes of unequal runs
            most -= 1
        doc[~free_d], item[~free_i] = 0, 1
    return out


def _lookup(block: Block, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(window, entry)`` pairs of equal seeds, an entry for each item that holds the seed."""
    lo = np.searchsorted(block.seed, hashes)
    lo_ok = np.minimum(lo, max(len(block.seed) - 1, 0))
    hit = np.flatnonzero((lo < len(block.seed)) & (block.seed[lo_ok] == hashes)) if len(block.seed) \
        else np.zeros(0, np.int64)
    n = np.searchsorted(block.seed, hashes[hit], "right") - lo[hit]
    window = np.repeat(hit, n)
    step = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
    return window, np.repeat(lo[hit], n) + step


def _pair_tiles(block: Block, doc: np.ndarray, item: np.ndarray, d_at: np.ndarray, entry: np.ndarray,
                size: int) -> list[tuple[int, int, int]]:
    """The tiles of one text and one item whose equal seeds are the entries at ``d_at``."""
    n = block.end[entry] - block.first[entry]
    if int(n.sum()) > PLACES_PER_WORD * (len(doc) + len(item)):
        return passed_tiles(doc, item, size)
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return tiles(doc, item, np.repeat(d_at, n), block.place[np.repeat(block.first[entry], n) + step], size)


#: Columns that a pass adds to every row.
_STATE = (("_tiling_items", "long"), ("_tiling_item", "long"), ("_tiling_covered", "long"),
          ("_tiling_words", "long"), ("_tiling_longest", "long"))


def _hits(block: Block, w: B.Words, min_match: int, coverage: float) -> dict[int, list[tuple]]:
    """Per document of a run: ``(item, covered, item words, longest)`` of contaminating items."""
    sizes = np.array([len(x) for x in block.words])
    found, n_docs = [], len(w.first) - 1
    for k in [min_match, *block.short]:
        h, doc = B.shingles(w.hash, w.first, k, short=False)
        window, entry = _lookup(block, h)
        size = sizes[block.owner[entry]]
        fits = (size == k) if k < min_match else (size >= min_match)
        window, entry = window[fits], entry[fits]
        if len(window):
            base = np.searchsorted(doc, np.arange(n_docs))  # a document's windows are in order
            found.append((doc[window], block.owner[entry], window - base[doc[window]],
                          entry, np.full(len(window), k)))
    hits: dict[int, list[tuple]] = {}
    if not found:
        return hits
    doc, own, d_at, entry, k = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((own, doc))
    doc, own, d_at, entry, k = (x[order] for x in (doc, own, d_at, entry, k))
    cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(own) != 0)) + 1
    cuts = np.concatenate([[0], cuts, [len(doc)]]).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        d, o, item = int(doc[a]), int(own[a]), block.words[own[a]]
        # the item's windows that occur at all bound what tiles can cover
        seen = np.unique(entry[a:b])
        if int((block.end[seen] - block.first[seen]).sum()) * k[a] < coverage * len(item):
            continue
        t = _pair_tiles(block, w.hash[w.first[d]:w.first[d + 1]], item, d_at[a:b], entry[a:b], int(k[a]))
        covered = sum(x[2] for x in t)
        if covered >= coverage * len(item):
            hits.setdefault(d, []).append((int(block.ids[o]), covered, len(item), max(x[2] for x in t)))
    return hits


def _judge(block_b, text_at: int, n_columns: int, min_match: int, coverage: float):
    """A pass over the rows: each keeps its columns; the state columns take in this block's hits."""
    def run(batches):
        block: Block = block_b.value
        for batch in batches:
            data, off = B.string_buffers(batch.column(text_at))
            state = [batch.column(n_columns + i).to_numpy(zero_copy_only=False).copy()
                     for i in range(len(_STATE))]
            for lo, hi in B.slices(data, off, 4 << 20, 1 << 14):
                w = B.words(data, off[lo:hi + 1], B.ALNUM)
                for d, hits in _hits(block, w, min_match, coverage).items():
                    r = lo + d
                    best = (state[2][r], state[3][r], state[1][r], state[4][r])
                    for item, covered, size, longest in hits:
                        ahead = covered * best[1] - best[0] * size  # compares covered shares
                        if ahead > 0 or (ahead == 0 and item < best[2]) or not best[0]:
                            best = (covered, size, item, longest)
                    state[0][r] += len(hits)
                    state[2][r], state[3][r], state[1][r], state[4][r] = best
            columns = [batch.column(i) for i in range(n_columns)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(x, pa.int64()) for x in state],
                                             names=batch.schema.names)
    return run


def _blocks(benchmark: DataFrame, min_match: int, most: int):
    """Blocks of whole items of at most ``most`` seeds (one longer item is a block)."""
    items, seeds = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter(
        "item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        w = B.hash_words(r["text"], B.ALNUM)
        if not len(w):
            continue
        if items and seeds + len(w) > most:
            yield Block(items, min_match)
            items, seeds = [], 0
        items.append((r["item_id"], w))
        seeds += len(w)
    if items:
        yield Block(items, min_match)


def judged(docs: DataFrame, benchmark: DataFrame, *, min_match: int = MIN_MATCH,
           coverage: float = COVERAGE, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """The rows of ``docs`` with the state columns of all blocks behind them; no shuffle, no join.

    The columns are called as in ``_STATE``, with underscores before a name that ``docs`` has."""
    sc, n = docs.sparkSession.sparkContext, len(docs.columns)
    out = docs.withColumns({unused(docs, name): F.lit(int(name == "_tiling_words")).cast(kind)
                            for name, kind in _STATE})
    names, out, at = out.columns, numbered(out), docs.columns.index("text")
    schema = out.schema
    for block in _blocks(benchmark, min_match, block_seeds):
        out = out.mapInArrow(_judge(sc.broadcast(block), at, n, min_match, coverage), schema)
    return out.toDF(*names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, contaminated, n_items, item_id, coverage, longest_tile`` per document.

    ``item_id`` is the item of highest coverage (the smaller id of equals).
    """
    rows = judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.col("text").cast("string").alias("text")), benchmark, **options)
    hit = F.col("_tiling_items") > 0
    return rows.select(
        "doc_id", hit.alias("contaminated"), F.col("_tiling_items").alias("n_items"),
        F.when(hit, F.col("_tiling_item")).alias("item_id"),
        (F.col("_tiling_covered") / F.col("_tiling_words")).alias("coverage"),
        F.col("_tiling_longest").alias("longest_tile"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns (of any name), that no benchmark item contaminates."""
    items, *_ = names = [unused(docs, name) for name, _ in _STATE]
    return judged(docs, benchmark, **options).filter(F.col(items) == 0).drop(*names)
