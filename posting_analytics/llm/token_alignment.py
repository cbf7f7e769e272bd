"""Cross-tokenizer alignment: where the tokens of two tokenizers end together.

``A`` is a byte-level tokenizer of the `tokenizers` library, which reads a space
and the text; ``B`` a `sentencepiece` model, which puts that space in itself.
Each library says where its tokens lie: `tokenizers` in characters,
`sentencepiece` in bytes (the spans of its proto; the installed release gives
them as the offset mapping, its immutable proto is gone).  These spans are the
coarse cuts.  Tokens that share one character - a character of several bytes cut
into several tokens, bytes a model falls back to - all carry the whole
character's span, and are cut by their decoded bytes.  Where spans and bytes
differ (a normaliser has changed the text), bytes decide; where the decoded
bytes are not the space and the text, a document has no tokens.

Byte offsets where a token of both ends cut a document into groups.  A link is
an A token and a B token that end together.

A text is read in units, cut at each single space between two other characters.
Neither tokenizer joins anything across such a space: the words of A's splitting
pattern begin with it, and no piece of B holds a space behind another character,
which is checked when the model is read (else a text is one unit).  So both
tokenizers end there, a unit's tokens and groups are the same wherever it
stands, and a task tokenises it once for as long as it remembers it.

Pairs of ids are counted over the corpus: a run of documents is written to the
shared folder with its sequence of units, each unit's links as numbers in the
run's own list of distinct pairs, and the pairs' counts; the lists are summed
and the sums joined back.

Cases: a null or empty text, and one that is not valid UTF-8, has no tokens;
repeated rows and rows with a null doc_id are documents of their own; texts of
any length are aligned whole; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import bytetext as B
from .collocations import pack, unpack
from .common import written

#: Public tokenizer files; every worker reads them.
A_PATH, B_PATH = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"

_RUN_BYTES, _RUN_DOCS = 4 << 20, 1 << 14
_BATCH_CHARS = 1 << 17  # units given to the tokenizers at once
REMEMBERED = 1 << 18  # units of a task; beyond that it keeps those seen most before the next run
_SPACE = re.compile(r"(?<=\S) (?=\S)")

_RELATION = ("run long, ids array<long>, n_a binary, n_b binary, n_links binary, digest array<string>, "
             "n_units binary, units binary, n_unit_links binary, links binary, a binary, b binary, n binary")
_PAIRS = "run long, at int, a int, b int, n long"
_DIGEST = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def byte_of_char() -> dict[str, int]:
    """The bytes that the characters of byte-level tokens stand for: printable ones
    themselves, the others the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(other)}


class ByteLevel:
    """A byte-level tokenizer, its tokens' bytes, and character spans as coarse byte ends."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        special = self.model.get_added_tokens_decoder()
        byte = byte_of_char()
        self.bytes = [b""] * (max(self.model.get_vocab().values()) + 1)
        for token, i in self.model.get_vocab().items():
            known = i not in special and all(c in byte for c in token)
            self.bytes[i] = bytes(byte[c] for c in token) if known else token.encode()
        self.size = np.array([len(x) for x in self.bytes])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, coarse starts and coarse ends of the tokens of a space and the text, in bytes."""
        text = f" {text}"
        found = self.model.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        if not text.isascii():
            raw = np.frombuffer(text.encode(), np.uint8)
            spans = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))[spans]
        return ids, spans[:, 0], spans[:, 1]


class Pieces:
    """A sentencepiece model, its pieces' bytes, and its byte spans as coarse byte ends."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.size = np.array([len(x) for x in self.bytes])
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = self.model.encode(text, return_type="offset_mapping", return_bytes=True)
        ids = np.array(found["ids"], np.int64)
        spans = np.fromiter(chain.from_iterable(found["offsets"]), np.int64, 2 * len(ids)).reshape(-1, 2) + 1
        spans[:1, 0] = 0  # the space put in
        return ids, spans[:, 0], spans[:, 1]


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> ByteLevel | Pieces:
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


def refined_ends(start: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ends of tokens with coarse spans ``start`` to ``end`` and ``size`` decoded bytes.

    A token's coarse end holds if it is beyond that of the token before and the
    next token does not start before it; tokens between such ends share
    characters and are cut by their decoded bytes.
    """
    n = len(end)
    sure = np.ones(n, bool)
    sure[:-1] = start[1:] >= end[:-1]
    sure[1:] &= end[1:] > end[:-1]
    total = np.cumsum(size)
    at = np.where(sure, np.arange(n), -1)
    last = np.maximum.accumulate(at) if n else at
    base = np.where(last >= 0, end[last] - total[last], 0)
    return base + total


def units_of(text: str) -> list[str]:
    """The text without the single spaces it is cut at."""
    return _SPACE.split(text) if text else []


@lru_cache(maxsize=2)
def _spelled(n_a: int, n_b: int) -> list[bytes]:
    """Ids with what follows them: in a group, at the end of A's part, at the end of a group."""
    return [b"%d%s" % (i, sep) for n, seps in ((n_a, (b",", b"|")), (n_b, (b",", b";"))) for i in range(n)
            for sep in seps]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of the ranges of ``size`` from ``start``, one range behind the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Units:
    """Units that a task has tokenised: their tokens, groups and links.

    ``groups[u]`` is a unit's groups as text, ``a1,a2|b1;a3|b2,b3``, and
    ``bad[u]`` says that its tokens do not give its bytes back.
    """

    def __init__(self, a: ByteLevel, b: Pieces):
        self.models, self.size = (a, b), (len(a.size), len(b.size))
        self.clear()

    def clear(self) -> None:
        self._number([])
        self.groups: list[bytes] = []
        none = np.zeros(0, np.int32)
        self.bad, self.n_a, self.n_b, self.n_links, self.seen = np.zeros(0, bool), none, none, none, none
        self.link_a, self.link_b = none, none  # of all units, one behind the other

    def _number(self, units: list[str]) -> None:
        self.number: dict[str, int] = defaultdict(None, zip(units, range(len(units))))
        self.number.default_factory = self.number.__len__  # a new unit gets the next number

    def forget(self) -> None:
        """Keep at most half as many units as may be remembered, those seen most."""
        least = 2
        while np.count_nonzero(self.seen >= least) > REMEMBERED // 2:
            least *= 2
        kept = np.flatnonzero(self.seen >= least)
        link = _ranges((np.cumsum(self.n_links) - self.n_links)[kept], self.n_links[kept])
        units = list(self.number)
        self._number([units[u] for u in kept])
        self.groups = [self.groups[u] for u in kept]
        self.bad, self.n_a, self.n_b, self.n_links, self.seen = (
            x[kept] for x in (self.bad, self.n_a, self.n_b, self.n_links, self.seen))
        self.link_a, self.link_b = self.link_a[link], self.link_b[link]

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The units of every text, and how many it has; a text that is not UTF-8 has none."""
        if len(self.number) > REMEMBERED:
            self.forget()
        number, known = self.number, len(self.number)
        flat: list[int] = []
        n = []
        for raw in texts:
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                n.append(0)
                continue
            some = units_of(text) if self.models[1].cuttable else [text] * bool(text)
            flat += map(number.__getitem__, some)
            n.append(len(some))
        self._learn(list(islice(number, known, None)))
        unit = np.array(flat, np.int64)
        times = np.bincount(unit, minlength=len(number)) + np.pad(self.seen, (0, len(number) - known))
        self.seen = np.minimum(times, 1 << 30).astype(np.int32)
        return unit, np.array(n, np.int64)

    def _learn(self, new: list[str]) -> None:
        bad, n_a, n_b, n_links, link_a, link_b = ([x] for x in (
            self.bad, self.n_a, self.n_b, self.n_links, self.link_a, self.link_b))
        at, joined = 0, self.models[1].cuttable
        # edges of texts, and B's own sign for a space, which may join with the next unit's
        alone = [not joined or u[0].isspace() or u[-1].isspace() or "▁" in u for u in new]
        while at < len(new):
            to, chars = at + 1, len(new[at])
            while to < len(new) and not alone[at] and not alone[to] and chars + len(new[to]) < _BATCH_CHARS:
                chars += len(new[to]) + 1
                to += 1
            for all_, part in zip((bad, n_a, n_b, n_links, link_a, link_b), self._aligned(new[at:to])):
                all_.append(part)
            at = to
        self.bad, self.n_a, self.n_b, self.n_links, self.link_a, self.link_b = map(
            np.concatenate, (bad, n_a, n_b, n_links, link_a, link_b))

    def _aligned(self, units: list[str]) -> tuple[np.ndarray, ...]:
        whole = " ".join(units)  # tokenised in one call: a space before each unit
        raw = [b" " + u.encode() for u in units]
        edge = np.concatenate([[0], np.cumsum([len(x) for x in raw])])  # bytes of all units
        bad, sides = np.zeros(len(units), bool), []
        for t in self.models:
            ids, start, end = t.encode(whole)
            of = np.searchsorted(edge, start, "right") - 1
            size = t.size[ids]
            joined = b"".join([t.bytes[i] for i in ids.tolist()])
            total = np.concatenate([[0], np.cumsum(size)])
            upto = total[np.searchsorted(of, np.arange(len(raw) + 1))]
            if joined != b"".join(raw) or not np.array_equal(upto, edge):
                bad |= [joined[upto[i]:upto[i + 1]] != x for i, x in enumerate(raw)]
            by_bytes = total[1:] - upto[of] + edge[of]
            ends = refined_ends(start, end, size)
            sides.append((ids, np.where(ends == by_bytes, ends, by_bytes), of))
        (a, a_end, a_of), (b, b_end, b_of) = ([c[~bad[s[2]]] for c in s] for s in sides)
        a_cut, b_cut = np.isin(a_end, b_end, assume_unique=True), np.isin(b_end, a_end, assume_unique=True)
        # the tokens written group by group, A's first
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        a_at = np.arange(len(a)) + np.searchsorted(b_group, a_group)
        b_at = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
        code, of = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
        code[a_at], code[b_at] = 2 * a + a_cut, 2 * (self.size[0] + b) + b_cut
        of[a_at], of[b_at] = a_of, b_of
        spelled = _spelled(*self.size)
        pieces = [spelled[c] for c in code.tolist()]
        cut = np.searchsorted(of, np.arange(len(units) + 1)).tolist()
        self.groups += [b"".join(pieces[i:j])[:-1] for i, j in zip(cut, cut[1:])]
        per_unit = lambda x: np.bincount(x, minlength=len(units)).astype(np.int32)
        return bad, per_unit(a_of), per_unit(b_of), per_unit(a_of[a_cut]), *(
            x.astype(np.int32) for x in (a[a_cut], b[b_cut]))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    data, off = B.string_buffers(batch.column("text"))
    for i, j in B.slices(data, off, _RUN_BYTES, _RUN_DOCS):
        yield i, j, [data[off[k]:off[k + 1]].tobytes() for k in range(i, j)]


def _sums(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the next ``n`` of ``x`` each."""
    total = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    edge = np.concatenate([[0], np.cumsum(n)])
    return total[edge[1:]] - total[edge[:-1]]


def aligned_run(texts: list[bytes], known: Units) -> dict:
    """The relation's row of some documents, without its number and their ids."""
    gc.disable()  # no cycles here, and the collector would walk every unit again and again
    try:
        return _aligned_run(texts, known)
    finally:
        gc.enable()


def _aligned_run(texts: list[bytes], known: Units) -> dict:
    unit, n_units = known.numbers(texts)
    edge = np.concatenate([[0], np.cumsum(n_units)]).tolist()
    whole = _sums(known.bad[unit], n_units) == 0
    unit, n_units = unit[np.repeat(whole, n_units)], np.where(whole, n_units, 0)
    out = {f"n_{c}": pack(_sums(getattr(known, f"n_{c}")[unit], n_units)) for c in ("a", "b", "links")}
    edge = np.concatenate([[0], np.cumsum(n_units)]).tolist()
    spelled = [known.groups[u] for u in unit.tolist()]
    out["digest"] = [hashlib.sha256(b";".join(spelled[i:j])).hexdigest() if i < j else ""
                     for i, j in zip(edge, edge[1:])]
    own, at, times = np.unique(unit, return_inverse=True, return_counts=True)
    n = known.n_links[own]
    link = _ranges((np.cumsum(known.n_links) - known.n_links)[own], n)
    key, links = np.unique(known.link_a[link].astype(np.int64) * known.size[1] + known.link_b[link],
                           return_inverse=True)
    order = np.argsort(links, kind="stable")
    count = _sums(np.repeat(times, n)[order], np.bincount(links, minlength=len(key)))
    ka, kb = np.divmod(key, known.size[1])
    return out | {"n_units": pack(n_units), "units": pack(at), "n_unit_links": pack(n), "links": pack(links),
                  "a": pack(ka), "b": pack(kb), "n": pack(count)}


def _relation(a_path: str, b_path: str):
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _RELATION.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = Units(_tokenizer(a_path), _tokenizer(b_path)), 0
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, texts in _runs(batch):
                row = {"run": (TaskContext.get().partitionId() << 32) + number, "ids": ids.slice(i, j - i).to_pylist(),
                       **aligned_run(texts, known)}
                number += 1
                yield pa.RecordBatch.from_pylist([row], schema)
        known.clear()  # an idle worker holds no units
    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct id pairs of each run as rows."""
    for batch in batches:
        for row in batch.to_pylist():
            a, b, n = (unpack(row[c]) for c in "abn")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), row["run"]), pa.int64()), pa.array(np.arange(len(a)), pa.int32()),
                 pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n.astype(np.int64))],
                ["run", "at", "a", "b", "n"])


def _finish(relation: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a run with the corpus counts of their links."""
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    kinds = [*[pa.int64()] * 7, pa.string()]
    if not relation.num_rows:
        return pa.table([pa.array([], t) for t in kinds], names)
    row = relation.to_pylist()[0]
    total, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, bool)
    at = counts.column("at").to_numpy()
    total[at], best[at] = counts.column("total").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
    units, n_units, n_links = (unpack(row[c]).astype(np.int64) for c in ("units", "n_units", "n_links"))
    links, n_unit_links = unpack(row["links"]), unpack(row["n_unit_links"]).astype(np.int64)
    summed = lambda x: _sums(_sums(x[links], n_unit_links)[units], n_units)
    cols = [row["ids"], unpack(row["n_a"]), unpack(row["n_b"]), n_links, n_links, summed(best), summed(total),
            row["digest"]]
    return pa.table([pa.array(c if isinstance(c, list) else c.astype(np.int64), t) for c, t in zip(cols, kinds)], names)


def align_corpus(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Alignment figures of every document.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``:
    tokens, groups, links, links whose id pair is the most frequent of the
    corpus for its B id (ties included), the links' pair counts summed, and the
    digest of the groups.  Two tokens that end together end a group, so there
    are as many links as groups.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    relation = written(rows.mapInArrow(_relation(a_path, b_path), _RELATION), "token-links")
    pairs = relation.select("run", "a", "b", "n").mapInArrow(_pairs, _PAIRS)
    total = written(pairs.groupBy("a", "b").agg(F.sum("n").alias("total")), "token-pairs")
    best = total.groupBy("b").agg(F.max("total").alias("most"))
    judged = total.join(best, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    counts = pairs.join(judged, ["a", "b"]).select("run", "at", "total", "best")
    done = relation.drop("a", "b", "n")
    return done.groupBy("run").cogroup(counts.groupBy("run")).applyInArrow(_finish, _DIGEST)


def _groups(a_path: str, b_path: str):
    kind = pa.list_(pa.struct([("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Units(_tokenizer(a_path), _tokenizer(b_path))
        size = known.models[0].size
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, texts in _runs(batch):
                unit, n_units = known.numbers(texts)
                edge = np.concatenate([[0], np.cumsum(n_units)]).tolist()
                rows = []
                for x, y in zip(edge, edge[1:]):
                    own, at, groups = unit[x:y].tolist(), 0, []
                    if not known.bad[own].any():
                        for group in chain.from_iterable(known.groups[u].split(b";") for u in own):
                            a, b = ([int(t) for t in side.split(b",")] for side in group.split(b"|"))
                            at += int(size[a].sum())
                            groups.append({"end": at, "a": a, "b": b})
                    rows.append(groups)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(rows, kind)], ["doc_id", "groups"])
    return run


def token_groups(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """``doc_id, groups``: the token ids of both tokenizers between common ends, with the
    byte offset each group ends at (the space before the text is the first byte)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_groups(a_path, b_path),
                           "doc_id long, groups array<struct<end: bigint, a: array<int>, b: array<int>>>")
