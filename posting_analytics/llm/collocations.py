"""Phrase collocation mining as set-oriented relations (SETM).

The relation ``R_k`` holds the occurrences of phrases of ``k`` words, sorted by
piece and position.  A round

1. group-counts the phrases of ``R_k``,
2. semi-joins ``R_k`` with the groups found often enough, and
3. merge-joins what is left with itself on equal piece and adjacent position:
   two frequent phrases of ``k`` words, one a word after the other, are an
   occurrence of ``R_{k+1}``.

What a round leaves of its relation is written to the shared folder, so that the
next reads it and a lost executor costs its own partitions.  The merge-join is
made where it is read, once to count and once to semi-join: it names far more
phrases than its sides, most of them found a few times only.

A row of a written relation is a run, some megabytes of text: the places of its
occurrences as bits, the phrase at each as a number in the run's own list of
distinct phrases, and that list, in byte planes that are compressed.  Places
count words through the run and skip one between pieces, so equal piece and
adjacent position is "the next place".  A run sends each distinct phrase once,
with its count, to the bucket of its key; the bucket adds the counts up and
sends back an id for a phrase found often enough, else 0.  A phrase that holds
a third of all occurrences is one entry per run.  Buckets are cut by the number
of entries, so that one holds about a million at any size.

The key of a word is a 128-bit digest of language and word; the key of a longer
phrase is the pair of ids of its first and its last ``k - 1`` words, so counts
are of phrases, not of hashes of them.

Cases: a null text is empty; a null language is `und`, one with a language of
that name; repeated rows count as often as they stand; rows without words give
nothing; a text longer than a run is cut between pieces (one piece is never
cut); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import bytetext as B
from .common import written

U = np.uint64
_RUN_BYTES, _RUN_DOCS = 8 << 20, 1 << 16
#: Distinct phrases of runs that a bucket takes, on average.
PER_BUCKET = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(b".,;:!?\n\x0b\x0c\r")] = True
_WORD = ~_SEPARATOR
_WORD[[0x20, 0x09]] = False

_RELATION = ("run long, entries long, place binary, gram binary, hi binary, lo binary, n binary, "
             "langs array<string>, totals array<long>, lang_of binary, words binary, word_size binary")
_EXTENDED = ("run long, entries long, place binary, gram binary, ids binary, "
             "found array<struct<id: bigint, f: bigint, lang: string, phrase: string>>")
#: What the semi-join reads of the words' relation, and of those of longer phrases.
_WORDS, _PHRASES = ["run", "place", "gram", "langs", "lang_of", "words", "word_size"], ["run", "place", "gram", "ids"]
_SENT = "bucket long, run long, hi binary, lo binary, n binary"
_ANSWER = ("bucket long, run long, id binary, f binary, "
           "found array<struct<id: bigint, hi: bigint, lo: bigint, f: bigint>>")
_FOUND_WORD = pa.list_(pa.struct([("id", pa.int64()), ("f", pa.int64()), ("lang", pa.string()),
                                  ("phrase", pa.string())]))
_FOUND = pa.list_(pa.struct([(c, pa.int64()) for c in ("id", "hi", "lo", "f")]))


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unsqueeze(b: bytes) -> bytes:
    size = int.from_bytes(b[:8], "little")
    return pa.decompress(b[8:], size, "zstd", asbytes=True) if size else b""


def pack(x: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes, the least number that holds them."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + squeeze(planes.T.tobytes())


def unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(b[1:]), np.uint8).reshape(b[0], -1)
    x = planes[0].astype(U)
    for i in range(1, b[0]):
        x |= planes[i].astype(U) << U(8 * i)
    return x


def pack_rising(x: np.ndarray) -> bytes:
    """Ascending non-negative integers by their differences."""
    return pack(np.diff(x.astype(U), prepend=U(0)))


def unpack_rising(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=U)


def pack_places(place: np.ndarray) -> bytes:
    """Distinct ascending places as bits."""
    there = np.zeros(int(place[-1]) + 1 if len(place) else 0, bool)
    there[place] = True
    return pack(np.packbits(there))


def unpack_places(b: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(unpack(b).astype(np.uint8)))


def bucket_of_word(hi: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the key."""
    return ((hi >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def bucket_of(hi: np.ndarray, lo: np.ndarray, buckets: int) -> np.ndarray:
    return (B.mix(B.mix(hi.astype(U)) ^ lo.astype(U)) % U(buckets)).astype(np.int64)


def _cut_long(data: np.ndarray, off: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets with texts longer than ``most`` bytes cut behind separators, and each part's document."""
    parts, doc = [], []
    for i in np.flatnonzero(np.diff(off) > most).tolist():
        at = int(off[i])
        while off[i + 1] - at > most:
            near = np.flatnonzero(_SEPARATOR[data[at:at + most]])
            if not len(near):  # a piece longer than a run: up to its end
                far = np.flatnonzero(_SEPARATOR[data[at + most:off[i + 1]]])
                if not len(far):
                    break
                at += most + int(far[0]) + 1
            else:
                at += int(near[-1]) + 1
            if at < off[i + 1]:
                parts.append(at)
                doc.append(i)
    of = np.concatenate([np.arange(len(off) - 1), np.array(doc, np.int64)])
    begin = np.concatenate([off[:-1], np.array(parts, np.int64)])
    order = np.argsort(begin, kind="stable")
    return np.append(begin[order], off[-1]), of[order]


def occurrences(data: np.ndarray, off: np.ndarray, langs: pa.Array) -> dict:
    """The relation ``R_1`` of some documents, given their language each."""
    data, off = data[off[0]:off[-1]], off - off[0]
    w = B.words(data, off, _WORD, hashed=False)
    n, doc = len(w.start), w.doc
    marks = np.searchsorted(np.flatnonzero(_SEPARATOR[data]), w.start)
    new = np.ones(n, bool)
    new[1:] = (marks[1:] != marks[:-1]) | (doc[1:] != doc[:-1])
    place = np.arange(n) + np.cumsum(new)
    lower = B.LOWER[data]
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(w.end - w.start, out=ends[1:])
    spans = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.tobytes()),
                                                         pa.py_buffer(lower[_WORD[lower]].tobytes())])
    coded = spans.dictionary_encode()
    lang = langs.dictionary_encode()
    names, words = lang.dictionary.to_pylist(), coded.dictionary.to_pylist()
    size = max(1, len(words))
    key = lang.indices.to_numpy()[doc].astype(np.int64) * size + coded.indices.to_numpy()
    entry, gram, count = np.unique(key, return_inverse=True, return_counts=True)
    lang_of, word_of = entry // size, (entry % size).tolist()
    heads = [x.encode() + b"\t" for x in names]  # no word holds a tab
    digest = b"".join(hashlib.blake2b(heads[a] + words[b], digest_size=16).digest()
                      for a, b in zip(lang_of.tolist(), word_of))
    key = np.frombuffer(digest, U).reshape(-1, 2)
    order = np.lexsort((key[:, 1], key[:, 0]))  # entries by key, and so by bucket whatever their number
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    key, lang_of, count, blob = key[order], lang_of[order], count[order], [words[word_of[i]] for i in order.tolist()]
    return {"entries": len(entry), "place": pack_places(place), "gram": pack(rank[gram]), "hi": pack_rising(key[:, 0]),
            "lo": pack(key[:, 1]), "n": pack(count), "langs": names,
            "totals": np.bincount(lang_of, count, len(names)).astype(np.int64).tolist(),
            "lang_of": pack(lang_of), "words": squeeze(b"".join(blob)),
            "word_size": pack(np.array([len(x) for x in blob], np.int64))}


def _types(schema: str, **special: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
             "array<long>": pa.list_(pa.int64())}
    fields, schema = [], schema.split(", found ")[0]
    for field in schema.split(", "):
        name, kind = field.split(" ")
        fields.append((name, kinds[kind]))
    return pa.schema([*fields, *special.items()])


def _relation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, number = _types(_RELATION), 0
    for batch in batches:
        data, off = B.string_buffers(batch.column("text"))
        off, doc = _cut_long(data, off, _RUN_BYTES)
        langs = batch.column("lang")
        for a, b in B.slices(data, off, _RUN_BYTES, _RUN_DOCS):
            row = occurrences(data, off[a:b + 1], langs.take(pa.array(doc[a:b])))
            row["run"] = (TaskContext.get().partitionId() << 32) + number
            number += 1
            yield pa.RecordBatch.from_pylist([row], schema)


def pairs(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merge-join of a run with itself: places, keys of two of its phrases, and the phrases' ids."""
    ids = unpack_rising(row["ids"])
    place, gram = unpack_places(row["place"]), unpack(row["gram"]).astype(np.int64)
    here = np.flatnonzero(place[1:] == place[:-1] + 1)
    return place[here], gram[here] * max(1, len(ids)) + gram[here + 1], ids


def by_bucket(key: np.ndarray, ids: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Order of distinct ascending keys of a merge-join by bucket, and in it bucket, first and second id."""
    a, b = np.divmod(key, max(1, len(ids)))
    hi, lo = ids[a], ids[b]
    to = bucket_of(hi, lo, buckets)
    order = np.argsort(to, kind="stable")
    return order, to[order], hi[order], lo[order]


def _route(buckets: int, words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if words:
                    hi, lo, n = unpack_rising(row["hi"]), unpack(row["lo"]), unpack(row["n"])
                    to = bucket_of_word(hi, buckets)
                else:
                    _, key, ids = pairs(row)
                    key, n = np.unique(key, return_counts=True)
                    order, to, hi, lo = by_bucket(key, ids, buckets)
                    n = n[order]
                at = np.flatnonzero(np.diff(to, prepend=-1))
                part = list(zip(at.tolist(), [*at[1:].tolist(), len(to)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[at], pa.int64()), pa.array([row["run"]] * len(part), pa.int64()),
                     *[pa.array([put(x[a:b]) for a, b in part], pa.binary())
                       for x, put in ((hi, pack_rising), (lo, pack), (n, pack))]],
                    ["bucket", "run", "hi", "lo", "n"])
    return run


def _count(min_count: int, buckets: int, words: bool, back: bool):
    """Total counts of a bucket's phrases: if ``back``, an id, or 0, for every entry of every run.

    Words: one run of those that named a word also learns its count, to give the
    word's spelling; longer phrases are given here, by the ids of their parts.
    """
    schema = _types(_ANSWER, found=_FOUND)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("run")
        bucket = table.column("bucket")[0].as_py()
        hi, lo, n = ([get(x.as_py()) for x in table.column(c)]
                     for c, get in (("hi", unpack_rising), ("lo", unpack), ("n", unpack)))
        edges = np.cumsum([len(x) for x in hi])[:-1]
        hi, lo, n = (np.concatenate(x).astype(U) for x in (hi, lo, n))
        order = np.lexsort((lo, hi))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)
        at = np.flatnonzero(new)
        total = np.add.reduceat(n[order], at).astype(np.int64)
        often = total >= min_count
        ids = np.where(often, np.cumsum(often) * buckets + bucket, 0)  # never 0 where often
        of = np.cumsum(new) - 1
        answer = np.empty(len(order), np.int64)
        answer[order] = ids[of]
        rows = table.num_rows if back else 0
        out = {"bucket": [bucket] * rows, "run": table.column("run").to_pylist()[:rows],
               "id": [pack(x) for x in np.split(answer, edges)[:rows]], "f": [None] * rows, "found": [None] * rows}
        if words:
            f = np.zeros(len(order), np.int64)
            f[np.minimum.reduceat(order, at)[often]] = total[often]
            out["f"] = [pack(x) for x in np.split(f, edges)]
        elif often.any():
            first = order[at][often]
            cols = (ids[often], hi[first].astype(np.int64), lo[first].astype(np.int64), total[often])
            found = [dict(zip(("id", "hi", "lo", "f"), x)) for x in zip(*[c.tolist() for c in cols])]
            for name, value in zip(("bucket", "run", "id", "f", "found"), (bucket, None, None, None, found)):
                out[name].append(value)
        return pa.Table.from_pydict(out, schema)
    return run


def _extend(buckets: int, words: bool):
    """The semi-join of a run with its answers: the occurrences of phrases found often enough."""
    schema = _types(_EXTENDED, found=_FOUND_WORD)

    def run(relation: pa.Table, answers: pa.Table) -> pa.Table:
        if not relation.num_rows:
            return schema.empty_table()
        row = relation.to_pylist()[0]
        answers = answers.sort_by("bucket")

        def answered(name: str) -> np.ndarray:
            return np.concatenate([np.zeros(0, U), *[unpack(x) for x in answers.column(name).to_pylist()]])

        ids, found = answered("id"), []
        if words:
            place, gram = unpack_places(row["place"]), unpack(row["gram"]).astype(np.int64)
            end = np.cumsum(unpack(row["word_size"]).astype(np.int64))
            f, lang_of, text = answered("f"), unpack(row["lang_of"]), unsqueeze(row["words"])
            for e in np.flatnonzero(f).tolist():
                word = text[end[e - 1] if e else 0:end[e]]
                found.append({"id": int(ids[e]), "f": int(f[e]), "lang": row["langs"][int(lang_of[e])],
                              "phrase": word.decode("utf-8", "replace")})
        else:
            place, key, parts = pairs(row)
            key, gram = np.unique(key, return_inverse=True)
            sent, ids = ids, np.zeros(len(key), U)
            ids[by_bucket(key, parts, buckets)[0]] = sent
        order = np.argsort(ids, kind="stable")  # phrases are numbered by id, those dropped first
        order = order[ids[order] > 0]
        rank = np.full(len(ids), -1)
        rank[order] = np.arange(len(order))
        gram = rank[gram]
        place, gram = place[gram >= 0], gram[gram >= 0]
        return pa.Table.from_pylist([{
            "run": row["run"], "entries": int((np.diff(place) == 1).sum()), "place": pack_places(place),
            "gram": pack(gram), "ids": pack_rising(ids[order]), "found": found}], schema)
    return run


def _buckets(relation: DataFrame) -> int:
    entries = relation.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0]
    parts = int(relation.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(parts, -(-entries // PER_BUCKET))


def frequent_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by number of words, and the languages' word counts.

    Phrases: ``id, lang, phrase, f, heads, tails`` for each number of words from
    1 to ``max_words``; ``heads[j]`` and ``tails[j]`` are the counts of the
    phrase's first and last ``j + 1`` words.  From 2 on also ``hi`` and ``lo``,
    the ids of the phrase without its last and its first word.
    """
    if max_words < 2 or min_count < 1:
        raise ValueError("phrases have two words or more, found once or more")
    rows = docs.select(F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    relation = written(rows.mapInArrow(_relation, _RELATION), "phrase-words")
    totals = relation.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(
        F.col("t.langs").alias("lang")).agg(F.sum("t.totals").alias("n"))
    levels: list[DataFrame] = []
    for k in range(1, max_words + 1):
        buckets = _buckets(relation)
        sent = relation.select(["run", "hi", "lo", "n"] if k == 1 else _PHRASES).mapInArrow(
            _route(buckets, k == 1), _SENT)
        answers = written(sent.groupBy("bucket").applyInArrow(
            _count(min_count, buckets, k == 1, k < max_words), _ANSWER), f"phrase-counts-{k}")
        if k > 1:
            f = answers.filter("run is null").select(F.inline("found"))
            one = levels[-1]
            p, s = (one.select(*[F.col(c).alias(f"{side}_{c}") for c in ("id", "lang", "phrase", "heads", "tails")])
                    for side in "ps")
            joined = f.join(p, f.hi == p.p_id).join(s, f.lo == s.s_id)
            levels.append(joined.select(
                "id", "hi", "lo", F.col("p_lang").alias("lang"),
                F.concat_ws(" ", "p_phrase", F.substring_index("s_phrase", " ", -1)).alias("phrase"), "f",
                F.array_append("p_heads", F.col("f")).alias("heads"),
                F.array_append("s_tails", F.col("f")).alias("tails")))
        if k < max_words:
            asked = answers.filter("run is not null").select("bucket", "run", "id", "f")
            body = relation.select(_WORDS if k == 1 else _PHRASES)
            relation = written(body.groupBy("run").cogroup(asked.groupBy("run")).applyInArrow(
                _extend(buckets, k == 1), _EXTENDED), f"phrase-relation-{k + 1}")
            if k == 1:
                levels.append(relation.select(F.inline("found")).select(
                    "id", "lang", "phrase", "f", F.array("f").alias("heads"), F.array("f").alias("tails")))
    return levels, totals


def collocations(docs: DataFrame, *, max_words: int = 3, min_count: int = 10, cover_percent: int = 50,
                 per_lang: int | None = 2000) -> DataFrame:
    """The phrases of each language whose words stand together more than their parts would.

    ``lang, rank, phrase, a, l, r, n, score``: ``a`` is the phrase's count, ``l``
    and ``r`` those of its two parts at the cut with the least score (ties: the
    shorter first part), ``n`` the language's words and the score
    ``floor(1000000 * a * a / (l * r))`` in exact integers.  A phrase inside a
    longer frequent one that makes up ``cover_percent`` of its places or more is
    dropped.  The first ``per_lang`` of each language (None: all) by score and
    count, descending, and phrase in byte order.
    """
    levels, totals = frequent_phrases(docs, max_words, min_count)
    big = lambda c: c.cast("decimal(19,0)")
    out = None
    for k in range(2, max_words + 1):
        one, f = levels[k - 1], F.col("f")
        cuts = []
        for j in range(1, k):
            left, right = F.col("heads")[j - 1], F.col("tails")[k - j - 1]
            score = F.expr("cast(1000000 as decimal(7,0))") * (big(f) * big(f))
            cuts.append(F.struct(F.call_function("div", score, big(left) * big(right)).alias("score"),
                                 F.lit(j).alias("cut"), left.alias("l"), right.alias("r")))
        if k < max_words:
            longer = levels[k].select(F.explode(F.array("hi", "lo")).alias("inner"), F.col("f").alias("of"))
            longer = longer.groupBy("inner").agg(F.max("of").alias("of"))
            one = one.join(longer, one.id == longer.inner, "left").filter(
                F.col("of").isNull() | (100 * F.col("of") < cover_percent * f))
        one = one.select("lang", "phrase", f.alias("a"), F.array_min(F.array(*cuts)).alias("c"))
        out = one if out is None else out.unionByName(one)
    out = out.join(totals, "lang").select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"),
                                          "n", F.col("c.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = out.withColumn("rank", F.row_number().over(order))
    if per_lang is not None:
        out = out.filter(F.col("rank") <= per_lang)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
