"""Dictionary and pattern matchers over text columns.

Matching is case-insensitive substring search on the lower-cased text, and
the order of the dictionary decides, not the position in the text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from ._util import as_col, let, regex_escape


_UNIT_SEP = "\u001f"     # never part of a keyword


def _lowered(text) -> Column:
    return F.lower(as_col(text))


#: Dictionaries of more words are looked for in one pass over the text; a few words that may
#: stand inside others are found faster one by one.  Both ways give the same.
ONE_PASS_FROM = {False: 16, True: 1}


def _trie_pattern(words: Sequence[str]) -> str:
    """A pattern that matches the longest of the words at a place, branching once per character."""
    root: dict = {}
    for word in words:
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = {}

    def spell(node: dict) -> str:
        branches = []
        for ch in sorted(k for k in node if k):
            tail, below = regex_escape(ch), node[ch]
            while len(below) == 1 and "" not in below:  # a run without branches
                (ch, below), = below.items()
                tail += regex_escape(ch)
            branches.append(tail + spell(below))
        if not branches:
            return ""
        return f"(?:{'|'.join(branches)})" + ("?" if "" in node else "")

    return spell(root)


def words_found(lowered, words: Sequence[str], whole_word: bool = False) -> Column:
    """The words (lower case, distinct) that occur in a lower-cased text, in list order, by one pass.

    At every place the longest word that begins there is taken by a pattern that
    holds all words as a trie; the others that begin there are beginnings of it,
    known beforehand.
    """
    words = list(dict.fromkeys(words))
    edge = "[a-z0-9_]"
    trie = _trie_pattern(words)
    pattern = rf"(?<!{edge})(?=({trie})(?!{edge}))" if whole_word else f"(?=({trie}))"
    with_others = {}
    for w in words:
        shorter = [v for v in words if len(v) < len(w) and w.startswith(v)
                   and not (whole_word and re.match(edge, w[len(v)]))]
        if shorter:
            with_others[w] = [w, *shorter]
    hits = F.array_distinct(F.regexp_extract_all(as_col(lowered), F.lit(pattern), F.lit(1)))
    if with_others:
        known = F.create_map(*[x for w, vs in with_others.items()
                               for x in (F.lit(w), F.array(*[F.lit(v) for v in vs]))])
        hits = F.flatten(F.transform(hits, lambda h: F.coalesce(known[h], F.array(h))))
    return F.array_intersect(F.array(*[F.lit(w) for w in words]), hits)


def ordered_label(text, rules: Sequence[tuple[str, str]], default: str | None,
                  whole_word: bool = False) -> Column:
    """First rule whose keyword occurs in the lower-cased text gives the label.

    ``rules`` is an ordered list of ``(keyword, label)`` pairs; ``default`` is
    returned when no keyword occurs (also for NULL text).  Used for the
    responsibility map (E12) and the title category (C8).
    """
    lt = _lowered(text)
    if len(rules) > ONE_PASS_FROM[whole_word] and all(k for k, _ in rules):
        labels: dict[str, str] = {}
        for keyword, label in rules:
            labels.setdefault(keyword.lower(), label)
        known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        return F.coalesce(known[F.get(words_found(lt, list(labels), whole_word), F.lit(0))], F.lit(default))
    expr = None
    for keyword, label in rules:
        hit = _contains(lt, keyword.lower(), whole_word)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def first_listed(text, words: Sequence[str] = vocab.CITIES,
                 sentinel: str = vocab.NOT_FOUND) -> Column:
    """E5: first word of the list found in the text, title-cased."""
    return ordered_label(text, [(w, w.title()) for w in words], sentinel)


def category(title, rules=vocab.CATEGORY_RULES, default: str = vocab.CATEGORY_DEFAULT) -> Column:
    """Keyword category of a title (first rule wins, else the default)."""
    return ordered_label(title, rules, default)


def phrase_flag(text, phrase: str = vocab.FULL_TIME_PHRASE,
                label: str = vocab.FULL_TIME_LABEL, sentinel: str = vocab.NOT_FOUND) -> Column:
    """``label`` when the lower-cased text contains ``phrase``."""
    return ordered_label(text, [(phrase, label)], sentinel)


def regex_first(text, pattern: str, sentinel: str | None = vocab.NOT_FOUND,
                lower: bool = False) -> Column:
    """Whole first match of ``pattern`` (on lower-cased text when
    ``lower``), or the sentinel when there is none.  An empty match counts as
    no match."""
    t = _lowered(text) if lower else as_col(text)
    hit = F.nullif(F.regexp_extract(t, pattern, 0), F.lit(""))
    return hit if sentinel is None else F.coalesce(hit, F.lit(sentinel))


def keyword_tags(text, words: Sequence[str] = vocab.SKILLS, max_tags: int = vocab.MAX_SKILLS,
                 sentinel: str = vocab.NOT_FOUND, sep: str = ", ",
                 whole_word: bool = False) -> Column:
    """The first ``max_tags`` words of the list found in the text, in list
    order, joined by ``sep``; the sentinel when none is found."""
    lt = _lowered(text)
    spelled = {w.lower(): w for w in words}
    if len(words) > ONE_PASS_FROM[whole_word] and len(spelled) == len(words) and all(words):
        first = F.slice(words_found(lt, list(spelled), whole_word), 1, max_tags)
        if any(low != w for low, w in spelled.items()):
            known = F.create_map(*[F.lit(x) for pair in spelled.items() for x in pair])
            first = F.transform(first, lambda w: known[w])
        return let(first, lambda f: F.when(F.size(f) > 0, F.array_join(f, sep)).otherwise(F.lit(sentinel)))
    # concat_ws skips the NULLs of words not found; split/slice/array_join are
    # code-generated, so the lower-cased text is computed once per row (a
    # higher-order function here would evaluate it once per word)
    hits = F.concat_ws(_UNIT_SEP, *[F.when(_contains(lt, w.lower(), whole_word), F.lit(w))
                                   for w in words])
    first = F.array_join(F.slice(F.split(hits, _UNIT_SEP), 1, max_tags), sep)
    return F.when(hits == "", F.lit(sentinel)).otherwise(first)


def presence_flag(c, sentinel: str = vocab.NOT_STATED) -> Column:
    """1 when the value is present and not the sentinel, else 0 (NULL -> 0)."""
    return F.when(as_col(c) != F.lit(sentinel), F.lit(1)).otherwise(F.lit(0))


def _words_only(lowered: Column) -> Column:
    """The text with a space for everything that is no letter, digit or underscore, and at both ends."""
    return F.concat(F.lit(" "), F.regexp_replace(lowered, "[^a-z0-9_]", " "), F.lit(" "))


def _contains(lowered: Column, keyword: str, whole_word: bool) -> Column:
    if not whole_word:
        return lowered.contains(F.lit(keyword))
    if re.fullmatch("[a-z0-9_]+", keyword):  # the same cleaned text serves every such keyword
        return _words_only(lowered).contains(F.lit(f" {keyword} "))
    pattern = r"(^|[^a-z0-9_])" + regex_escape(keyword) + r"($|[^a-z0-9_])"
    return lowered.contains(F.lit(keyword)) & lowered.rlike(pattern)
