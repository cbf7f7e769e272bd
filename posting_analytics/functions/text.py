"""Text and HTML column builders (page-to-row extraction, E1-E4).

All builders return native Spark ``Column`` expressions, so extraction runs
as JVM code on the executors that hold the pages, with no Python workers.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from ._util import as_col, let, regex_escape

# Markup as one token: a start tag with attributes of any length, an end tag, a
# comment, a declaration, or a whole script or style element.  What is open at the
# end of the page ends there, as in the HTML standard, so a token that has begun
# always matches: the repeats are possessive, and a page is read once, in linear
# time and without recursion.
HTML_WS = r"[ \t\r\n\f]"
_NAME = r"[^ \t\r\n\f/>][^ \t\r\n\f/>=]*+"
# a quote that is never closed is part of an unquoted value
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^ \t\r\n\f>]*+)"""
_ATTR = rf"{_NAME}(?:{HTML_WS}*+={HTML_WS}*+{_VALUE})?+"
_ATTRS = rf"(?:[ \t\r\n\f/]++|{_ATTR})*+"
_NAMED = r"(?=[ \t\r\n\f/>])"
_END = r"(?:>|\z)"


def _raw(group: int) -> str:
    """A script or style element; ``group`` is the number of its name's group."""
    return rf"((?i:script|style)){_NAMED}{_ATTRS}{_END}(?:(?s:.)*?</(?i:\{group}){_NAMED}[^>]*+{_END}|(?s:.)*+\z)"


def _token(before: int = 0, template: bool = False) -> str:
    """A token, in a pattern with ``before`` groups before it.  With ``template``
    a template's tags are a group of their own, the second."""
    kinds = [_raw(before + 1), r"!--(?:-?>|(?s:.)*?--!?>|(?s:.)*+\z)", rf"[!?/][^>]*+{_END}",
             rf"[A-Za-z][^ \t\r\n\f/>]*+{_ATTRS}{_END}"]
    if not template:
        return f"<(?:{'|'.join(kinds)})"
    return rf"<(?:{'|'.join(kinds[:2])})|(</?(?i:template){_NAMED}{_ATTRS}{_END})|<(?:{'|'.join(kinds[2:])})"


TOKEN = _token()
_TEMPLATE_TOKEN = _token(template=True)
_TEMPLATE = "(?i)</?template"
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
        "script", "style")  # script and style are one token
# End tags that close nothing but themselves where a page is sound.
_INLINE = "a|abbr|b|br|cite|code|em|font|i|img|mark|q|s|small|span|strong|sub|sup|time|u|wbr"

# Named references of HTML 4 (a stdlib table) and the code points that HTML
# reads as Windows-1252.
NAMED_REFERENCES = {name: chr(code) for name, code in html.entities.name2codepoint.items()} | {"apos": "'"}
_C1 = "".join(bytes([i]).decode("cp1252", "replace") for i in range(0x80, 0xA0))


def normalize_ws(c) -> Column:
    """Strip and collapse every whitespace run to one space; NULL -> ''."""
    collapsed = F.regexp_replace(as_col(c), vocab.WS + "+", " ")
    return F.coalesce(F.trim(collapsed), F.lit(""))


def _code_point(n: Column) -> Column:
    """The character of a code point; what HTML does not allow is U+FFFD."""
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    bad = n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    return (F.when(bad, F.lit("\ufffd"))
            .when(n.between(0x80, 0x9F), F.substr(F.lit(_C1), (n - 0x7F).cast("int"), F.lit(1)))
            .otherwise(char))


def _decode_piece(piece: Column, names: Column) -> Column:
    """What follows an ``&``: its reference decoded, or the ``&`` kept."""
    number = F.regexp_extract(piece, "^#([0-9]+);?", 1)
    hexa = F.regexp_extract(piece, "^#[xX]([0-9A-Fa-f]+);?", 1)
    name = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*);", 1)
    code = (F.when(F.length(F.ltrim(number, F.lit("0"))) > 7, F.lit(0x110000))
            .when(number != "", number.try_cast("bigint"))
            .when(F.length(F.ltrim(hexa, F.lit("0"))) > 6, F.lit(0x110000))
            .otherwise(F.conv(hexa, 16, 10).try_cast("bigint")))
    rest = F.regexp_replace(piece, "^#(?:[xX][0-9A-Fa-f]+|[0-9]+);?", "")
    known = F.element_at(names, name)
    return (F.when((number != "") | (hexa != ""), F.concat(_code_point(code), rest))
            .when(known.isNotNull(), F.concat(known, F.substr(piece, F.length(name) + F.lit(2))))
            .otherwise(F.concat(F.lit("&"), piece)))


# Names decoded by plain replacement; none gives a character that a reference is written with.
_COMMON = ("nbsp", "lt", "gt", "quot", "apos", "copy", "reg", "middot", "hellip", "ndash", "mdash", "lsquo", "rsquo",
           "ldquo", "rdquo", "laquo", "raquo", "bull", "euro", "eacute")


def decode_entities(c) -> Column:
    """Decode character references: numeric ones (``&#8211;``, ``&#x27;``, with or
    without ``;``) and the named ones of HTML 4 and ``&apos;`` (with ``;``).

    What a reference gives is never read as a reference again.  Text without
    ``&`` is passed on; frequent names are replaced as they stand, and only where
    others are left is the text cut at every ``&`` and each piece decoded.
    """
    def frequent(c):
        for name in _COMMON:
            c = F.replace(c, F.lit(f"&{name};"), F.lit(NAMED_REFERENCES[name]))
        return c

    def rest(c):
        names = F.create_map(*[F.lit(x) for pair in NAMED_REFERENCES.items() for x in pair])
        pieces = F.transform(F.split(c, "&"), lambda p, i: F.when(i == 0, p).otherwise(_decode_piece(p, names)))
        return (F.when(c.rlike("&(?!amp;)[A-Za-z#]"), F.array_join(pieces, ""))
                .otherwise(F.replace(c, F.lit("&amp;"), F.lit("&"))))

    return let(as_col(c), lambda c: F.when(~c.contains("&"), c).otherwise(let(frequent(c), rest)))


def strip_tags(c, replacement: str = " ") -> Column:
    """Replace every markup token (scripts and styles with their content) with ``replacement``."""
    return F.regexp_replace(as_col(c), TOKEN, replacement)


def _outside_templates(body: Column) -> Column:
    """The text of ``body``, whose only markup are template tags, outside of templates."""
    pieces = F.split(body, r"(?=</?(?i:template))")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"))

    def step(state, piece):
        opens, closes = piece.rlike("^(?i)<template"), piece.rlike("^(?i)</template")
        depth = (F.when(opens, state["depth"] + 1).when(closes, F.greatest(state["depth"] - 1, F.lit(0)))
                 .otherwise(state["depth"]))
        shown = F.regexp_replace(piece, rf"^</?(?i:template){_NAMED}{_ATTRS}{_END}", " ")
        return F.struct(depth.alias("depth"),
                        F.when(depth == 0, F.concat(state["text"], shown)).otherwise(state["text"]).alias("text"))

    return F.aggregate(pieces, start, step, lambda state: state["text"])


def html_to_text(html) -> Column:
    """Visible text of a page, text nodes joined by one space.

    Markup becomes spaces and references are decoded; scripts, styles and
    templates (nested ones too) show nothing.  Every whitespace run is
    then one space, also inside a text node (a parser that only strips each
    node would keep inner line breaks; here phrases match across them).
    """
    body = F.regexp_replace(as_col(html), _TEMPLATE_TOKEN, " $2 ")
    shown = let(body, lambda b: F.when(b.rlike(_TEMPLATE), _outside_templates(b)).otherwise(b))
    return normalize_ws(decode_entities(shown))


def _upto(start: str, before: int = 0) -> str:
    """Text and tokens of any kind up to a start tag, none inside a comment, script or attribute."""
    return rf"(?:[^<]++|(?!{start})(?:{_token(before)}|<))*+"


def tag_start(tag: str) -> str:
    """Regex of the start tags of an element."""
    return rf"<(?i:{regex_escape(tag)}){_NAMED}{_ATTRS}{_END}"


_NOT_HREF = rf"(?:[ \t\r\n\f/]++|(?!(?i:href)(?=[ \t\r\n\f/>=])){_ATTR})*+"
_A_HREF = rf"<(?i:a){_NAMED}{_NOT_HREF}(?i:href){HTML_WS}*+={HTML_WS}*+"


def anchor_start(href_substring: str) -> str:
    """Regex of the start tags of links whose ``href`` as it is written contains a
    substring (tag and attribute names ignore case, the substring does not)."""
    sub = regex_escape(href_substring)
    value = "|".join((f'"(?:(?!{sub})[^"])*+{sub}[^"]*+"', f"'(?:(?!{sub})[^'])*+{sub}[^']*+'",
                      rf"(?![\"'])(?:(?!{sub})[^ \t\r\n\f>])*+{sub}[^ \t\r\n\f>]*+"))
    return f"{_A_HREF}(?:{value}){_ATTRS}{_END}"


def _parsed_element(html: Column, tag: str, start: str) -> Column:
    """Inner text of the first element whose start tag is ``start``, by a fold over the
    page's tokens that keeps the names of the open elements.

    An end tag closes the last open element of its name and all inside it, and
    does nothing where there is none; so an element that is not closed ends with
    the one around it, or with the page.
    """
    tokens, texts = F.regexp_extract_all(html, F.lit(f"({TOKEN})"), F.lit(1)), F.split(html, TOKEN)
    zero = F.struct(F.lit(0).alias("i"), F.lit(">").alias("open"), F.lit(-1).alias("mark"),
                    F.lit(-1).alias("from"), F.lit(-1).alias("to"))

    def step(s, token):
        name = F.lower(F.regexp_extract(token, "^</?([A-Za-z][^ \\t\\r\\n\\f/>]*)", 1))
        key = F.concat(F.lit(">"), name, F.lit(">"))
        ends = token.startswith("</") & s["open"].contains(key)
        inner = F.length(F.call_function("substring_index", s["open"], key, F.lit(-1)))
        left = F.substr(s["open"], F.lit(1), F.length(s["open"]) - inner - F.length(name) - F.lit(1))
        starts = ~token.startswith("</") & (name != "") & ~name.isin(*VOID)
        opened = F.when(ends, left).when(starts, F.concat(s["open"], name, F.lit(">"))).otherwise(s["open"])
        hit = (s["mark"] < 0) & (name == tag) & token.rlike(f"^{start}")
        done = s["to"] >= 0
        shut = (s["mark"] >= 0) & ends & (F.length(left) <= s["mark"])
        return F.struct(
            (s["i"] + 1).alias("i"), F.when(done, s["open"]).otherwise(opened).alias("open"),
            F.when(hit, F.length(s["open"])).otherwise(s["mark"]).alias("mark"),
            F.when(hit, s["i"]).otherwise(s["from"]).alias("from"),
            F.when(~done & shut, s["i"]).otherwise(s["to"]).alias("to"))

    def inside(s):
        upto = F.when(s["to"] < 0, F.size(texts)).otherwise(s["to"] + 1)
        return F.array_join(F.slice(texts, s["from"] + 2, upto - s["from"] - 1), "")

    return F.aggregate(tokens, zero, step, inside)


def element_text(html, tag: str, start: str, sentinel: str = vocab.NOT_FOUND) -> Column:
    """Text of the first element of a page whose start tag matches ``start`` (inner tags
    removed without a space, references decoded, whitespace normalised); the sentinel
    when there is none.

    An element that holds none of its kind, no end tag of a block, and its own end
    tag is cut out by one match; the others are found by parsing the page.
    """
    html = as_col(html)
    again = rf"</?(?i:{regex_escape(tag)}){_NAMED}"
    inner = _upto(again, 2)
    found = F.regexp_extract(html, rf"\A{_upto(start)}({start}{inner}(?:{again}|\z))", 2)
    name = f"(?i:{regex_escape(tag)})"

    def text(found):
        # the match ends where an end tag of this kind begins, or the element is no simple one
        sound = found.rlike(rf"</{name}\z") & ~found.rlike(
            rf"</(?!(?i:{_INLINE}|{regex_escape(tag)}){_NAMED}|{name}\z)")
        simple = strip_tags(F.regexp_replace(found, rf"</{name}\z", ""), "")
        whole = F.when(sound, simple).otherwise(_parsed_element(html, tag, start))
        return (F.when(F.coalesce(found, F.lit("")) == "", F.lit(sentinel))
                .otherwise(normalize_ws(decode_entities(whole))))

    return let(found, text)


def first_tag_text(html, tag: str = "h1", sentinel: str = vocab.NOT_FOUND) -> Column:
    """Cleaned text of the first ``<tag>`` element, or the sentinel."""
    return element_text(html, tag, tag_start(tag), sentinel)


def anchor_text(html, href_substring: str = vocab.COMPANY_LINK_SUBSTRING,
                sentinel: str = vocab.NOT_FOUND) -> Column:
    """Cleaned text of the first link whose href contains a substring."""
    return element_text(html, "a", anchor_start(href_substring), sentinel)


# the rest of the page is a match too, without a value: the page is read once
HREF_PATTERN = rf"{_upto(_A_HREF)}(?:{_A_HREF}({_VALUE}){_ATTRS}{_END}|\z)"


def unquote(v) -> Column:
    """An attribute value without its surrounding quotes."""
    v = as_col(v)
    quoted = v.rlike(r"""(?s)\A(?:"[^"]*"|'[^']*')\z""")
    return F.when(quoted, v.substr(F.lit(2), F.length(v) - 2)).otherwise(v)


def hrefs(html) -> Column:
    """All ``href`` values of ``<a>`` tags (any quoting), entity-decoded; one without a value gives none."""
    found = F.array_remove(F.regexp_extract_all(as_col(html), F.lit(HREF_PATTERN), F.lit(2)), "")
    return F.transform(found, lambda h: decode_entities(unquote(h)))


POSTED_DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy")


def parse_date(c, formats=POSTED_DATE_FORMATS) -> Column:
    """A date written in any of ``formats`` (first that parses), else NULL.

    Crawl dates appear both as ``2026-06-13`` and as ``6/13/2026``.
    """
    return F.coalesce(*[F.try_to_date(as_col(c), f) for f in formats])
