"""Main-text extraction with a linear-chain conditional random field.

A page is read into its DOM leaf blocks: runs of text between block-level tags,
each with the path of its ancestors.  Every block gets features of its ancestor
tags, of the words of their class, id and role attributes, and of its text
(length, link share, final punctuation, place in the page).  A linear-chain CRF
with the labels *boilerplate* and *article* is trained on labelled pages by its
exact likelihood (forward-backward) and pages are decoded by Viterbi.

The labelled pages are built here: sites with random words whose menus, headers,
footers, sidebars, notices, adverts, forms, comments and articles are marked up
in many usual ways (``labelled_pages``); callers may train on pages of their own.

Cases: null or empty html gives an empty text; a page without an article gives
an empty text; broken, unclosed and cut-off markup is read as far as it goes;
pages of any length are read whole; repeated pages are extracted alike; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Their content is characters up to the end tag, or to the end of the page.
RAW = frozenset("script style textarea xmp iframe noembed noframes".split())
#: Their content is markup that does not belong to the text.
HIDDEN = frozenset("noscript template svg object canvas math select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd "
                   "label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
                   "wbr".split())
#: Start tags that end an open element of these names.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
#: An implied end never reaches over these.
SCOPE = frozenset("ul ol dl table article aside main section nav header footer div body html form "
                  "blockquote fieldset figure details".split())

_TAG = re.compile(
    r"<(?:!--(?:.*?-->|.*)|[!?][^>]*>?"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>?))", re.S)
_ATTR = re.compile(r"(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # entries "tag" or "tag names-of-attributes"
    link: int  # characters inside links


def blocks(html: str) -> list[Block]:
    """The non-empty leaf blocks of a page in order.

    A hidden element without an end tag behind it is passed over, what it holds stays; one
    with an end tag hides its content up to there, or until an element around it ends.
    """
    out: list[Block] = []
    stack: list[str] = []
    tags: list[str] = []
    parts: list[str] = []
    links = [0]
    path: tuple[str, ...] = ()
    hidden: int | None = None  # the place of the outermost open hidden element in the stack
    last_end: dict[str, int] = {}

    def flush() -> None:
        if parts and hidden is None:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, path, links[0]))
            parts.clear()
            links[0] = 0

    def pop_to(n: int) -> None:
        nonlocal hidden
        del stack[n:], tags[n:]
        if hidden is not None and n <= hidden:
            hidden = None

    def closed_after(name: str, at: int) -> bool:
        if name not in last_end:
            last_end[name] = max((m.start() for m in re.finditer(rf"</{name}\b", html, re.I)), default=-1)
        return last_end[name] >= at

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at and hidden is None:
            text = unescape(html[at:lt])
            if not parts:
                path = tuple(stack)
            parts.append(text)
            if "a" in tags:
                links[0] += len(text)
        if lt == n:
            break
        m = _TAG.match(html, lt)
        if m is None:  # a bare "<" is text
            if hidden is None:
                if not parts:
                    path = tuple(stack)
                parts.append("<")
            at = lt + 1
            continue
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name in tags:
                k = len(tags) - 1 - tags[::-1].index(name)
                if hidden is not None and name not in HIDDEN and k < hidden:
                    pop_to(hidden)
                if name not in INLINE and name not in HIDDEN:
                    flush()
                pop_to(k)
            elif name not in INLINE and name not in HIDDEN:
                flush()
            continue
        attrs = m[3]
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if name in HIDDEN:
            if not attrs.endswith("/>") and closed_after(name, at):
                if hidden is None:
                    hidden = len(tags)
                stack.append(name)
                tags.append(name)
            continue
        if hidden is not None:
            if name not in VOID and not attrs.endswith("/>"):
                stack.append(name)
                tags.append(name)
            continue
        if name not in INLINE:
            flush()
            if name not in VOID and "p" in tags:  # a block start ends an open paragraph
                k = len(tags) - 1 - tags[::-1].index("p")
                if not SCOPE.intersection(tags[k + 1:]):
                    pop_to(k)
            for other in ENDS.get(name, ()):
                if other in tags:
                    k = len(tags) - 1 - tags[::-1].index(other)
                    if not SCOPE.intersection(tags[k + 1:]):
                        pop_to(k)
        if name in VOID or attrs.endswith("/>"):
            continue
        words = ""
        if "=" in attrs:
            words = " ".join(_NAME.findall(" ".join(x or y or z for x, y, z in _ATTR.findall(attrs)).lower()))
        stack.append(f"{name} {words}" if words else name)
        tags.append(name)
    flush()
    return out


def path_features(path: tuple[str, ...]) -> list[str]:
    """Features of the ancestors: every tag, the nearest ones, every attribute word."""
    found = {f"leaf={path[-1].split(' ')[0]}" if path else "leaf="}
    for entry in path:
        tag, _, words = entry.partition(" ")
        found.add(f"tag={tag}")
        found.update(f"name={w}" for w in words.split())
        found.update(f"start={w[:4]}" for w in words.split() if len(w) > 4)  # commentlist, adsense, cookies
        if words:
            found.add(f"names={words}")
    return sorted(found)


def text_features(block: Block, i: int, n: int) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    size = 0 if words <= 2 else 1 if words <= 6 else 2 if words <= 15 else 3 if words <= 40 else 4
    share = block.link / max(1, len(text))
    out = [f"words={size}", "links=" + ("0" if share == 0 else "1" if share < 0.5 else "2"),
           "end=" + ("stop" if text[-1] in ".!?:;…\"»”" else "word")]
    if "©" in text or "copyright" in text[:60].lower():
        out.append("copyright")
    if i == 0:
        out.append("first")
    if i == n - 1:
        out.append("last")
    return out


class Crf:
    """Weights of features and of neighbouring labels; label 1 is the article."""

    def __init__(self, names: dict[str, int], unary: np.ndarray, pair: np.ndarray, start: np.ndarray):
        self.names, self.unary, self.pair, self.start = names, unary, pair, start
        self._paths: dict[tuple[str, ...], tuple[float, float]] = {}

    def _sum(self, features: list[str]) -> tuple[float, float]:
        a = b = 0.0
        for f in features:
            k = self.names.get(f)
            if k is not None:
                a += self.unary[k, 0]
                b += self.unary[k, 1]
        return float(a), float(b)

    def decode(self, page: list[Block]) -> list[int]:
        """The most likely labels (Viterbi)."""
        if not page:
            return []
        (p00, p01), (p10, p11) = self.pair.tolist()
        back: list[tuple[int, int]] = []
        best = None
        for i, block in enumerate(page):
            base = self._paths.get(block.path)
            if base is None:
                if len(self._paths) > 50_000:  # a cache of computed sums, nothing else
                    self._paths.clear()
                base = self._paths[block.path] = self._sum(path_features(block.path))
            own = self._sum(text_features(block, i, len(page)))
            u0, u1 = base[0] + own[0], base[1] + own[1]
            if best is None:
                best = (float(self.start[0]) + u0, float(self.start[1]) + u1)
                continue
            a, b = best
            f0, f1 = int(b + p10 > a + p00), int(b + p11 > a + p01)
            back.append((f0, f1))
            best = ((b + p10 if f0 else a + p00) + u0, (b + p11 if f1 else a + p01) + u1)
        label = int(best[1] > best[0])
        labels = [label]
        for f in reversed(back):
            label = f[label]
            labels.append(label)
        return labels[::-1]

    def extract(self, html: str) -> str:
        page = blocks(html)
        return "\n".join(b.text for b, y in zip(page, self.decode(page)) if y)


def train(pages: list[tuple[list[Block], list[int]]], *, steps: int = 90, rate: float = 0.1,
          decay: float = 5e-5, least: int = 3) -> Crf:
    """Maximum likelihood by Adam over all pages at once; features seen ``least`` times count."""
    pages = [p for p in pages if p[0]]
    feats = [[path_features(b.path) + text_features(b, i, len(bs)) for i, b in enumerate(bs)] for bs, _ in pages]
    count: dict[str, int] = {}
    for page in feats:
        for fs in page:
            for f in fs:
                count[f] = count.get(f, 0) + 1
    names = {f: i for i, f in enumerate(sorted(f for f, c in count.items() if c >= least))}
    length = np.array([len(p) for p in feats])
    n_pages, longest = len(feats), int(length.max())
    row = np.array([r * longest + i for r, p in enumerate(feats) for i, fs in enumerate(p) for f in fs if f in names])
    col = np.array([names[f] for p in feats for fs in p for f in fs if f in names])
    mask = np.arange(longest)[None, :] < length[:, None]
    gold = np.zeros((n_pages, longest), int)
    for r, (_, ys) in enumerate(pages):
        gold[r, :len(ys)] = ys
    both = mask[:, 1:] & mask[:, :-1]
    p = {"u": np.zeros((len(names), 2)), "t": np.zeros((2, 2)), "s": np.zeros(2)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    onehot = np.eye(2)[gold] * mask[..., None]
    for step in range(1, steps + 1):
        unary = np.stack([np.bincount(row, p["u"][col, y], n_pages * longest) for y in (0, 1)], axis=1)
        unary = unary.reshape(n_pages, longest, 2)
        alpha = np.zeros_like(unary)
        alpha[:, 0] = unary[:, 0] + p["s"]
        for i in range(1, longest):
            a = np.logaddexp(alpha[:, i - 1, :1] + p["t"][0], alpha[:, i - 1, 1:] + p["t"][1]) + unary[:, i]
            alpha[:, i] = np.where(mask[:, i, None], a, alpha[:, i - 1])
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        beta = np.zeros_like(unary)
        for i in range(longest - 2, -1, -1):
            after = unary[:, i + 1] + beta[:, i + 1]
            b = np.logaddexp(p["t"][:, 0][None] + after[:, :1], p["t"][:, 1][None] + after[:, 1:])
            beta[:, i] = np.where(mask[:, i + 1, None], b, 0)
        node = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
        edge = (alpha[:, :-1, :, None] + p["t"] + (unary + beta)[:, 1:, None, :] - total[:, None, None, None])
        edge = np.exp(np.minimum(edge, 0)) * both[..., None, None]
        diff = (onehot - node).reshape(-1, 2)
        gu = np.stack([np.bincount(col, diff[row, y], len(names)) for y in (0, 1)], axis=1)
        seen = np.einsum("pia,pib->ab", onehot[:, :-1], onehot[:, 1:] * both[..., None])
        grad = {"u": gu / n_pages, "t": (seen - edge.sum(axis=(0, 1))) / n_pages,
                "s": (onehot[:, 0] - node[:, 0]).mean(axis=0)}
        for k, g in grad.items():
            g = g - decay * p[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] += rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Crf(names, p["u"], p["t"], p["s"])


# Usual names of page parts, for the labelled pages.
_PARTS: dict[str, tuple[str, ...]] = {
    "menu": ("menu", "nav", "navbar", "navigation", "main-menu", "topnav", "breadcrumb", "breadcrumbs", "toc",
             "pagination", "pager", "tabs", "site-nav", "navigation-bar", "menubar", "submenu", "skip-links"),
    "header": ("header", "site-header", "masthead", "top-bar", "banner", "branding", "logo", "page-header", "headerbar", "site-title", "tagline", "hero-banner"),
    "footer": ("footer", "site-footer", "bottom", "copyright", "colophon", "legal", "page-footer", "footnav", "disclaimer", "imprint", "credits"),
    "side": ("sidebar", "side", "aside", "widget", "related", "related-posts", "recommended", "trending", "rail",
             "popular", "tags", "author-box", "social", "share", "promo-box", "sidebar-widget", "related-articles",
             "share-buttons", "social-links", "recommendations", "most-read", "author-bio", "tag-list"),
    "notice": ("notice", "cookie", "cookie-banner", "consent", "alert", "gdpr", "popup", "modal", "message",
               "warning", "subscribe", "newsletter", "paywall", "overlay", "cookie-consent", "newsletter-signup",
               "announcement", "privacy", "signup", "login-box", "toast", "subscription"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner-ad", "ad-slot",
           "adsbox", "ad-container", "adsbygoogle", "google-ad", "advert-box", "sponsored-content", "dfp", "adunit"),
    "comments": ("comments", "comment", "comment-list", "reader-comments", "discussion", "responses", "disqus",
                 "replies", "user-comments", "comment-body", "commentlist", "comment-form", "disqus-thread", "feedback",
                 "reviews", "respond", "comment-text"),
}
_ARTICLE = ("content", "article", "post", "entry-content", "article-body", "main-content", "story", "post-body",
            "entry", "text", "body-text", "page-content", "article-content")
_SYLLABLES = ("ka lo mi ren ta su vel dor an qui est hom ber gri pla non ter ava ilo sen mar tin cor ule der "
              "fon wis hal tre eno").split()


def labelled_pages(n: int = 500, seed: int = 5) -> list[tuple[str, set[str]]]:
    """``(html, article texts)`` of ``n`` built pages; block texts within a page differ."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chance = lambda p: rng.random() < p

    def word() -> str:
        return "".join(pick(_SYLLABLES) for _ in range(int(rng.integers(1, 5))))

    def line(lo: int, hi: int) -> str:
        w = [word() for _ in range(int(rng.integers(lo, hi + 1)))]
        return " ".join(w).capitalize() + (pick([".", ".", ".", "!", "?", ":", ""]) if chance(0.8) else "")

    def named(kind: str, tag: str, inner: str) -> str:
        name = pick(_PARTS[kind])
        attr = pick([f' class="{name}"', f' id="{name}"', f' class="{word()} {name}"', f" class='{name} {word()}'"])
        return f"<{tag}{attr}>{inner}</{tag}>"

    def bare_or_named(kind: str, tag: str, inner: str) -> str:
        return f"<{tag}>{inner}</{tag}>" if chance(0.5) else named(kind, pick([tag, "div", "div", "section"]), inner)

    def few(make, lo: int, hi: int) -> str:
        return "".join(make() for _ in range(int(rng.integers(lo, hi + 1))))

    def item() -> str:
        return f'<li><a href="/{word()}">{line(1, 4)}</a></li>'

    def plain(lo: int = 2, hi: int = 25) -> str:
        return pick([f"<p>{line(lo, hi)}</p>", f"<div>{line(lo, hi)}</div>", line(lo, hi) + "<br>",
                     f"<span>{line(lo, hi)}</span><br>"])

    def menu() -> str:
        return bare_or_named("menu", "nav", f"<ul>{few(item, 2, 7)}</ul>")

    def header() -> str:
        return bare_or_named("header", "header", pick([f"<h1>{line(1, 5)}</h1>", plain(1, 6)]) + (menu() if chance(0.3) else ""))

    def footer() -> str:
        body = pick([f"&copy; {word()}.example.com &middot; {line(1, 12)}", plain(1, 12) + plain(1, 20),
                     f"<p>Copyright {line(2, 8)}</p><ul>{few(item, 1, 4)}</ul>"])
        return bare_or_named("footer", "footer", body)

    def side() -> str:
        return bare_or_named("side", "aside", f"<h3>{line(1, 4)}</h3>" + pick([f"<ul>{few(item, 2, 5)}</ul>", few(plain, 1, 3)]))

    def notice() -> str:
        return named("notice", pick(["div", "div", "section", "p", "aside"]), pick([line(4, 25), plain() + f"<button>{line(1, 2)}</button>"]))

    def ad() -> str:
        return named("ad", pick(["div", "div", "section", "aside", "p", "span"]), pick([line(1, 20), plain(), f'<a href="/x">{line(2, 9)}</a>']))

    def form() -> str:
        inner = (f"<label>{line(1, 4)}</label><input name=q>" + (f"<p>{line(2, 15)}</p>" if chance(0.5) else "")
                 + f"<button>{line(1, 2)}</button>")
        return f"<form>{inner}</form>" if chance(0.5) else f'<form class="{word()}" action="/s">{inner}</form>'

    def comments() -> str:
        one = lambda: pick([f"<p>{line(2, 40)}</p>", f"<li>{line(2, 40)}</li>", f'<div class="comment"><b>{word()}</b> {line(2, 30)}</div>'])
        return named("comments", pick(["div", "section", "ul", "ol", "aside"]), (f"<h3>{line(1, 3)}</h3>" if chance(0.6) else "") + few(one, 1, 6))

    junk = (menu, header, footer, side, notice, ad, form, comments)
    out = []
    for _ in range(n):
        keep: set[str] = set()

        def text(lo: int, hi: int) -> str:
            t = line(lo, hi)
            if chance(0.08):
                t = " ".join(f"{w}{pick(['***', '%%%', '$$$', '!!', ' |'])}" for w in t.split())
            keep.add(" ".join(t.split()))
            return t

        def para() -> str:
            lo, hi = pick([(1, 3), (4, 15), (15, 60), (15, 60), (40, 120)])
            kind = rng.random()
            if kind < 0.6:
                return f"<p>{text(lo, hi)}</p>"
            if kind < 0.68:
                return f"<p><b>{text(lo, hi)}<br>"
            if kind < 0.74:
                return f"<h2>{text(1, 8)}</h2><p>{text(lo, hi)}"
            if kind < 0.8:
                return "<ul>" + "".join(f"<li>{text(1, 15)}</li>" for _ in range(int(rng.integers(1, 5)))) + "</ul>"
            if kind < 0.86:
                return f"<blockquote><p>{text(lo, hi)}</p></blockquote>"
            if kind < 0.9:
                return f"<div>{text(lo, hi)}</div>"
            if kind < 0.94:
                return f"<table><tr><td>{text(1, 6)}</td><td>{text(1, 6)}</td></tr></table>"
            return f"<pre>{text(2, 30)}</pre>"

        body = [f"<h1>{text(1, 25)}</h1>"] if chance(0.85) else []
        for _ in range(int(rng.integers(1, 14))):
            body.append(para())
            if chance(0.12):
                body.append(pick((ad, ad, form, side, notice, notice, menu, footer, header, comments))())
        if chance(0.15):
            body.append(comments())
        name = pick(_ARTICLE)
        inner = "".join(body)
        shape = rng.random()
        if shape < 0.45:
            main = f"<article>{inner}</article>"
        elif shape < 0.55:
            main = f"<main>{inner}</main>"
        elif shape < 0.65:
            main = f'<main><article class="{name}">{inner}</article></main>'
        elif shape < 0.95:
            main = pick([f'<div class="{name}">{inner}</div>', f'<div id="{name}">{inner}</div>',
                         f'<section class="{name} {word()}">{inner}</section>'])
        else:
            main = f"<div>{inner}</div>"
        before = "".join(pick(junk[:7])() for _ in range(int(rng.integers(0, 5))))
        after = "".join(pick(junk[2:])() for _ in range(int(rng.integers(0, 5))))
        if chance(0.3):
            main = f'<div class="{pick(["wrapper", "container", "page", "site", word()])}">{main}{side() if chance(0.5) else ""}</div>'
        tail = "</body></html>" if chance(0.8) else ""
        out.append((f"<!DOCTYPE html><html><head><title>{line(1, 8)}</title><style>p{{}}</style></head><body>"
                    f"{before}{main}{after}{tail}", keep))
    return out


def label(html: str, article: set[str]) -> tuple[list[Block], list[int]]:
    page = blocks(html)
    return page, [int(b.text in article) for b in page]


def short_pages(n: int = 120, seed: int = 6) -> list[tuple[list[Block], list[int]]]:
    """Pages of an article and one or two other parts at most, cut out of built pages.

    The article is one to three of its blocks, often one only, in the element it stood in."""
    rng = np.random.default_rng(seed)
    out = []
    for html, article in labelled_pages(n, seed):
        page, gold = label(html, article)
        text = [b for b, y in zip(page, gold) if y]
        rest = [i for i, y in enumerate(gold) if not y]
        first = int(rng.integers(len(text)))
        keep = text[first:first + int(rng.choice([1, 1, 1, 2, 3]))]
        before = [page[i] for i in rest if i < gold.index(1)][:int(rng.choice([0, 0, 1, 2]))]
        after = [page[i] for i in rest if i > gold.index(1)][-1:] if rng.random() < 0.3 else []
        out.append((before + keep + after, [0] * len(before) + [1] * len(keep) + [0] * len(after)))
    return out


def trained(n: int = 900, seed: int = 5) -> Crf:
    """The CRF of the built labelled pages and of short ones."""
    return train([label(h, a) for h, a in labelled_pages(n, seed)] + short_pages())


def _extract(crf_b):
    def run(batches):
        crf: Crf = crf_b.value
        for batch in batches:
            texts = [crf.extract(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def extract_main_text(pages: DataFrame, crf: Crf | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; the CRF (a few hundred weights) is broadcast."""
    model = pages.sparkSession.sparkContext.broadcast(crf or trained())
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract(model), "page_id long, url string, text string, n_chars long")
