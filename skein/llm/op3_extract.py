"""Main-text extraction with a tree-structured graphical model over the DOM.

A page becomes a tree of its block elements with its text blocks as leaves
(inline markup is transparent; scripts, styles, templates and the head carry no
text).  Every node is content or not; a node's features score it by itself, and
potentials between parent and child tie labels along the tree.  Sum-product
messages upward and downward give each block's marginal; blocks that are more
likely content than not are the main text, in page order.

The model is trained on labelled pages: ``labelled_pages`` builds ``n`` pages
(a documented, bounded number) from layouts with known main text, varying tags,
class names, menus, adverts, notices, forms and reader comments; weights come
from exact gradients of the likelihood, since sum-product is exact on trees.

Defined results
* null or empty html, or no content: the empty string, 0 characters;
* html without markup is one block, and judged as one;
* unclosed and stray tags are repaired as browsers do for blocks (an open
  paragraph ends where the next block begins);
* repeated pages are extracted alike; an empty table gives no rows;
* pages of any length and any broken markup are parsed whole, in time linear in their
  length; other input columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import slices, table

#: Elements whose text is never shown or never prose.
SKIPPED = frozenset(("script", "style", "noscript", "template", "textarea", "select", "iframe", "svg", "math",
                     "object", "canvas", "head", "title", "button", "option", "audio", "video"))
#: Elements whose content is plain characters up to their end tag.
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
BLOCKS = ("body", "header", "nav", "main", "article", "section", "aside", "footer", "div", "form", "fieldset", "ul",
          "ol", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "p", "h1", "h2", "h3", "h4", "h5", "h6",
          "blockquote", "pre", "figure", "figcaption", "address", "details", "summary", "dialog", "menu", "center")
_BLOCK = frozenset(BLOCKS)
#: Elements that usually hold a text block themselves.
PROSE = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dt", "dd", "blockquote", "pre", "figcaption")
#: Starting one of these ends an open element of the set behind it.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
#: Elements that may stand in the head; any other start tag, or text, ends it.
_IN_HEAD = frozenset(("title", "meta", "link", "base", "basefont", "bgsound", "script", "style", "noscript", "template",
                      "head", "html", "noframes"))
_SCOPES = frozenset(("ul", "ol", "dl", "table", "body", "div", "article", "section"))
_NAME_END = re.compile(r"[\s/>]")
_QUOTE_OR_END = re.compile("[>\"']")
_LETTER = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Zeros in front of a numbered character reference, and numbers too large for any character.
_ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])")
_TOO_LARGE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{8,});?")
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")

#: Groups of words in class, id and role names.
NAMES = (
    ("ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion"),
    ("menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "tabs", "toc"),
    ("sidebar", "aside", "widget", "related", "recommended", "rail", "complementary", "more", "tags"),
    ("footer", "foot", "copyright", "legal", "bottom", "contentinfo"),
    ("header", "masthead", "topbar", "logo", "brand", "top"),
    ("cookie", "cookies", "notice", "alert", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "warning"),
    ("comment", "comments", "reply", "replies", "discussion", "disqus", "respond", "reader"),
    ("search", "login", "signup", "form", "contact", "poll"),
    ("share", "social", "follow", "author", "byline", "meta", "bio"),
    ("article", "content", "main", "post", "entry", "story", "text", "body", "prose", "page"),
)
_GROUP = {w: k for k, names in enumerate(NAMES) for w in names}
_TAG = {t: k for k, t in enumerate(BLOCKS)}
N_TAGS, N_NAMES = len(BLOCKS), len(NAMES)
#: bias, tag, names, is leaf, (leaf:) parent tag, words, link share, sentence, page share, depth
_LEAF = 1 + N_TAGS + N_NAMES
_PARENT = _LEAF + 1
_WORDS = _PARENT + N_TAGS
_LINKS = _WORDS + 6
_SENTENCE = _LINKS + 4
FEATURES = _SENTENCE + 4
EDGE_TYPES = 3  # to a container, to a text block, to an element that holds prose


class Page:
    """Flat tree: parents come before children; ``blocks`` holds (node, text)."""

    def __init__(self):
        self.parent: list[int] = [-1]
        self.depth: list[int] = [0]
        self.feats: list[list[int]] = [[0, 1 + _TAG["body"]]]
        self.blocks: list[tuple[int, str]] = []

    def add(self, parent: int, feats: list[int]) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.feats.append(feats)
        return len(self.parent) - 1


class Marks:
    """Tags, comments and declarations of a page, found in time linear in its length.

    A tag reaches to the first ``>`` outside quotes; one whose quote or end is missing is
    text.  What a search has found missing is remembered, so no stretch is searched
    again from every ``<`` before it: characters that don't come any more, and quotes from
    which no tag's end is reached.
    """

    def __init__(self, source: str):
        self.source = source
        self.gone = {c: len(source) + 1 for c in "\"'>"}
        self.dead: set[int] = set()
        self.names, self.signs = [0, -1], [0, -1]  # a searched stretch's begin and what stands at its end

    def _find(self, c: str, at: int) -> int:
        if at >= self.gone[c]:
            return -1
        k = self.source.find(c, at)
        if k < 0:
            self.gone[c] = at
        return k

    def _next(self, held: list[int], pattern: re.Pattern, at: int) -> int:
        """Where the pattern's next character stands; the page's length if none does."""
        if not held[0] <= at <= held[1]:
            m = pattern.search(self.source, at)
            held[:] = at, m.start() if m else len(self.source)
        return held[1]

    def _tag_end(self, at: int) -> int:
        seen = []
        while True:
            q = self._next(self.signs, _QUOTE_OR_END, at)
            if q == len(self.source) or q in self.dead:
                break
            if self.source[q] == ">":
                return q
            seen.append(q)
            closed = self._find(self.source[q], q + 1)
            if closed < 0:
                break
            at = closed + 1
        self.dead.update(seen)
        return -1

    def after(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """(start, end, is an end tag, name, attributes) of the next mark; no name if it isn't a tag."""
        source = self.source
        while True:
            at = source.find("<", at)
            if at < 0:
                return None
            sign = source[at + 1:at + 2]
            if sign in ("!", "?"):
                if source.startswith("<!--", at):
                    end = source.find("-->", at + 4)
                    return at, len(source) if end < 0 else end + 3, False, None, ""
                end = self._find(">", at + 2)
                if end >= 0:
                    return at, end + 1, False, None, ""
            else:
                first = at + 2 if sign == "/" else at + 1
                if source[first:first + 1] in _LETTER:
                    name = self._next(self.names, _NAME_END, first)
                    end = self._tag_end(name)
                    if end >= 0:
                        return at, end + 1, sign == "/", source[first:name].lower(), source[name:end]
            at += 1


class OpenTags:
    """A stack of tags that knows where each tag stands in it."""

    def __init__(self):
        self.tags: list[str] = []
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)

    def holds(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def last(self, tag: str) -> int:
        """Its highest place, -1 if it isn't there."""
        at = self.places.get(tag)
        return at[-1] if at else -1

    def cut(self, at: int) -> None:
        """Drop everything from a place on."""
        for tag in self.tags[at:]:
            self.places[tag].pop()
        del self.tags[at:]


def unescape(text: str) -> str:
    """Character references decoded; a number of any length, beyond all characters, is U+FFFD."""
    if "&#" in text:
        text = _TOO_LARGE.sub("\ufffd", _ZEROS.sub(r"&#\1", text))
    return entities.unescape(text)


def parse(source: str) -> Page:
    """The page's block tree."""
    page = Page()
    stack: list[tuple[str, int]] = [("body", 0)]  # open block elements
    held: list[str] = []  # pieces of the text block being read
    linked = [0, 0]  # characters inside links, open links
    opened = OpenTags()  # the same elements' tags
    opened.push("")
    skip = OpenTags()  # open elements without prose
    inner = OpenTags()  # block elements open inside those
    marks = Marks(source)
    ends: dict[str, int] = {}  # where the last end tag of a skipped element stands

    def never_closed(tag: str) -> bool:
        if tag not in ends:
            ends[tag] = max((m.start() for m in re.finditer(f"</{re.escape(tag)}(?![^\\s/>])", source, re.I)), default=-1)
        return ends[tag] < at

    def end_block() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            tag, node = stack[-1]
            leaf = page.add(node, _leaf_features(text, tag, linked[0]))
            page.blocks.append((leaf, text))
        linked[0] = 0

    def close(tags: set[str], scopes: frozenset[str] = frozenset()) -> None:
        """Close the nearest open element of ``tags`` unless a scope stands before it."""
        k = max(map(opened.last, tags))
        if k > 0 and all(opened.last(t) <= k for t in scopes):
            end_block()
            opened.cut(k)
            del stack[k:]

    def leave_skipped() -> None:
        skip.cut(0)
        inner.cut(0)

    at = 0
    while True:
        m = marks.after(at)
        piece = source[at:m[0]] if m else source[at:]
        if skip.tags == ["head"] and piece.strip():
            skip.cut(0)
        if piece and not skip.tags:
            held.append(piece)
            if linked[1]:
                linked[0] += len(piece.strip())
        if not m:
            break
        _, at, closing, tag, attributes = m
        if tag is None:
            continue
        if skip.tags == ["head"] and not closing and tag not in _IN_HEAD:
            skip.cut(0)
        if tag in SKIPPED:
            if closing:
                if skip.holds(tag):
                    skip.cut(skip.places[tag][0])
                    if not skip.tags:
                        leave_skipped()
            elif not attributes.endswith("/"):
                if tag in RAW:
                    stop = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(source, at)
                    at = stop.end() if stop else len(source)
                    if not skip.tags and tag not in ("script", "style", "noscript"):
                        end_block()
                else:
                    skip.push(tag)
            continue
        if skip.tags:
            if tag == "body" and not closing:
                skip.cut(0)
            elif tag not in _BLOCK or skip.tags[0] == "head":
                continue
            elif closing and inner.holds(tag):
                inner.cut(inner.last(tag))
                continue
            elif not inner.tags and any(skip.holds(t) and never_closed(t) for t in SKIPPED):
                # The outermost element without an end tag ends with the line it stands in.
                skip.cut(min(skip.places[t][0] for t in SKIPPED if skip.holds(t) and never_closed(t)))
            elif closing and opened.holds(tag):
                skip.cut(0)
            if skip.tags:
                if not closing:
                    inner.push(tag)
                continue
            leave_skipped()
        if tag in ("br", "hr", "img", "input") or tag in VOID:
            held.append(" ")
        elif tag == "a":
            linked[1] = 0 if closing else 1
        elif tag in _BLOCK:
            if closing:
                if opened.holds(tag):
                    close({tag})
                else:
                    end_block()
            elif tag != "body":
                close({"p"}, _SCOPES - {"p"})
                if tag in _ENDS:
                    close(_ENDS[tag], frozenset(("ul", "ol", "dl", "table")))
                end_block()
                node = page.add(stack[-1][1], _element_features(tag, attributes))
                opened.push(tag)
                stack.append((tag, node))
    end_block()
    return page


def _element_features(tag: str, attributes: str) -> list[int]:
    names = " ".join("".join(g) for g in _ATTR.findall(attributes)).lower()
    groups = {_GROUP[w] for w in _NAME.findall(names) if w in _GROUP}
    return [0, 1 + _TAG[tag], *(1 + N_TAGS + g for g in groups)]


def _leaf_features(text: str, parent: str, in_links: int) -> list[int]:
    words, share = text.count(" ") + 1, in_links / max(1, len(text))
    f = [0, _LEAF, _PARENT + _TAG[parent],
         _WORDS + (words > 2) + (words > 5) + (words > 12) + (words > 30) + (words > 80),
         _LINKS + (share > 0.05) + (share > 0.4) + (share > 0.8)]
    end = text.rstrip("\"')»”")
    f.append(_SENTENCE + (1 if end.endswith((".", "!", "?", "…", "。")) else 0) + 2 * (words > 5))
    return f


class Forest:
    """Many pages as one set of arrays, nodes grouped by depth."""

    def __init__(self, pages: list[Page]):
        starts = np.cumsum([0] + [len(p.parent) for p in pages])
        self.starts = starts
        self.parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + s)
                                      for p, s in zip(pages, starts)]) if pages else np.zeros(0, int)
        depth = np.concatenate([np.array(p.depth) for p in pages]) if pages else np.zeros(0, int)
        feats = [f for p in pages for f in p.feats]
        self.rows = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
        self.cols = np.array([x for f in feats for x in f], dtype=int)
        self.kind = np.zeros(len(feats), dtype=int)
        prose = np.isin(self.cols - 1, [_TAG[t] for t in PROSE])
        self.kind[self.rows[prose]] = 2
        self.kind[self.rows[self.cols == _LEAF]] = 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1))) if len(depth) else []

    def unary(self, weights: np.ndarray) -> np.ndarray:
        """(nodes, 2) scores: 0 for not content, the features' sum for content."""
        n = len(self.kind)
        return np.stack([np.zeros(n), np.bincount(self.rows, weights[self.cols], n)], axis=1)


def _lse(x: np.ndarray) -> np.ndarray:
    top = x.max(-1)
    return top + np.log(np.exp(x - top[..., None]).sum(-1))


def sum_product(f: Forest, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact marginals: node (n, 2), and (n, 2, 2) over (parent's label, own label).

    Upward: each node's message to its parent; downward: the parent's belief
    without that message, passed back.
    """
    n = len(unary)
    up = unary.copy()  # own score and the children's messages
    msg = np.zeros((n, 2))
    for level in reversed(f.levels[1:]):
        w = pair[f.kind[level]]
        msg[level] = _lse(up[level][:, None, :] + w)
        np.add.at(up, f.parent[level], msg[level])
    belief = up.copy()
    both = np.zeros((n, 2, 2))
    for level in f.levels[1:]:
        w = pair[f.kind[level]]
        rest = belief[f.parent[level]] - msg[level]
        joint = rest[:, :, None] + w + up[level][:, None, :]
        belief[level] = _lse(joint.transpose(0, 2, 1))
        both[level] = np.exp(joint - _lse(joint.reshape(len(level), 4))[:, None, None])
    return np.exp(belief - _lse(belief)[:, None]), both


class TreeModel:
    """Feature weights and the potentials between parent and child labels."""

    def __init__(self, weights: np.ndarray, pair: np.ndarray):
        self.weights, self.pair = weights, pair

    def marginals(self, f: Forest) -> np.ndarray:
        return sum_product(f, f.unary(self.weights), self.pair)[0][:, 1]


def fit(pages: list[Page], labels: list[list[int]], steps: int = 250, rate: float = 0.3, l2: float = 2e-4) -> TreeModel:
    """Maximum likelihood by gradient ascent with adaptive steps; exact expectations."""
    f = Forest(pages)
    y = np.concatenate([np.array(x) for x in labels])
    weights, pair = np.zeros(FEATURES), np.zeros((EDGE_TYPES, 2, 2))
    child = np.flatnonzero(f.parent >= 0)
    seen_w = np.zeros(FEATURES)
    np.add.at(seen_w, f.cols, y[f.rows].astype(float))
    seen_p = np.zeros_like(pair)
    np.add.at(seen_p, (f.kind[child], y[f.parent[child]], y[child]), 1)
    g_w, g_p, n = np.full(FEATURES, 1e-8), np.full_like(pair, 1e-8), len(y)
    for _ in range(steps):
        node, both = sum_product(f, f.unary(weights), pair)
        d_w = (seen_w - np.bincount(f.cols, node[f.rows, 1], FEATURES)) / n - l2 * weights
        d_p = seen_p.copy()
        np.subtract.at(d_p, f.kind[child], both[child])
        d_p = d_p / n - l2 * pair
        g_w += d_w ** 2
        g_p += d_p ** 2
        weights += rate * d_w / np.sqrt(g_w)
        pair += rate * d_p / np.sqrt(g_p)
    return TreeModel(weights, pair)


# --- labelled pages -------------------------------------------------------------------


def labelled_pages(n: int = 600, seed: int = 11) -> list[tuple[str, list[str]]]:
    """``n`` pages of varied layout with the text blocks of their main text."""
    r = random.Random(seed)
    syllables = ["ra", "to", "min", "el", "sha", "ver", "ing", "po", "que", "den", "li", "ost", "an", "tur", "be"]

    def word() -> str:
        return "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))

    def words(lo: int, hi: int) -> str:
        return " ".join(word() for _ in range(r.randint(lo, hi))).capitalize()

    def sentence(lo: int = 3, hi: int = 14) -> str:
        return words(lo, hi) + r.choice([".", ".", ".", "!", "?"])

    def prose(short: bool = False) -> str:
        if short:
            return words(1, 3) + r.choice([".", "", "###", ".***"])
        out = " ".join(sentence() for _ in range(r.choice([1, 1, 2, 3, 5, 9, 20])))
        return out if r.random() > 0.08 else words(1, 4) + r.choice([".", ""])

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(k))

    def named(group: int) -> str:
        return f'{r.choice(["class", "class", "id"])}="{r.choice(NAMES[group])}{r.choice(["", "-box", " wide", "-1"])}"'

    def menu() -> str:
        inner = f"<ul>{links(r.randint(2, 8))}</ul>"
        return r.choice([f"<nav>{inner}</nav>", f"<div {named(1)}>{inner}</div>", f"<ul {named(1)}>{links(5)}</ul>",
                         f"<header>{inner}</header>", f"<nav>{inner}<p>{words(1, 5)}</p></nav>"])

    def boiler() -> str:
        kind = r.randrange(9)
        text = prose()
        if kind == 0:
            return r.choice([f"<div {named(0)}>{text}</div>", f"<div {named(0)}><p>{text}</p></div>",
                             f'<aside {named(0)}><a href="/x">{text}</a></aside>'])
        if kind == 1:
            return menu()
        if kind == 2:
            return r.choice([f"<aside><h3>{words(1, 3)}</h3><ul>{links(4)}</ul></aside>", f"<aside><p>{text}</p></aside>",
                             f"<div {named(2)}><h4>{words(1, 3)}</h4><p>{text}</p></div>"])
        if kind == 3:
            return f"<div {named(5)}><p>{text}</p><button>{word()}</button></div>"
        if kind == 4:
            return f'<form action="/s" {r.choice(["", named(7)])}><label>{words(1, 3)}</label><input name="q"><p>{text}</p><button>Ok</button></form>'
        if kind == 5:
            said = "".join(r.choice([f'<div class="comment"><b>{word()}</b><p>{prose()}</p></div>', f"<li><p>{prose()}</p></li>",
                                     f'<article class="comment"><p>{prose()}</p></article>'])
                           for _ in range(r.randint(1, 4)))
            return r.choice([f"<section {named(6)}><h2>{words(1, 2)}</h2>{said}</section>", f"<div {named(6)}>{said}</div>",
                             f"<ol {named(6)}>{said}</ol>"])
        if kind == 6:
            return f"<div {named(8)}>{links(3)}</div>"
        if kind == 7:
            return r.choice([f"<script>var t='<p>{word()}</p>';</script>", f"<style>p{{margin:0}}</style><!-- {text} -->"])
        return f"<div><ul>{links(r.randint(3, 6))}</ul></div>"

    def header() -> str:
        return r.choice([f"<header><h1>{words(1, 3)}</h1><p>{words(2, 7)}</p></header>", f"<div {named(4)}>{words(1, 4)}</div>",
                         f"<header>{menu()}<span>{words(1, 3)}</span></header>", ""])

    def footer() -> str:
        text = r.choice([f"&copy; {word()} &middot; {sentence()}", prose(), f'<a href="/a">{words(1, 2)}</a> {word()}'])
        return r.choice([f"<footer>{text}</footer>", f"<footer><p>{text}</p></footer>", f"<div {named(3)}>{text}</div>"])

    def content() -> tuple[str, list[str]]:
        out, blocks = [], []
        short = r.random() < 0.15

        def put(shape: str, text: str) -> None:
            inline = text
            if r.random() < 0.2 and " " in text:
                first, rest = text.split(" ", 1)
                inline = r.choice([f"<b>{first}</b> {rest}", f'<a href="/{first}">{first}</a> {rest}', f"<em>{first} {rest}</em>"])
            out.append(shape.format(inline))
            blocks.append(text)

        if r.random() < 0.75:
            put(r.choice(["<h1>{}</h1>", "<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>"]), words(1, 3) if short else words(2, 9))
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 10])):
            shape = r.random()
            if shape < 0.72:
                put("<p>{}</p>" if r.random() < 0.85 else "<p>{}<br>", prose(short))
            elif shape < 0.8:
                put(r.choice(["<h2>{}</h2>", "<h3>{}</h3>"]), words(1, 6))
            elif shape < 0.87:
                items = [sentence(2, 10) for _ in range(r.randint(2, 4))]
                out.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
                blocks.extend(items)
            elif shape < 0.92:
                put("<blockquote><p>{}</p></blockquote>", prose())
            elif shape < 0.96:
                cells = [word() for _ in range(4)]
                out.append(f"<table><tr><td>{cells[0]}</td><td>{cells[1]}</td></tr><tr><td>{cells[2]}</td><td>{cells[3]}</td></tr></table>")
                blocks.extend(cells)
            else:
                put("<pre>{}</pre>", prose())
            if r.random() < 0.05:
                out.append(f"<div {named(0)}>{prose()}</div>")
        return "".join(out), blocks

    pages = []
    for _ in range(n):
        inner, blocks = content()
        shape = r.random()
        if shape < 0.4:
            middle = f"<article>{inner}</article>"
        elif shape < 0.55:
            middle = f"<main>{r.choice([inner, f'<article>{inner}</article>', f'<div>{inner}</div>'])}</main>"
        elif shape < 0.85:
            middle = f"<div {named(9)}>{inner}</div>"
        elif shape < 0.93:
            middle = f"<div>{inner}</div>"
        else:
            middle = inner
        before = "".join([header(), *(boiler() for _ in range(r.randint(0, 2)))])
        after = "".join([*(boiler() for _ in range(r.randint(0, 3))), footer()])
        if r.random() < 0.3:
            middle = f"<div>{middle}{boiler()}</div>"
        pages.append((f"<!DOCTYPE html><html><head><title>{words(2, 5)}</title></head><body>{before}{middle}{after}</body></html>",
                      blocks))
    return pages


def node_labels(page: Page, blocks: list[str]) -> list[int]:
    """Labels of a labelled page's nodes: its main blocks, and the elements holding mostly those."""
    want = list(blocks)
    labels = [0] * len(page.parent)
    length, inside = [0] * len(labels), [0] * len(labels)
    at = 0
    for node, text in page.blocks:
        length[node] = len(text)
        if at < len(want) and text == want[at]:
            labels[node], at = 1, at + 1
            inside[node] = len(text)
    for node in range(len(labels) - 1, 0, -1):
        length[page.parent[node]] += length[node]
        inside[page.parent[node]] += inside[node]
    leaves = {node for node, _ in page.blocks}
    return [labels[k] if k in leaves else int(2 * inside[k] > length[k]) for k in range(len(labels))]


def train(n: int = 600, seed: int = 11) -> TreeModel:
    """The model of ``n`` labelled pages."""
    pages = [(parse(h), blocks) for h, blocks in labelled_pages(n, seed)]
    return fit([p for p, _ in pages], [node_labels(p, b) for p, b in pages])


def extract_texts(sources: list[str | None], model: TreeModel) -> list[str]:
    """Main text of each page."""
    pages = [parse(s or "") for s in sources]
    f = Forest(pages)
    p = model.marginals(f) if pages else np.zeros(0)
    return ["\n\n".join(text for node, text in page.blocks if p[at + node] >= 0.5)
            for page, at in zip(pages, f.starts)]


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every page (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 128):
            texts = extract_texts(part.column(2).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
