"""Main-text extraction: boosted trees over DOM nodes, decoded as a tree.

A page is cut into tags and texts by one linear scan, which builds block
elements and text blocks (runs of text and inline markup).  Trees score every
node by its subtree's density, attribute tokens, depth, ancestors and
siblings.  Decoding picks the most probable labelling in which no node is
kept under a dropped one: a node's gain is its log-odds plus its children's
positive gains, and only a node with positive gain under a kept parent is
kept.  A text that is all its parent holds goes with its parent, and plain
elements without a name under one parent share their mean log-odds.  The kept text
blocks, in page order, are the main text.

Attribute tokens are learned: whole class words, ids and roles, and the first,
last and middle parts of compound words; a vocabulary of those that tell most
about the label is picked from the training nodes, each with its log-odds.  A
word that is not in it counts by its parts.  Attributes of ``html`` and
``body`` say nothing about a node and are left out.

Training uses a bounded sample of the pages that have exactly one ``article``
or ``main`` element: they label their own nodes.  Copies of them, and pages
made of the sample's texts, teach what one template does not show: the element
renamed to other containers, or none; class words of every kind on kept nodes
(``has-sidebar``, ``share-post``); menus, side bars, notices with and without
telling names, forms, reader comments and related links around and inside it.
A table without self-labelled pages is learned from the made pages alone.

Defined results: a null or empty page, or one without kept blocks, has the
empty text; broken or cut-off markup is read as far as it goes (an element that is
passed over but has no end tag ends at the first block element inside it);
repeated rows are treated alike; nesting depth costs no recursion.  Extra
columns are passed by.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boost
from .common import column, slices, task

SAMPLE_PAGES = 300
SAMPLE_CHARS = 60_000
#: Pages made of the sample's texts, and attribute tokens that are kept.
MADE_PAGES = 1200
VOCABULARY = 400

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|"
    # a quote opens a value only right behind "="; elsewhere it is a character like any other
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++)?)*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?",
    re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_NAME_PART = re.compile(r"[a-z0-9]+")

# Element names by what they are, and attribute tokens.
_TO_END = frozenset("script style textarea".split())
_RAW = _TO_END | frozenset("noscript template svg math iframe object canvas audio video select head".split())
_IN_HEAD = frozenset("base basefont bgsound link meta title".split())
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre section summary table tbody td "
                    "tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                    "strike strong sub sup time tt u var".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_KINDS = ("article", "main", "section", "div", "p", "li", "ul", "nav", "aside", "header", "footer", "form", "table",
          "blockquote", "body", "html")
class Page:
    """Block elements and text blocks in page order; parents come first."""

    def __init__(self) -> None:
        self.tag, self.parent, self.tokens, self.mark = ["#page"], [-1], [()], [None]
        self.text: list[str | None] = [None]
        self.links = [0]

    def add(self, tag: str, parent: int, tokens=(), mark=None, text=None, links=0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.tokens.append(tokens)
        self.mark.append(mark)
        self.text.append(text)
        self.links.append(links)
        return len(self.tag) - 1


def _end_tag(name: str, source: str, at: int) -> int:
    """Place of the next end tag of ``name``, or the end of the page."""
    stop = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(source, at)
    return stop.start() if stop else len(source)


def _raw_ends(source: str) -> dict[int, int]:
    """Where each raw element but scripts, styles and text areas ends, by the
    place after its start tag: at its own end tag; without one at the first
    block element inside, or else where an element around it ends.  A head
    also ends at the body and at all that cannot stand in a head."""
    ends: dict[int, int] = {}
    stack, raw, open_count = [], [], {}          # [name, place after the start tag of a raw one, first block inside]
    at, end = 0, len(source)

    def close(name: str, place: int) -> None:
        """Close open elements up to the nearest ``name``."""
        while True:
            was, start, first = stack.pop()
            open_count[was] -= 1
            if start:
                raw.pop()
                ends[start] = place if was == name or not first else first
                if first and was != name and raw:
                    raw[-1][2] = raw[-1][2] or first
            if was == name:
                return

    while at < end:
        lt = source.find("<", at)
        if raw and raw[-1][0] == "head" and source[at: lt if lt >= 0 else end].strip():
            close("head", at)
        if lt < 0:
            break
        m = _MARKUP.match(source, lt)
        if m is None:
            if raw and raw[-1][0] == "head":
                close("head", lt)
            at = lt + 1
            continue
        at = m.end()
        ending, name, rest = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not name:
            continue
        name = name.lower()
        if name in _TO_END:
            if not ending and not rest.endswith("/"):
                at = _end_tag(name, source, at)
            continue
        if ending:
            if open_count.get(name):
                close(name, lt)
            continue
        if open_count.get("head") and (name == "body" or raw[-1][0] == "head" and name not in _RAW | _IN_HEAD
                                       or raw[-1][0] == "title" and name in _BLOCKS):
            close("head", lt)
        if name in _RAW or name == "title" and raw and raw[-1][0] == "head":
            if rest.endswith("/"):
                continue
            stack.append([name, at, 0])
            raw.append(stack[-1])
        elif name in _VOID or name in _INLINE:
            continue
        else:
            if raw and name in _BLOCKS:
                raw[-1][2] = raw[-1][2] or lt
            stack.append([name, 0, 0])
        open_count[name] = open_count.get(name, 0) + 1
    while stack:
        name, start, first = stack.pop()
        if start:
            raw.pop()
            ends[start] = first or end
            if raw:
                raw[-1][2] = raw[-1][2] or first
    return ends


def parse(source: str) -> Page:
    """The blocks of one page, in time linear in its length."""
    page, stack, open_count = Page(), [0], {}
    raw_ends = _raw_ends(source)
    run: list[str] = []
    linked, in_link = 0, 0
    at, end = 0, len(source)

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                page.add("#text", stack[-1], text=text, links=min(linked, len(text)))
            run.clear()
            linked = 0

    def close(names) -> None:
        """Close open elements up to the nearest of ``names``."""
        if any(open_count.get(n) for n in names):
            while len(stack) > 1:
                name = page.tag[stack.pop()]
                open_count[name] -= 1
                if name in names:
                    break

    def words(piece: str) -> None:
        nonlocal linked
        text = entities.unescape(piece) if "&" in piece else piece
        run.append(text)
        if in_link:
            linked += len(text)

    while at < end:
        lt = source.find("<", at)
        if lt < 0:
            words(source[at:])
            break
        if lt > at:
            words(source[at:lt])
        m = _MARKUP.match(source, lt)
        if m is None:                                   # a lone "<" is text
            words("<")
            at = lt + 1
            continue
        at = m.end()
        ending, name, rest = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not name:
            continue
        name = name.lower()
        if name in _RAW:
            if not ending and not rest.endswith("/"):
                at = _end_tag(name, source, at) if name in _TO_END else raw_ends.get(at, at)
            continue
        if name == "br" or name == "hr":
            run.append(" ")
            continue
        if name in _VOID:
            continue
        if name in _INLINE:
            if name == "a":
                in_link = 0 if ending else 1
            continue
        flush()
        if ending:
            close((name,))
            continue
        in_link = 0
        if open_count.get("p"):
            while page.tag[stack[-1]] == "p":           # a block ends an open paragraph
                stack.pop()
                open_count["p"] -= 1
        if name in _CLOSES and page.tag[stack[-1]] in _CLOSES[name]:
            open_count[page.tag[stack.pop()]] -= 1
        tokens, mark = (), None
        if rest:
            for key, *value in _ATTRIBUTE.findall(rest):
                key, value = key.lower(), "".join(value)
                if key == "data-y":
                    mark = value
                elif name == "html" or name == "body":
                    continue
                elif key == "class" or key == "id":
                    tokens += tuple(value.lower().split())
                elif key == "role":
                    tokens += tuple("role:" + v for v in value.lower().split())
        stack.append(page.add(name, stack[-1], tokens, mark))
        open_count[name] = open_count.get(name, 0) + 1
    flush()
    return page


# ---------------------------------------------------------------- features

def word_tokens(word: str) -> tuple[str, ...]:
    """A class word, and the parts of a compound one by their place."""
    parts = _NAME_PART.findall(word)
    if len(parts) < 2:
        return ("=" + word,)
    return ("=" + word, "<" + parts[0], ">" + parts[-1], *("~" + p for p in parts[1:-1]))


def vocabulary(pages: list[Page], y: list[np.ndarray]) -> dict[str, float]:
    """The ``VOCABULARY`` tokens that tell most about the label, with the
    log-odds of being dropped of a node that has one."""
    count: dict[str, list[float]] = {}
    total = [0, 0]
    for page, label in zip(pages, y):
        for tokens, kept in zip(page.tokens, label):
            total[int(kept)] += 1
            for t in {t for w in tokens for t in word_tokens(w)}:
                count.setdefault(t, [0, 0])[int(kept)] += 1

    def entropy(a, b):
        p = np.array([a, b]) / max(a + b, 1)
        return -(p[p > 0] * np.log(p[p > 0])).sum() * (a + b)

    gain = {t: entropy(*total) - entropy(*c) - entropy(total[0] - c[0], total[1] - c[1]) for t, c in count.items() if sum(c) >= 3}
    best = sorted(gain, key=lambda t: (-gain[t], t))[:VOCABULARY]
    return {t: float(np.log((count[t][0] + 0.5) / (total[0] + 1)) - np.log((count[t][1] + 0.5) / (total[1] + 1))) for t in best}


def _word_weight(word: str, weights: dict[str, float]) -> float:
    """The weight of a known word, or else of its known parts."""
    whole, *parts = word_tokens(word)
    if whole in weights:
        return weights[whole]
    return sum(weights.get(p, 0.0) for p in parts)


def features(page: Page, weights: dict[str, float]) -> np.ndarray:
    """(nodes, features); whole-subtree figures by one pass from the leaves."""
    n = len(page.tag)
    parent = np.array(page.parent)
    chars, links, commas, stops, digits, texts, kids = (np.zeros(n) for _ in range(7))
    for i, t in enumerate(page.text):
        if t is not None:
            chars[i], links[i], texts[i] = len(t), page.links[i], 1
            commas[i], stops[i] = t.count(","), t.count(".") + t.count("!") + t.count("?")
            digits[i] = t.count("©") + t.count("|") + t.count("·")
    nodes, items = np.ones(n), np.zeros(n)
    items[[i for i, t in enumerate(page.tag) if t == "li"]] = 1
    own_chars = chars.copy()
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        commas[p] += commas[i]
        stops[p] += stops[i]
        digits[p] += digits[i]
        texts[p] += texts[i]
        nodes[p] += nodes[i]
        items[p] += items[i]
        kids[p] += 1
    depth, above = np.zeros(n), np.zeros((n, 7))
    own, near, path = np.zeros((n, 4)), np.zeros((n, 3)), np.zeros(n)      # learned word weights: here, nearest named ancestor, all
    slot = {"article": 0, "main": 0, "nav": 1, "aside": 2, "header": 3, "footer": 4, "form": 5, "li": 6}
    kind = np.full(n, len(_KINDS))
    known: dict[str, float] = {}
    before = np.zeros(n)                             # text before the node, as a share of the page
    seen = 0.0
    for i in range(n):
        tag, tok = page.tag[i], page.tokens[i]
        if tok:
            w = []
            for t in tok:
                if t not in known:
                    known[t] = _word_weight(t, weights)
                w.append(known[t])
            if tag == "article" or tag == "main":        # such a name says more than any class word against it
                w = [min(x, 0.0) for x in w]
            own[i] = max(w), min(w), sum(w), len(w)
        if tag in _KINDS:
            kind[i] = _KINDS.index(tag)
        elif tag in _HEADINGS:
            kind[i] = len(_KINDS) + 1
        elif tag == "#text":
            kind[i] = len(_KINDS) + 2
        before[i] = seen
        seen += own_chars[i]
        if i:
            p = parent[i]
            depth[i] = depth[p] + 1
            near[i] = own[p, :3] if own[p, 3] else near[p]
            path[i] = max(path[p], own[p, 2])
            above[i] = above[p]
        if tag in slot:
            above[i, slot[tag]] = 1
    sib_chars, sib_links, sib_n = chars[parent], links[parent], kids[parent]
    sib_chars[0], sib_links[0], sib_n[0] = chars[0], links[0], 1
    total = max(chars[0], 1.0)
    size = np.maximum(chars, 1.0)
    named = np.zeros((n, 5))
    for j, k in enumerate(("nav", "aside", "header", "footer", "form")):
        named[:, j] = kind == _KINDS.index(k)
    return np.column_stack([
        kind, np.log1p(chars), links / size, nodes / size * 100, commas / size * 100, stops / size * 100, digits / size * 100,
        chars / np.maximum(texts, 1), texts, kids, items / np.maximum(nodes, 1), depth, own, near, path, above,
        chars / total, before / total, chars / np.maximum(sib_chars, 1), sib_links / np.maximum(sib_chars, 1), sib_n,
        np.log1p(sib_chars), named, (kind <= 1).astype(float)])


def joined(page: Page) -> np.ndarray:
    """Texts that go with their parent: it holds nothing but text."""
    parent, text = np.array(page.parent), np.array([t == "#text" for t in page.tag])
    mixed = np.zeros(len(text), dtype=bool)
    mixed[parent[1:][~text[1:]]] = True
    return text & ~mixed[parent] & (parent > 0)


#: Fixed value: elements that carry text and say nothing else.
_PLAIN = _HEADINGS | frozenset("p ul ol li dl dt dd blockquote pre table tbody tr td th figure #text".split())


def levelled(page: Page, odds: np.ndarray) -> np.ndarray:
    """Plain elements without a name, children of one parent, are told apart
    by nothing but chance: each gets their mean, weighted by text."""
    plain = np.array([t in _PLAIN and not page.tokens[i] for i, t in enumerate(page.tag)])
    plain[0] = False
    size = np.array([1.0 + len(t or "") for t in page.text])
    for i in range(len(size) - 1, 0, -1):
        size[page.parent[i]] += size[i]
    parent = np.array(page.parent)[plain]
    total, weight = np.zeros(len(odds)), np.zeros(len(odds))
    np.add.at(total, parent, (odds * size)[plain])
    np.add.at(weight, parent, size[plain])
    out = odds.copy()
    out[plain] = total[parent] / weight[parent]
    return out


def keep(page: Page, odds: np.ndarray) -> np.ndarray:
    """The most probable labelling without a kept node under a dropped one."""
    gain = odds.copy()
    for i in range(len(gain) - 1, 0, -1):
        if gain[i] > 0:
            gain[page.parent[i]] += gain[i]
    kept = np.zeros(len(gain), dtype=bool)
    kept[0] = True
    for i in range(1, len(gain)):
        kept[i] = kept[page.parent[i]] and gain[i] > 0
    return kept


def decided(page: Page, odds: np.ndarray) -> np.ndarray:
    """The trees' log-odds, levelled, with joined texts left to their parents."""
    out = levelled(page, odds)
    out[joined(page)] = 1e-3
    return out


def written(page: Page, kept: np.ndarray) -> str:
    return " ".join(t for t, k in zip(page.text, kept) if t is not None and k)


# ---------------------------------------------------------------- training

_MAIN_OPEN = re.compile(r"<(article|main)\b([^>]*)>", re.I)
# Fixed values of the made pages: words that name main containers, words that
# name boilerplate, and what either kind of name is compounded with.
_CONTENT_WORDS = "content article post entry story body main text page single blog news hentry prose".split()
_OTHER_WORDS = ("ad ads advert advertisement banner promo sponsor sponsored nav navigation menu sidebar aside footer header masthead "
                "comment comments reply replies discussion share social related recommended cookie consent notice alert warning "
                "popup modal newsletter subscribe signup widget breadcrumb breadcrumbs pagination legal copyright login search "
                "toolbar disclaimer").split()
_STATES = ("has-{0}", "no-{0}", "with-{0}", "is-{0}", "{0}-open", "{0}-closed", "{0}-post", "{0}-enabled", "{0}-on", "content-{0}", "post-{0}")
_PLACES = ("site-{0}", "page-{0}", "{0}-list", "{0}-box", "{0}-wrapper", "{0}-left", "{0}-area", "top-{0}", "main-{0}", "{0}-block", "{0}-inner")


_SENTENCES = ["A plain sentence of text, as there are many.", "Another one follows it, but it is longer, and goes on for a while.",
              "Some more words, and then it ends.", "What came of it was told in the next chapter."]


class _Maker:
    """Training pages by rule: every draw follows from the seed."""

    def __init__(self, seed: int, sentences: list[str]):
        self.seed, self.sentences = seed, sentences

    def pick(self, n: int) -> int:
        self.seed = xxhash.xxh64_intdigest(self.seed.to_bytes(8, "little"), 7)
        return self.seed % n

    def one(self, items):
        return items[self.pick(len(items))]

    def s(self) -> str:
        return self.one(self.sentences)

    def neutral(self) -> str:
        """A word that says nothing."""
        return self.one("abcdeghlmrstxz") + self.one(("", "x", "ol", "row", "css", "elem")) + str(self.pick(100))

    def kept_words(self, any_word: bool) -> str:
        """Class words of a kept container; on an element whose own name says
        what it is (``any_word``) they may be any."""
        kind = self.pick(10)
        state = self.one(_STATES).format(self.one(_OTHER_WORDS))
        if any_word and kind < 4:
            return self.one((state, self.one(_OTHER_WORDS), f"{self.one(_CONTENT_WORDS)} {self.one(_OTHER_WORDS)}"))
        if kind < 5:
            return self.one((self.one(_CONTENT_WORDS), f"{self.one(_CONTENT_WORDS)}-{self.one(('body', 'inner', 'area', 'wrap', 'text'))}"))
        if kind < 7:
            return self.neutral()
        return self.one((f"{self.one(_CONTENT_WORDS)} {state}", f"{self.neutral()} {state}", state))

    def attribute(self, words: str) -> str:
        return "" if not words else self.one((f' class="{words}"', f' class="{words}"', f" class='{words}'", f' id="{words.split()[0]}"'))

    def other(self, plain: bool = True) -> str:
        """A piece that is not main text.  ``plain``: it may lack any name
        (only outside the main element can such a piece be told)."""
        s, one, pick = self.s, self.one, self.pick

        def links(n):
            return "".join(f'<li><a href="/x">{" ".join(s().split()[:3])}</a></li>' for _ in range(n))

        def named(*words):
            w = one(words)
            return self.attribute(one((w, w, one(_PLACES).format(w), f"{self.neutral()} {w}")))

        def p(n):
            return "".join(f"<p>{s()}</p>" for _ in range(n))

        kinds = [
            lambda: f'<aside{one(("", named("sidebar", "widget")))}><h3>{s()[:30]}</h3><ul>{links(5)}</ul></aside>',
            lambda: f"<aside>{p(1 + pick(2))}</aside>",
            lambda: f'<div{named("cookie", "consent", "notice", "alert", "warning", "popup", "modal")}>{one((s(), p(1)))}</div>',
            lambda: f'<div role="{one(("alert", "dialog", "banner"))}">{p(1)}</div>',
            lambda: f'<section{named("comments", "discussion", "replies")}><h3>{s()[:20]}</h3>' + "".join(
                f'<div{named("comment", "reply")}>{p(1 + pick(2))}</div>' for _ in range(1 + pick(4))) + "</section>",
            lambda: f'<div{named("comments", "discussion")}>{p(1 + pick(5))}</div>',
            lambda: f'<ul{named("comments", "comment")}><li class="comment">{s()}</li><li class="comment">{s()}</li></ul>',
            lambda: f'<form{one(("", named("search", "newsletter", "login")))}><label>{s()[:25]}</label><input name=q>{one(("", p(1)))}<button>{s()[:8]}</button></form>',
            lambda: f'<header{one(("", named("header", "masthead")))}>{one((f"<h2>{s()[:25]}</h2><p>{s()[:40]}</p>", f"<div>{s()}</div>"))}</header>',
            lambda: f'<div{named("header", "masthead", "banner")}><h2>{s()[:25]}</h2><p>{s()[:60]}</p></div>',
            lambda: f'<div{named("related", "recommended")}><h4>{s()[:15]}</h4><ul>{links(4)}</ul></div>',
            lambda: f'<div{named("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner")}>{one((s(), p(1), p(2)))}</div>',
            lambda: f'<div{named("share", "social", "toolbar")}><a href="#">{s()[:6]}</a> <a href="#">{s()[:6]}</a></div>',
            lambda: f'<nav{one(("", named("breadcrumbs", "breadcrumb", "menu")))}><a href="/">{s()[:8]}</a> &gt; <a href="/a">{s()[:8]}</a></nav>',
            lambda: f'<div{named("menu", "nav", "navigation", "sidebar")}><ul>{links(6)}</ul></div>',
            lambda: f'<div{named("sidebar", "widget")}>{p(1 + pick(3))}</div>',
            lambda: f'<footer><p>&copy; {s()}</p></footer>',
            lambda: "<{0}>{1}</{0}>".format(one(("nav", "footer", "header", "aside", "form")), s()[: 3 + pick(80)]),
            lambda: f'<div{named("footer", "copyright", "legal", "disclaimer")}>{one(("&copy; ", ""))}{s()}</div>',
            lambda: f'<div{named("newsletter", "subscribe", "signup")}>{p(1)}</div>',
        ]
        if plain and pick(4) == 0:
            bare = self.attribute(self.neutral()) if pick(3) else ""
            return one((f"<div{bare}><p>{s()[:120]}</p></div>", f"<div{bare}>{s()[:80]}</div>", f"<div{bare}><ul>{links(4)}</ul></div>"))
        return one(kinds)()

    def others(self, most: int, plain: bool = True) -> str:
        return "".join(re.sub(r"^<(\w+)", r'<\1 data-y="0"', self.other(plain)) for _ in range(self.pick(most + 1)))

    def container(self, inner: str) -> str:
        """The main element around ``inner``: named by its tag, by class words
        of any kind, or not at all; maybe with wrappers around it or in it."""
        tag = self.one(("article", "main", "div", "div", "section", "div"))
        sure = tag in ("article", "main")
        words = self.kept_words(sure) if self.pick(10) < 8 else ""
        if self.pick(4) == 0:
            inner = f'<div{self.attribute(self.kept_words(False))}>{inner}</div>'
        out = f'<{tag}{self.attribute(words)} data-y="1">{inner}{self.others(1, False) if self.pick(3) == 0 else ""}</{tag}>'
        if self.pick(3) == 0:
            out = f'<div{self.attribute(self.kept_words(False))}>{self.others(1)}{out}{self.others(1)}</div>'
        return out

    def page(self) -> str:
        """A page made of sentences: in a container, or bare in the body."""
        def block():
            kind = self.pick(9)
            if kind == 0:
                return "<ul>" + "".join(f"<li>{self.s()}</li>" for _ in range(2 + self.pick(4))) + "</ul>"
            if kind == 1:
                return f"<blockquote><p>{self.s()}</p></blockquote>"
            if kind == 2:
                return f"<h2>{self.s()[: 5 + self.pick(50)]}</h2>"
            return f'<p>{" ".join(self.s() for _ in range(1 + self.pick(5)))}</p>'

        if self.pick(12) == 0:                           # no main text at all
            alone = "<{0} data-y=0>{1}</{0}>".format(self.one(("nav", "footer", "header", "aside", "form")), self.s()[: 3 + self.pick(80)])
            return self.one((alone, "<body>" + alone, f"<body>{alone}{self.others(3, False)}", "<body>" + re.sub(
                r"^<(\w+)", r'<\1 data-y="0"', self.other(False)) + self.others(3, False)))
        if self.pick(6) == 0:                            # no container at all
            blocks = [f"<h1>{self.s()[: 5 + self.pick(60)]}</h1>"] * self.pick(2) + [f"<p>{self.s()} {self.s()}</p>" for _ in range(1 + self.pick(6))]
            inner = self.one((self.s()[: 3 + self.pick(200)].strip(), "".join(blocks), "".join(blocks)))
            marked = re.sub(r"<(h1|p)>", r'<\1 data-y="1">', inner)
            around = self.pick(2)
            body = (self.others(2, False) if around else "") + marked + (self.others(2, False) if around else "")
            return f"<html><body>{body}</body></html>" if self.pick(2) else body
        if self.pick(8) == 0:                            # little text, little else
            return f"<body>{self.one(('', '<nav data-y=0><a href=/>' + self.s()[:8] + '</a></nav>'))}{self.container(f'<p>{self.s()}</p>')}</body>"
        inner = f"<h1>{self.s()[: 5 + self.pick(60)]}</h1>" * self.pick(2) + "".join(block() for _ in range(2 + self.pick(10)))
        return f'<html><body class="{self.one(_OTHER_WORDS)}">{self.others(4)}{self.container(inner)}{self.others(4)}</body></html>'


def _varied(page: str, seed: int, sentences: list[str]) -> str:
    """A copy of ``page`` with another main element around its main text and
    other pieces before, inside and after it."""
    make = _Maker(seed, sentences)
    m = _MAIN_OPEN.search(page)
    close = re.search(f"</{m.group(1)}\\s*>", page[m.end():], re.I)
    inner_end = m.end() + close.start() if close else len(page)
    after = m.end() + close.end() if close else len(page)
    head, inner, tail = page[: m.start()], page[m.end(): inner_end], page[after:]
    return f"{head}{make.others(3)}{make.container(inner)}{make.others(3)}{tail}"


def labels(page: Page) -> np.ndarray | None:
    """1 for nodes of the main element and its ancestors, 0 for the rest; None
    for a page that marks nothing and has not exactly one such element."""
    roots = [i for i, m in enumerate(page.mark) if m == "1"]
    if not roots:
        roots = [i for i, t in enumerate(page.tag) if t in ("article", "main")]
        if len(roots) != 1:
            return None if "0" not in page.mark else np.zeros(len(page.tag))
    y = np.zeros(len(page.tag))
    y[roots] = 1
    for i in range(1, len(y)):
        if page.mark[i] == "0":
            y[i] = 0
        elif y[page.parent[i]] == 1:
            y[i] = 1
    for r in roots:
        i = page.parent[r]
        while i >= 0 and page.mark[i] != "up":
            page.mark[i] = "up"                          # an ancestor is kept, its other children are not
            i = page.parent[i]
    y[[i for i, m in enumerate(page.mark) if m == "up"]] = 1
    return y


class Model(NamedTuple):
    trees: boost.Trees
    weights: dict[str, float]


def train(pages: list[str]) -> Model:
    """Boosted trees from self-labelled pages (plain and varied) and made
    ones."""
    plain = [(s, parse(s)) for s in pages]
    texts = sorted({t[:300] for _, p in plain for t in p.text if t and 20 <= len(t)})[:2000]
    if len(texts) < 200:                                 # few texts: the fixed ones and pieces of all make up for it
        texts += _SENTENCES
        texts += [" ".join(t.split()[:n]) for t in texts for n in (3, 6, 12)]
    plain = [(s, p) for s, p in plain if labels(p) is not None and len(_MAIN_OPEN.findall(s)) == 1]
    shown = [p for _, p in plain]
    for n, (s, _) in enumerate(plain):
        shown += [parse(_varied(s, n, texts)), parse(_varied(s, n + 10**6, texts))]
    made = [parse(_Maker(n + 10**7, texts).page()) for n in range(MADE_PAGES)]
    for p in made:                                       # text without any element around it
        if "1" not in p.mark:
            for i in range(1, len(p.tag)):
                if p.tag[i] == "#text" and p.tag[p.parent[i]] in ("#page", "body"):
                    p.mark[i] = "1"
    shown += made
    y = [labels(p) for p in shown]
    shown, y = [p for p, v in zip(shown, y) if v is not None], [v for v in y if v is not None]
    weights = vocabulary(shown, y)
    own = [~joined(p)[1:] for p in shown]
    x = np.concatenate([features(p, weights)[1:][o] for p, o in zip(shown, own)])
    target = np.concatenate([v[1:][o] for v, o in zip(y, own)])
    part = np.arange(len(target)) % 4 == 0
    return Model(boost.calibrated(boost.fit(x[~part], target[~part], rounds=90, depth=5, rate=0.25), x[part], target[part]), weights)


def fit(pages: DataFrame) -> Model:
    """Train on the ``SAMPLE_PAGES`` pages of least hash among those of up to
    ``SAMPLE_CHARS`` characters with exactly one ``article`` or ``main``."""
    html, h = column(pages, "html").cast("string"), F.xxhash64(column(pages, "page_id"), column(pages, "url"))
    rows = pages.select(html.alias("html"), h.alias("h")).where(F.length("html").between(1, SAMPLE_CHARS)).where(
        F.regexp_count("html", F.lit("(?i)" + _MAIN_OPEN.pattern)) == 1)
    last = rows.select("h").orderBy("h").limit(SAMPLE_PAGES).agg(F.max("h")).first()[0]
    if last is None:                        # no page labels itself: texts of some pages, for the made ones
        some = pages.select(html.alias("html"), h.alias("h")).where(F.length("html").between(1, SAMPLE_CHARS))
        return train([r.html for r in some.orderBy("h", "html").limit(SAMPLE_PAGES).collect()])
    got = rows.where(F.col("h") <= F.lit(last)).orderBy("h", "html").limit(SAMPLE_PAGES).collect()
    return train([r.html for r in got])


# ---------------------------------------------------------------- operator

def main_texts(sources: list[str | None], model: Model) -> list[str]:
    parsed = [parse(s) if s else None for s in sources]
    real = [p for p in parsed if p is not None and any(t is not None for t in p.text)]
    if not real:
        return [""] * len(sources)
    x = np.concatenate([features(p, model.weights) for p in real])
    odds = np.clip(model.trees.scale * boost.margins(model.trees, x) + model.trees.shift, -6, 6)
    scores = np.split(odds, np.cumsum([len(p.tag) for p in real])[:-1])
    texts = {id(p): written(p, keep(p, decided(p, o))) for p, o in zip(real, scores)}
    return [texts.get(id(p), "") for p in parsed]


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html", 1 << 20):
            texts = main_texts(b.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return pages.select(column(pages, "page_id").cast("long").alias("page_id"), column(pages, "url").cast("string").alias("url"),
                        column(pages, "html").cast("string").alias("html")).mapInArrow(
        task(run), "page_id long, url string, text string, n_chars long")


def main_text(pages: DataFrame) -> DataFrame:
    return extract(pages, fit(pages))
