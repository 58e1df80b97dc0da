"""HTML pages as flat lists of nodes, and the nodes' features.

The parser is tolerant: it never fails, closes what HTML closes by itself (``p``, ``li``,
table cells ...), ignores end tags without a start and takes an unfinished tag, comment or
script as reaching to the end. Scripts, styles, the head's title, form controls and other
content that is not shown as text never become nodes. Inline elements belong to the text
run they stand in. A node is a block element or a run of text between block tags; parents
come before children.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

# Fixed values of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track".split())
NOT_TEXT = frozenset("script style title textarea select button option noscript iframe template svg math object canvas audio video xmp noembed noframes".split())
#: A start tag of the key closes open elements of the value, up to the nearest one of SCOPE.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = frozenset("table ul ol dl body html article section main div".split())
PARAGRAPH_ENDS = frozenset("address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                           "header hr li main menu nav ol p pre section table td th tr ul dt dd".split())

#: Tags by kind; every other block tag is of the last kind but one, a text run of the last.
TAG_KINDS = [{"html", "body"}, {"article"}, {"main"}, {"section"}, {"div", "center"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"nav", "menu"}, {"header"},
             {"footer"}, {"aside"}, {"form", "fieldset", "dialog"}, {"ul", "ol", "dl", "dir"}, {"li", "dt", "dd"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th"},
             {"blockquote", "pre", "figure", "figcaption", "details", "address"}]
KIND_OF = {tag: k for k, tags in enumerate(TAG_KINDS) for tag in tags}
OTHER_KIND, RUN_KIND = len(TAG_KINDS), len(TAG_KINDS) + 1
N_KINDS = len(TAG_KINDS) + 2

#: Tokens of class, id and role by meaning.
TOKEN_GROUPS = ["article content main post entry story text body copy page".split(),
                "nav navbar navigation menu menubar topnav breadcrumb breadcrumbs toolbar tabs".split(),
                "header masthead head topbar branding logo top".split(),
                "footer foot bottom copyright legal colophon contentinfo".split(),
                "sidebar side aside rail column widget widgets complementary".split(),
                "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner commercial".split(),
                "notice cookie cookies consent gdpr alert warning popup modal overlay paywall message toast announcement".split(),
                "comment comments reply replies discussion disqus respond feedback reader responses".split(),
                "form login signup subscribe subscription newsletter search register contact".split(),
                "related recommended recommendations more popular trending teaser teasers".split(),
                "share sharing social follow tags tag meta byline author pagination pager".split(),
                "hidden none invisible sr only".split()]
GROUP_OF = {t: g for g, tokens in enumerate(TOKEN_GROUPS) for t in tokens}

#: A > in a quoted value does not end a tag; a quote that never closes is taken as a plain character.
TAG = re.compile(r"""<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)|=)*+)>)""")
NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE_ENDS = re.compile(r"[.!?…。]")


@dataclass
class Nodes:
    """Columns of the nodes of one page or, joined, of several."""

    parent: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)  # bit g: a token of group g
    text: list[str | None] = field(default_factory=list)  # of text runs
    link: list[int] = field(default_factory=list)  # code points inside links
    inline: list[int] = field(default_factory=list)  # inline tags
    truth: list[bool] = field(default_factory=list)  # where known: main text


def token_bits(attributes: str) -> int:
    bits = 0
    for m in NAMES.finditer(attributes):
        for t in TOKEN.findall(m[1] or m[2] or m[3] or ""):
            g = GROUP_OF.get(t.lower())
            if g is not None:
                bits |= 1 << g
    if HIDDEN.search(attributes):
        bits |= 1 << (len(TOKEN_GROUPS) - 1)
    return bits


def parse(page: str, truth_mark: str | None = None) -> Nodes:
    """The nodes of one page. ``truth_mark``: runs that contain it are main text (it is taken out)."""
    nodes = Nodes()
    parent, kind, depth, tokens, texts, links, inlines, truth = (nodes.parent, nodes.kind, nodes.depth, nodes.tokens, nodes.text, nodes.link,
                                                                nodes.inline, nodes.truth)

    def add(of: int, k: int, bits: int, text: str | None = None, link: int = 0, inline: int = 0, main: bool = False) -> int:
        parent.append(of)
        kind.append(k)
        depth.append(depth[of] + 1 if of >= 0 else 0)
        tokens.append(bits)
        texts.append(text)
        links.append(link)
        inlines.append(inline)
        truth.append(main)
        return len(parent) - 1

    root = add(-1, 0, 0)
    stack: list[tuple[str, int]] = [("html", root)]
    run: list[str] = []
    in_link, link_chars, inline_tags = False, 0, 0

    def flush() -> None:
        nonlocal link_chars, inline_tags, in_link
        if run:
            text = html.unescape("".join(run))
            run.clear()
            main = truth_mark is not None and truth_mark in text
            text = " ".join((text.replace(truth_mark, "") if main else text).split())
            if text:
                add(stack[-1][1], RUN_KIND, 0, text, min(link_chars, len(text)), inline_tags, main)
        link_chars, inline_tags, in_link = 0, 0, False

    def close(tags: frozenset[str] | set[str], scope: frozenset[str] = SCOPE) -> None:
        """Close the nearest open element of ``tags`` within the scope, with all inside."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in scope:
                return

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            run.append(page[at:lt])
            if in_link:
                link_chars += lt - at
        if lt == n:
            break
        m = TAG.match(page, lt)
        if m is None:
            if lt + 1 < n and (page[lt + 1].isalpha() or page[lt + 1] == "/" and page[lt + 2:lt + 3].isalpha()):
                break  # a tag without end
            run.append("<")
            at = lt + 1
            continue
        if m[1]:
            end = page.find("-->", lt + 2)
            at = n if end < 0 else end + 3
            continue
        if m[2]:
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        at = m.end()
        tag, attributes = m[4].lower(), m[5]
        if tag in INLINE:
            if tag == "a":
                in_link = not m[3]
            inline_tags += not m[3]
        elif m[3]:
            if tag == "br":
                run.append(" ")
            elif tag == "p":
                flush()
                close({"p"})
            elif tag not in VOID and any(t == tag for t, _ in stack[1:]):
                flush()
                close({tag}, frozenset())
        elif tag in NOT_TEXT:
            run.append(" ")
            if not attributes.endswith("/"):
                end = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
                if end is None:
                    break
                gt = page.find(">", end.end())
                at = n if gt < 0 else gt + 1
        elif tag in VOID:
            if tag == "hr":
                flush()
            else:
                run.append(" ")
        elif tag == "html":
            continue
        else:
            flush()
            if tag in PARAGRAPH_ENDS:
                close({"p"})
            if tag in CLOSES:
                close(CLOSES[tag], SCOPE - CLOSES[tag])
            node = add(stack[-1][1], KIND_OF.get(tag, OTHER_KIND), token_bits(attributes) if attributes else 0)
            stack.append((tag, node))
    flush()
    return nodes


def by_levels(depth: np.ndarray) -> list[np.ndarray]:
    """Node numbers by depth, the root's level first."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def features(parent: np.ndarray, kind: np.ndarray, depth: np.ndarray, tokens: np.ndarray, text: list[str | None], link: np.ndarray,
             inline: np.ndarray) -> np.ndarray:
    """One row per node (of any number of pages; roots have parent -1)."""
    n = len(parent)
    chars = np.fromiter((len(t) if t else 0 for t in text), float, n)
    words = np.fromiter((t.count(" ") + 1 if t else 0 for t in text), float, n)
    ends = np.fromiter((len(SENTENCE_ENDS.findall(t)) if t else 0 for t in text), float, n)
    commas = np.fromiter((t.count(",") if t else 0 for t in text), float, n)
    blocks = (kind != RUN_KIND).astype(float)
    runs = 1 - blocks
    sums = np.stack([chars, words, ends, commas, link.astype(float), inline.astype(float), blocks, runs, (kind == KIND_OF["p"]).astype(float),
                     (kind == KIND_OF["li"]).astype(float)], axis=1)
    levels = by_levels(depth)
    for level in reversed(levels[1:]):
        np.add.at(sums, parent[level], sums[level])
    up = np.where(parent < 0, np.arange(n), parent)
    root, kind_above, tokens_above = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for level in levels[1:]:
        p = parent[level]
        root[level] = root[p]
        kind_above[level] = kind_above[p] | 1 << kind[p]
        tokens_above[level] = tokens_above[p] | tokens[p]
    c, w, e, m, a, i, b, r, p, li = sums.T
    total = np.maximum(sums[root, 0], 1)
    density = a / np.maximum(c, 1)
    # Among siblings: how many, their mean text, the place, the neighbours.
    of = np.where(parent < 0, n, parent)
    siblings = np.bincount(of, minlength=n + 1)[of]
    mean = np.bincount(of, c, n + 1)[of] / siblings
    order = np.lexsort((np.arange(n), of))
    first = np.concatenate(([True], of[order][1:] != of[order][:-1]))
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    place, left, right = np.empty(n), np.zeros(n), np.zeros(n)
    place[order] = np.arange(n) - start
    left[order[1:]] = np.where(first[1:], 0, c[order[:-1]])
    right[order[:-1]] = np.where(first[1:], 0, c[order[1:]])
    before = np.cumsum(chars) - chars  # text of the page before this node
    before -= before[root]
    numeric = [depth, np.log1p(c), np.log1p(w), c / (b + r), density, e / np.maximum(w, 1), m / np.maximum(w, 1), w / np.maximum(r, 1), i / np.maximum(w, 1),
               p, li, r, c / total, before / total, siblings, place / siblings, np.log1p(mean), np.log1p(left), np.log1p(right), c / np.maximum(mean, 1),
               density[up], c / np.maximum(c[up], 1), np.log1p(c[up]), np.log1p(total)]
    bits = [(x >> k & 1)[:, None] for x, size in ((1 << kind, N_KINDS), (1 << kind[up], N_KINDS), (kind_above, N_KINDS), (tokens, len(TOKEN_GROUPS)),
                                                 (tokens[up], len(TOKEN_GROUPS)), (tokens_above, len(TOKEN_GROUPS))) for k in range(size)]
    return np.concatenate([np.stack(numeric, axis=1), *bits], axis=1).astype(np.float32)
