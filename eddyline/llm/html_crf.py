"""Main-text extraction: a linear-chain conditional random field over a page's text blocks.

``blocks`` cuts a page into leaf blocks (runs of text between block-level tags) with the tags
and the class/id/role hints of their ancestors. Each block gets indicator features: ancestor
tags, its own tag, hint groups, and the shape of its text (length, share of link text,
sentence ends, legal marks, place in the page). The model has a weight per feature and label
and one per pair of neighbouring labels; it is trained on labelled pages by the exact gradient
of the conditional likelihood (forward-backward) and decoded by Viterbi. The article is the
text of the blocks labelled 1.

Training happens on the driver with a fixed set of labelled pages (``labelled_pages.PAGES``
pages, independent of the corpus); the weights are a few kilobytes. Pages are handled one by
one inside the tasks, whole, without a shuffle.

Defined cases: null html counts as empty and gives the empty text; unclosed tags, comments and
scripts end with the page; text outside any block-level tag is a block too; repeated rows
give equal results; other columns pass through and a column called ``text`` is replaced; an
empty table gives an empty result.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import byte_values, map_rows
from eddyline.llm.labelled_pages import NO, YES, labelled_pages

# Markup, tried in this order at each '<'; possessive repeats keep broken pages linear.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title|select|object)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'">])*+)>"""
    r"""|</?[a-zA-Z][^<>]*+>?"""
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
# an opening tag ends an open element of these first
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("article aside body div footer form header main nav ol section table td th ul blockquote".split())

ANCESTORS = (
    "article main section nav header footer aside form table ul ol dl figure blockquote pre details dialog fieldset button "
    "address label".split()
)
OWN = "p h1 h2 h3 h4 h5 h6 li td th dd dt div blockquote pre figcaption caption button label body section article main".split()
HINTS = {
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs",
    "comment": "comment comments commentlist disqus reply replies respond responses discussion",
    "side": "sidebar side widget widgets related recommended recommendations share sharing social trending popular",
    "foot": "footer foot copyright legal colophon contentinfo",
    "head": "header masthead topbar logo",
    "notice": "cookie cookies consent notice popup modal overlay alert newsletter subscribe subscription gdpr paywall signup login",
    "body": "content article post entry story body main text",
}
HINT_GROUP = {word: group for group, words in HINTS.items() for word in words.split()}
LENGTHS, LINKS, PLACES = (15, 40, 100, 250), (0.01, 0.3, 0.7), (0.1, 0.3, 0.7, 0.9)
NAMES = (
    ["always", *(f"in:{t}" for t in ANCESTORS), *(f"own:{t}" for t in [*OWN, "other"]), *(f"hint:{g}" for g in HINTS)]
    + [f"length:{k}" for k in range(len(LENGTHS) + 1)] + [f"links:{k}" for k in range(len(LINKS) + 1)]
    + [f"place:{k}" for k in range(len(PLACES) + 1)]
    + ["sentence", "legal", "capital", "in article, in header", "in article, in aside", "neither article nor main on page",
       "article or main on page, outside", "hint at own element", "short link", "in article, hint of clutter"]
)
INDEX = {name: k for k, name in enumerate(NAMES)}
LEGAL = re.compile("©|copyright|all rights reserved", re.I)
ITERATIONS = 200


LIST_SCOPES = frozenset("ul ol dl table select".split())
LISTED = frozenset(x for names in ENDS.values() for x in names)
NOTED = frozenset([*ANCESTORS, "head"])
NONE = frozenset()


class Block:
    __slots__ = ("text", "tags", "own", "hints", "own_hint", "linked")

    def __init__(self, text, tags, own, hints, own_hint, linked):
        self.text, self.tags, self.own, self.hints, self.own_hint, self.linked = text, tags, own, hints, own_hint, linked


class Element:
    """An open element with what its blocks need to know of all its ancestors: sets of a few fixed
    names, shared with the parent where they are equal, so depth costs nothing."""

    __slots__ = ("tag", "tags", "own", "hints", "own_hint", "p_open", "listed")

    def __init__(self, tag: str, own_hint: frozenset, parent: Element | None):
        self.tag, self.own_hint = tag, own_hint
        above = parent or ROOT
        self.tags = above.tags | {tag} if tag in NOTED and tag not in above.tags else above.tags
        self.own = tag if tag in BLOCK_TAGS else above.own
        self.hints = above.hints if own_hint <= above.hints else above.hints | own_hint
        # is a p open since the last scope, which list items and cells since the last list or table
        self.p_open = tag == "p" or above.p_open and tag not in SCOPES
        self.listed = NONE if tag in LIST_SCOPES else above.listed | {tag} if tag in LISTED else above.listed


class ROOT:
    tags, own, hints, own_hint, p_open, listed = NONE, "body", NONE, NONE, False, NONE


def _hints(attrs: str) -> frozenset:
    if not attrs or "=" not in attrs:
        return frozenset()
    found = set()
    for m in HINT.finditer(attrs):
        value = (m[1] or m[2] or m[3] or "").lower()
        found.update(g for w in WORD.findall(value) if (g := HINT_GROUP.get(w)))
    return frozenset(found)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order."""
    out: list[Block] = []
    stack: list[Element] = []
    opened: Counter = Counter()  # open elements by tag
    inline: list[Counter] = [Counter()]  # open inline elements by tag, per open block element
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", html_entities.unescape("".join(parts))).strip()
            at = stack[-1] if stack else ROOT
            if text and not opened["head"]:
                out.append(Block(text, at.tags, at.own, at.hints, at.own_hint, linked))
            parts.clear()
        linked = 0

    def push(tag: str, attrs: str) -> None:
        stack.append(Element(tag, _hints(attrs), stack[-1] if stack else None))
        opened[tag] += 1
        if tag in BLOCK_TAGS:
            inline.append(Counter())
        else:
            inline[-1][tag] += 1

    def pop() -> str:
        tag = stack.pop().tag
        opened[tag] -= 1
        if tag in BLOCK_TAGS:
            inline.pop()
        else:
            inline[-1][tag] -= 1
        return tag

    def close(names: tuple[str, ...]) -> None:
        """Close the innermost open element of these; it is known to be there."""
        while pop() not in names:
            pass

    for m in TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            if stack and stack[-1].tag == "head" and not text.isspace():
                flush()
                pop()
            parts.append(text)
            if opened["a"]:
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            if m["raw"] is not None:
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag in ("br", "wbr", "img"):
            parts.append(" " if tag != "wbr" else "")
            continue
        is_block = tag in BLOCK_TAGS
        if is_block:
            flush()
        if m["close"]:
            # an end tag closes its element if it is open; that of an inline one not across a block
            if tag not in VOID and (opened if is_block else inline[-1])[tag]:
                close((tag,))
        elif tag not in VOID:
            if stack and stack[-1].tag == "head":  # only void and raw elements may stand in it
                flush()
                pop()
            if is_block and stack:
                if stack[-1].p_open:
                    close(("p",))
                if tag in ENDS and stack and not stack[-1].listed.isdisjoint(ENDS[tag]):
                    close(ENDS[tag])
            if not m["attrs"].endswith("/") or is_block:
                push(tag, m["attrs"])
    flush()
    return out


def features(page_blocks: list[Block]) -> list[list[int]]:
    """Indices of the features that hold, per block."""
    n, out = len(page_blocks), []
    has_article = any("article" in b.tags or "main" in b.tags for b in page_blocks)
    for k, b in enumerate(page_blocks):
        tags, own = b.tags, b.own
        share = b.linked / max(1, len(b.text))
        place = k / max(1, n - 1)
        on = [0, *(INDEX[f"in:{t}"] for t in ANCESTORS if t in tags), INDEX[f"own:{own}" if own in OWN else "own:other"]]
        on += [INDEX[f"hint:{g}"] for g in b.hints]
        on.append(INDEX["length:0"] + sum(len(b.text) >= x for x in LENGTHS))
        on.append(INDEX["links:0"] + sum(share >= x for x in LINKS))
        on.append(INDEX["place:0"] + sum(place >= x for x in PLACES))
        main = "article" in tags or "main" in tags
        for name, holds in (
            ("sentence", b.text[-1] in ".!?:;…\"'»”)"), ("legal", LEGAL.search(b.text) is not None),
            ("capital", b.text[0].isupper()), ("in article, in header", main and "header" in tags),
            ("in article, in aside", main and "aside" in tags), ("neither article nor main on page", not has_article),
            ("article or main on page, outside", has_article and not main), ("hint at own element", bool(b.own_hint)),
            ("short link", share >= 0.7 and len(b.text) < 40),
            ("in article, hint of clutter", main and bool(b.hints - {"body", "head", "foot"})),
        ):
            if holds:
                on.append(INDEX[name])
        out.append(on)
    return out


class Model:
    """Weights of the field: per feature and label, per pair of labels, for the ends."""

    def __init__(self):
        self.emit = np.zeros((len(NAMES), 2))
        self.step = np.zeros((2, 2))
        self.start = np.zeros(2)
        self.end = np.zeros(2)

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The most probable labels (Viterbi); ties go to 0."""
        if not rows:
            return []
        emit = [self.emit[on].sum(axis=0).tolist() for on in rows]
        (a, b), (c, d) = self.step.tolist()
        x, y = (emit[0][k] + float(self.start[k]) for k in (0, 1))
        back = []
        for e0, e1 in emit[1:]:
            to0 = int(y + c > x + a)
            to1 = int(y + d > x + b)
            back.append((to0, to1))
            x, y = (y + c if to0 else x + a) + e0, (y + d if to1 else x + b) + e1
        label = int(y + float(self.end[1]) > x + float(self.end[0]))
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(pages: list[tuple[list[list[int]], list[int]]], iterations: int = ITERATIONS) -> Model:
    """Maximum conditional likelihood with a small ridge, by Adam on the exact gradient; all
    pages at once, padded to the longest."""
    model = Model()
    longest, count = max(len(y) for _, y in pages), len(pages)
    x = np.zeros((count, longest, len(NAMES)), np.float32)
    y, real = np.zeros((count, longest), int), np.zeros((count, longest), bool)
    for p, (rows, labels) in enumerate(pages):
        for t, on in enumerate(rows):
            x[p, t, on] = 1
        y[p, : len(labels)], real[p, : len(labels)] = labels, True
    each, last = np.arange(count), real.sum(1) - 1
    gold = np.eye(2)[y] * real[:, :, None]
    pair = (real[:, 1:] & real[:, :-1])[:, :, None, None]
    gold_pairs = (gold[:, :-1, :, None] * gold[:, 1:, None, :] * pair).sum((0, 1))
    weights = [model.emit, model.step, model.start, model.end]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for turn in range(1, iterations + 1):
        emit = (x.reshape(-1, len(NAMES)) @ model.emit.astype(np.float32)).reshape(count, longest, 2).astype(float)
        ahead, behind = np.zeros((count, longest, 2)), np.zeros((count, longest, 2))
        ahead[:, 0] = emit[:, 0] + model.start
        for t in range(1, longest):
            moved = _log_sum(ahead[:, t - 1, :, None] + model.step, 1) + emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], moved, ahead[:, t - 1])
        behind[each, last] = model.end
        for t in range(longest - 2, -1, -1):
            moved = _log_sum(model.step + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], moved, behind[:, t])
        total = _log_sum(ahead[:, -1] + model.end, 1)
        node = np.exp(ahead + behind - total[:, None, None]) * real[:, :, None]
        both = ahead[:, :-1, :, None] + model.step + (emit[:, 1:] + behind[:, 1:])[:, :, None, :]
        both = (np.exp(np.minimum(both - total[:, None, None, None], 0)) * pair).sum((0, 1))
        diff = (gold - node).reshape(-1, 2)
        gradient = [
            x.reshape(-1, len(NAMES)).T @ diff, gold_pairs - both, (gold[:, 0] - node[:, 0]).sum(0),
            (gold[each, last] - node[each, last]).sum(0),
        ]
        for w, g, m, v in zip(weights, gradient, first, second, strict=True):
            g = g / count - 1e-3 * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return model


def training_set(pages: list[str] | None = None) -> list[tuple[list[list[int]], list[int]]]:
    """Features and labels of marked pages; the marks are taken off before the features."""
    out = []
    for page in pages if pages is not None else labelled_pages():
        parsed = blocks(page)
        labels = [int(YES in b.text) for b in parsed]
        for b in parsed:
            b.text = b.text.replace(YES, "").replace(NO, "") or "."
        out.append((features(parsed), labels))
    return [(x, y) for x, y in out if y]


def main_text(page: str, model: Model) -> str:
    parsed = blocks(page)
    return "\n\n".join(b.text for b, y in zip(parsed, model.decode(features(parsed)), strict=True) if y)


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` plus ``text``, the article."""

    def make():
        def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            return {"text": pa.array([main_text((b or b"").decode(), model) for b in byte_values(batch.column(html))], pa.string())}

        return step

    return map_rows(pages, make, [T.StructField("text", T.StringType())], by=html)


def query(pages: DataFrame) -> DataFrame:
    model = train(training_set())
    out = extract(pages.select("page_id", "url", "html"), model)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


ship_by_value(__name__)
