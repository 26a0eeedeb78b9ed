"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements with text runs as leaves.  Every node has a hidden label, content or not,
with a potential from its own features (tag, words of class and id, length, links, punctuation) and one with its
parent's label.  Sum-product messages, upward from the leaves and downward from the root, give every node's marginal;
the text runs whose marginal is at least one half are the article.

Node potentials (logistic) and parent-child potentials (log odds of label pairs) are trained from labelled pages.
``labelled_pages`` gives a set of them: pages composed of marked content and boilerplate in many layouts.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TRAINING_PAGES = 600

#: Elements by how they are written and shown.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math object canvas select option".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY = {
    "p": set(
        "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul".split()
    ),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
}
#: Words of class and id attributes that say what an element is for.
AGAINST = (
    "nav menu navbar sidebar side footer header masthead ad ads advert advertisement adsense sponsor sponsored promo "
    "banner cookie cookies consent gdpr notice alert comment comments reply replies disqus respond share social "
    "related recommended newsletter subscribe signup login breadcrumb breadcrumbs pagination pager widget popup modal "
    "toolbar search form copyright legal tags meta byline toc skip"
).split()
IN_FAVOUR = "article content post entry story body text main blog news document page prose markdown".split()

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"(?<![-\w])hidden(?![-\w])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "names", "hidden", "parent", "text", "links", "children")

    def __init__(self, tag: str, names: tuple[str, ...], hidden: bool, parent: Node | None) -> None:
        self.tag, self.names, self.hidden, self.parent = tag, names, hidden, parent
        self.text, self.links = "", 0
        self.children: list[Node] = []


def _names(attributes: str) -> tuple[str, ...]:
    if not attributes.strip():
        return ()
    words = (w for m in _NAMES.finditer(attributes) for w in _SPLIT.split(_HUMP.sub(" ", m[1] or m[2] or m[3] or "").lower()))
    return tuple(w for w in words if w)


def parsed(page: str) -> list[Node]:
    """Block elements and text runs (tag ``#text``), parents before children, in page order."""
    root = Node("#root", (), False, None)
    nodes, here = [root], root
    run: list[str] = []
    links, in_link, at = 0, 0, 0

    def close_run() -> None:
        nonlocal links
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text:
            leaf = Node("#text", (), False, here)
            leaf.text, leaf.links = text, min(links, len(text))
            here.children.append(leaf)
            nodes.append(leaf)
        run.clear()
        links = 0

    def say(raw: str) -> None:
        nonlocal links
        text = entities.unescape(raw)
        run.append(text)
        if in_link:
            links += len(text.strip())

    while True:
        m = _TAG.search(page, at) if page.find(">", at) >= 0 else None
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:-3])
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else (len(page) if tag in ("script", "style", "textarea", "title") else at)
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag in ("br", "img", "wbr"):
                run.append(" " if tag != "wbr" else "")
            continue
        close_run()
        in_link = 0
        if closing:
            up: Node | None = here
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                here = up.parent
            continue
        while here.tag in CLOSED_BY and tag in CLOSED_BY[here.tag]:
            here = here.parent  # the root closes nothing
        if tag in VOID:
            continue
        node = Node(tag, _names(m[3]), bool(m[3]) and bool(_HIDDEN.search(m[3])), here)
        here.children.append(node)
        nodes.append(node)
        if not m[3].endswith("/"):
            here = node
    close_run()
    return nodes


TAGS = (
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol li table tr td th blockquote pre figure figcaption nav header "
    "footer aside form button dialog menu address center body html #root #text dl dt dd fieldset details summary"
).split()
_TAG_AT = {t: i for i, t in enumerate(TAGS)}
_WORD_AT = {w: len(TAGS) + 1 + i for i, w in enumerate([*AGAINST, *IN_FAVOUR])}
_EXTRA = len(TAGS) + 1 + len(_WORD_AT)
WIDTH = _EXTRA + 10


def node_features(n: Node) -> list[tuple[int, float]]:
    out = [(_TAG_AT.get(n.tag, len(TAGS)), 1.0)]
    for w in set(n.names):
        if w in _WORD_AT:
            out.append((_WORD_AT[w], 1.0))
    if any(w in AGAINST for w in n.names):
        out.append((_EXTRA, 1.0))
    if any(w in IN_FAVOUR for w in n.names):
        out.append((_EXTRA + 1, 1.0))
    if n.hidden:
        out.append((_EXTRA + 2, 1.0))
    if n.tag == "#text":
        size, share = len(n.text), n.links / len(n.text)
        out += [(_EXTRA + 3, min(1.0, math.log1p(size) / 7)), (_EXTRA + 4, share), (_EXTRA + 5, float(n.text[-1] in ".!?…:\"”")),
                (_EXTRA + 6, float(share > 0.8)), (_EXTRA + 7, float("©" in n.text))]
    out.append((_EXTRA + 9, 1.0))
    return out


class TreeModel:
    """Log potentials: of a node's features for content, and of (parent, child) label pairs."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray) -> None:
        self.weights, self.pairs = weights.tolist(), pairs.tolist()

    def unary(self, n: Node) -> float:
        return sum(self.weights[i] * x for i, x in node_features(n))

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Log odds of content for every node, by messages up and then down the tree."""
        (p00, p01), (p10, p11) = self.pairs
        place = {id(n): i for i, n in enumerate(nodes)}
        up = [self.unary(n) for n in nodes]  # log odds of a node from itself and what is below
        message = [0.0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            x = up[i]
            # To the parent: log sum over this label, for each label of the parent.
            message[i] = _lse(p10, p11 + x) - _lse(p00, p01 + x)
            up[place[id(nodes[i].parent)]] += message[i]
        belief = up[:]
        for i in range(1, len(nodes)):
            x = belief[place[id(nodes[i].parent)]] - message[i]  # the parent's, without this child's message
            belief[i] = up[i] + _lse(p01, p11 + x) - _lse(p00, p10 + x)
        return belief


def _lse(a: float, b: float) -> float:
    m = max(a, b)
    return m + math.log1p(math.exp(min(a, b) - m))


def train(pages: Iterable[tuple[str, str]], rounds: int = 400) -> TreeModel:
    """From (html, mark) pages: a text run is content if it holds the mark, an element if all runs below are."""
    rows, labels, pair = [], [], np.ones((2, 2))
    for page, mark in pages:
        nodes = parsed(page)
        label: dict[int, list[int]] = {}
        for n in reversed(nodes):
            if n.tag == "#text":
                y = [int(mark in n.text)]
                n.text = n.text.replace(mark, "").strip() or "."
            else:
                y = [v for c in n.children for v in label[id(c)]]
            label[id(n)] = y
        # What holds both is content's frame: it counts as content if most of its text is.
        own = {id(n): int(bool(v := label[id(n)]) and sum(v) * 2 > len(v)) for n in nodes}
        for n in nodes:
            rows.append(node_features(n))
            labels.append(own[id(n)])
            if n.parent is not None:
                pair[own[id(n.parent)], own[id(n)]] += 1
    x = np.zeros((len(rows), WIDTH))
    for i, row in enumerate(rows):
        for j, v in row:
            x[i, j] += v
    y = np.array(labels, float)
    w, step = np.zeros(WIDTH), np.zeros(WIDTH)
    for _ in range(rounds):
        g = x.T @ (y - 1 / (1 + np.exp(-x @ w))) / len(y) - 1e-4 * w
        step = 0.9 * step + g
        w = w + 0.5 * step
    # The features say what a node's label is alone; the pair potentials say how labels go together.
    joint = pair / pair.sum()
    return TreeModel(w, np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True))))


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 7) -> list[tuple[str, str]]:
    """Pages in many layouts; every content run holds the mark."""
    r, mark = random.Random(seed), "\u2063"
    say = lambda a, b: " ".join("".join(r.choice("aeioustrnlmdhc") for _ in range(r.randint(2, 9))) for _ in range(r.randint(a, b)))
    sentence = lambda a=6, b=40: say(a, b).capitalize() + r.choice([".", ".", ".", "!", "?", ""])
    link = lambda: f'<a href="/{say(1, 1)}">{say(1, 3)}</a>'

    def content() -> str:
        parts = []
        for _ in range(r.randint(1, 9)):
            t = mark + " ".join(sentence(3, 50) for _ in range(r.randint(1, 4)))
            parts.append(r.choice([
                lambda: f"<p>{t}</p>", lambda: f"<p>{t}</p>", lambda: f"<p>{t} {link()} {say(3, 9)}.</p>", lambda: f"<p><b>{t}<br>",
                lambda: f"<h2>{mark}{say(2, 6)}</h2>", lambda: f"<blockquote>{t}</blockquote>", lambda: f"<blockquote><p>{t}</p></blockquote>",
                lambda: "<ul>" + "".join(f"<li>{mark}{sentence(3, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>",
                lambda: "<ol>" + "".join(f"<li>{mark}{sentence(3, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ol>",
                lambda: f"<table><tr><td>{mark}{say(1, 4)}</td><td>{mark}{say(1, 4)}</td></tr></table>",
                lambda: f"<pre>{t}</pre>", lambda: f"<figure><figcaption>{mark}{sentence(4, 12)}</figcaption></figure>", lambda: f"<div>{t}</div>",
            ])())
        title = f"<h1>{mark}{say(2, 10)}</h1>" if r.random() < 0.8 else ""
        return title + "".join(parts)

    def boiler() -> str:
        links = "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 8)))
        text = sentence(4, 45)
        kind = lambda: r.choice(["div", "section", "aside", "div"])
        name = r.choice(AGAINST)
        k = kind()
        return r.choice([
            lambda: f"<nav><ul>{links}</ul></nav>", lambda: f"<header><h1>{say(1, 3)}</h1><p>{text}</p></header>",
            lambda: f"<aside><h3>{say(1, 3)}</h3><ul>{links}</ul></aside>", lambda: f"<aside><p>{text}</p></aside>",
            lambda: f'<div class="ad">{text}</div>', lambda: f'<{k} class="{name}">{text}</{k}>', lambda: f'<{k} class="{name}"><p>{text}</p></{k}>',
            lambda: f'<{k} id="{name}"><h3>{say(1, 3)}</h3><p>{text}</p><p>{sentence()}</p></{k}>',
            lambda: f'<{k} class="{name}"><ul>{links}</ul></{k}>',
            lambda: f"<form><label>{say(1, 3)}</label><button>{say(1, 2)}</button><p>{text}</p></form>",
            lambda: f'<{k} class="comments"><h3>{say(1, 2)}</h3>' + "".join(f'<div class="comment"><p>{sentence()} {sentence()}</p></div>' for _ in range(r.randint(1, 4))) + f"</{k}>",
            lambda: f'<ol class="comment-list"><li><p>{sentence()} {sentence()}</p></li></ol>',
            lambda: f"<div>{link()} | {link()} | {link()}</div>", lambda: f'<div style="display:none"><p>{text}</p></div>',
            lambda: f"<dialog><p>{text}</p></dialog>",
        ])()

    out = []
    for _ in range(n):
        body = content()
        inner = r.random() < 0.3
        if inner:
            body += boiler()
        frame = r.choice([
            "<article>{}</article>", "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>",
            '<div class="content">{}</div>', '<div id="main"><div class="post">{}</div></div>', '<div class="article-body">{}</div>',
            '<div class="entry-content">{}</div>', '<section class="story">{}</section>', '<div class="wrap"><div>{}</div></div>', "{}",
        ])
        before, after = ("".join(boiler() for _ in range(r.randint(0, 3))) for _ in range(2))
        foot = f"<footer>&copy; {say(1, 3)} &middot; {sentence(2, 12)}</footer>" if r.random() < 0.7 else ""
        out.append((f"<html><body>{before}{frame.format(body)}{after}{foot}</body></html>", mark))
    return out


@lru_cache(maxsize=1)
def standard_model() -> TreeModel:
    return train(labelled_pages())


def main_text(page: str, model: TreeModel) -> str:
    nodes = parsed(page)
    belief = model.marginals(nodes)
    return "\n\n".join(n.text for n, b in zip(nodes, belief) if n.tag == "#text" and b >= 0)


def extracted(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """``page_id``, ``url`` and ``text``, the main text of ``html``.

    A null or empty page has an empty text, as has one of boilerplate only.  Rows repeat as they come; other columns
    are ignored; an empty table gives an empty result.
    """
    model = model or standard_model()

    def run(batches):
        for batch in batches:
            texts = [main_text(x or "", model) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    )
