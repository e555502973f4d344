"""Operator 2 - main text by a tree-structured graphical model of the page.

A page becomes a tree of its block elements and text blocks.  Every node has a
hidden label (main text or not); unary potentials come from its tag, class and id
words and text measures, pair potentials join it to its parent.  One sum-product
pass up and one down the tree give every node's marginal; the text blocks that
are more likely main text are the result.  The weights maximise the likelihood
of labelled pages (``html_pages``); the same passes give the exact gradient.

Pages of a batch are one forest: the passes run level by level over all of them.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm.common import arrow_map, only, table
from geoqa.llm.html_pages import labelled_pages

#: Labelled pages, steps and penalty of the training; buckets of hashed words.
PAGES, STEPS, RATE, PENALTY, HASHED = 800, 150, 0.1, 3e-4, 1024
#: Bytes of html that one forest takes at most (or one page).
FOREST = 1 << 20

_TAG = re.compile(r"""<(?:!--(?P<comment>)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"<]*"|'[^'<]*')*+)>|(?P<loose>/?[a-zA-Z][^>]*)>|[!?/][^>]*>)""")
_ATTR = re.compile(r"""\b(class|id|role|hidden|data-y)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[a-z]+|\d+")
_RAW = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in ("script", "style", "textarea", "title")}
#: Their content has tags of its own; a tag in it may close itself, and all of it is part of the line.
_FOREIGN = frozenset(("svg", "math"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i iframe ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
_SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "optgroup": "option optgroup",
             "tbody": "tbody thead tfoot tr td th", "thead": "tbody thead tfoot tr td th", "tfoot": "tbody thead tfoot tr td th"}
_SIBLINGS = {k: frozenset(v.split()) for k, v in _SIBLINGS.items()}
_SCOPE = frozenset("ul ol dl table select body article section div main".split())


@dataclass
class Tree:
    """Nodes of one page in order; parents come before children.  ``text`` is None for elements."""

    parent: list = field(default_factory=list)
    tag: list = field(default_factory=list)
    words: list = field(default_factory=list)   # of class, id and role
    text: list = field(default_factory=list)
    linked: list = field(default_factory=list)  # characters inside links
    label: list = field(default_factory=list)

    def add(self, parent, tag, words, text=None, linked=0, label=None) -> int:
        for k, v in zip(("parent", "tag", "words", "text", "linked", "label"), (parent, tag, words, text, linked, label)):
            getattr(self, k).append(v)
        return len(self.parent) - 1


@lru_cache(1 << 14)
def _attributes(attrs: str) -> tuple[tuple[str, ...], int | None]:
    """(words of class, id and role, label) of a start tag's attributes."""
    words, label = [], None
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "data-y":
            label = int(value == "1")
        elif name == "hidden":
            words.append("hidden")
        else:
            words += [f"{name[0]}:{w}" if name == "role" else w for w in _WORD.findall(value.lower())]
    if _HIDDEN.search(attrs):
        words.append("hidden")
    return tuple(dict.fromkeys(words)), label


def parse(page: str) -> Tree:
    """The tree of a page's body; the head, scripts, styles, form values, titles, comments and markup leave nothing.

    Unclosed and misplaced tags follow HTML's usual repairs (a block ends an open
    paragraph, an item its predecessor, a stray end tag nothing)."""
    t = Tree()
    stack = [("body", t.add(-1, "body", ()))]  # open elements; inline ones share their block's node
    piece: list[str] = []
    state = [0, 0, 0]  # open links, characters of the current text inside them, open foreign elements
    labels = [None]
    at, n = 0, len(page)

    def text(raw: str) -> None:
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            piece.append(raw)
            if state[0]:
                state[1] += len(raw)

    def flush() -> None:
        if piece:
            s = " ".join("".join(piece).split())
            if s:
                t.add(stack[-1][1], "#text", (), s, min(state[1], len(s)), labels[-1])
            piece.clear()
        state[1] = 0

    def close(upto: int) -> None:
        while len(stack) > upto:
            name, node = stack.pop()
            labels.pop()
            if name == "a":
                state[0] -= 1
            state[2] -= name in _FOREIGN
            if node != stack[-1][1]:
                stack.append((name, node))
                labels.append(t.label[node] if t.label[node] is not None else None)
                flush()
                stack.pop()
                labels.pop()

    while at < n:
        i = page.find("<", at)
        if i < 0:
            text(page[at:])
            break
        text(page[at:i])
        m = _TAG.match(page, i)
        if not m:
            rest = page[i + 1:i + 2]
            if rest.isalpha() or rest in ("/", "!"):  # a tag that the page's end cuts off
                break
            text("<")
            at = i + 1
            continue
        at = m.end()
        if m["comment"] is not None:
            end = page.find("-->", i + 4)
            at = n if end < 0 else end + 3
            continue
        name = m["name"] or (re.match(r"/?([a-zA-Z][^\s/>]*)", m["loose"])[1] if m["loose"] else None)
        if not name:
            continue
        name = name.lower()
        if m["close"] or (m["loose"] or "").startswith("/"):
            if name in _VOID:
                if name == "br":
                    text(" ")
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if name in _INLINE and stack[k][0] not in _INLINE:
                    break  # an inline end tag ends nothing beyond its block
            continue
        if (state[2] or name in _FOREIGN) and (m["attrs"] or m["loose"] or "").endswith("/"):
            continue
        if name in _RAW:
            end = _RAW[name].search(page, at)
            at = n if end is None else end.end()
            continue
        if name in ("html", "body"):
            words, _ = _attributes(m["attrs"] or "")
            t.words[0] = tuple(dict.fromkeys(t.words[0] + words))
            continue
        if name == "head":
            end = re.compile(r"</head\b[^>]*>|<body\b", re.I).search(page, at)
            if end:
                at = end.end() if end[0][1] == "/" else end.start()
            continue
        if name in _VOID:
            if name in ("br", "hr"):
                text(" ")
                if name == "hr":
                    flush()
            elif name == "input":
                flush()
                t.add(stack[-1][1], "input", ())
            continue
        words, label = _attributes(m["attrs"] or m["loose"] or "")
        if state[2] and (name in _CLOSES_P or name in _SIBLINGS):  # a block ends an unclosed drawing or formula
            close(next(k for k, e in enumerate(stack) if e[0] in _FOREIGN))
        if state[2] or name in _INLINE or name in _FOREIGN:
            stack.append((name, stack[-1][1]))
            labels.append(label if label is not None else labels[-1])
            state[0] += name == "a"
            state[2] += name in _FOREIGN
            continue
        if name in _CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] not in _INLINE:
                    break
        ends = _SIBLINGS.get(name)
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    close(k)
                    if name in ("td", "th", "option", "li", "dt", "dd"):
                        break
                elif stack[k][0] in _SCOPE:
                    break
        flush()
        node = t.add(stack[-1][1], name, words, label=label)
        stack.append((name, node))
        labels.append(label)
    close(1)
    flush()
    return t


_TAGS = {t: i for i, t in enumerate("body div p article section main header footer nav aside ul ol li h1 h2 h3 h4 h5 h6 table tr td th tbody blockquote pre form button label select option figure figcaption dl dt dd input fieldset details #text".split())}
#: Feature groups: bias, tag, parent's tag, measures of text blocks, measures of elements, hashed words.
_MEASURES = 12
_F_TAG, _F_PARENT = 1, 1 + len(_TAGS) + 1
_F_TEXT = _F_PARENT + len(_TAGS) + 1
_F_ELEMENT = _F_TEXT + _MEASURES
_F_WORD = _F_ELEMENT + _MEASURES
N_FEATURES = _F_WORD + HASHED


def _bucket(word: str) -> int:
    h = 2166136261
    for c in word.encode():
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return _F_WORD + h % HASHED


_bucket = lru_cache(1 << 16)(_bucket)


@dataclass
class Forest:
    parent: np.ndarray
    level: np.ndarray
    leaf: np.ndarray     # is a text block
    page: np.ndarray
    node: np.ndarray     # (node, feature) pairs of the features that are 1
    feature: np.ndarray
    group: np.ndarray    # kind of the edge to the parent


def forest(trees: list[Tree]) -> Forest:
    """The features and edges of some pages as arrays."""
    parent, level, leaf, page, node, feature, group = [], [], [], [], [], [], []
    base = 0
    for p, t in enumerate(trees):
        m = len(t.parent)
        depth, chars, links, marks, paragraphs, inputs = [0] * m, [0] * m, [0] * m, [0] * m, [0] * m, [0] * m
        for i in range(m):
            if t.parent[i] >= 0:
                depth[i] = depth[t.parent[i]] + 1
            s = t.text[i]
            if s is not None:
                chars[i], links[i] = len(s), t.linked[i]
                marks[i] = s.count(".") + s.count(",") + s.count("?") + s.count("!") + s.count(";")
            if t.tag[i] == "p":
                paragraphs[i] += 1
            if t.tag[i] in ("input", "button", "select", "label"):
                inputs[i] += 1
        for i in range(m - 1, 0, -1):
            q = t.parent[i]
            chars[q] += chars[i]
            links[q] += links[i]
            marks[q] += marks[i]
            paragraphs[q] += paragraphs[i]
            inputs[q] += inputs[i]
        total = max(1, chars[0])
        seen = 0
        for i in range(m):
            q = t.parent[i]
            tag = _TAGS.get(t.tag[i], len(_TAGS))
            above = _TAGS.get(t.tag[q], len(_TAGS)) if q >= 0 else len(_TAGS)
            f = [0, _F_TAG + tag, _F_PARENT + above]
            size, density = chars[i], links[i] / max(1, chars[i])
            if t.text[i] is not None:
                f += [_F_TEXT + (0 if size < 15 else 1 if size < 40 else 2 if size < 100 else 3 if size < 300 else 4),
                      _F_TEXT + (5 if density < 0.2 else 6 if density < 0.7 else 7)]
                if marks[i] >= 2:
                    f.append(_F_TEXT + 8)
                if marks[i] == 0:
                    f.append(_F_TEXT + 9)
                if seen / total > 0.9:
                    f.append(_F_TEXT + 10)
                if seen / total < 0.1:
                    f.append(_F_TEXT + 11)
                seen += size
            else:
                share = size / total
                f += [_F_ELEMENT + (0 if share < 0.05 else 1 if share < 0.2 else 2 if share < 0.5 else 3),
                      _F_ELEMENT + (4 if density < 0.2 else 5 if density < 0.7 else 6)]
                if paragraphs[i] >= 3:
                    f.append(_F_ELEMENT + 7)
                if inputs[i]:
                    f.append(_F_ELEMENT + 8)
                if size and marks[i] / size > 0.01:
                    f.append(_F_ELEMENT + 9)
                if size == 0:
                    f.append(_F_ELEMENT + 10)
                f += [_bucket(w) for w in t.words[i]]
            node += [base + i] * len(f)
            feature += f
            # an edge's potential depends on what hangs on what
            group.append(0 if q < 0 else 1 if t.text[i] is not None else 2 if q == 0 else 3)
        parent += [base + q if q >= 0 else -1 for q in t.parent]
        level += depth
        leaf += [s is not None for s in t.text]
        page += [p] * m
        base += m
    a = lambda x, k=np.int64: np.array(x, k)
    return Forest(a(parent), a(level), a(leaf, bool), a(page), a(node), a(feature), a(group))


@dataclass
class Model:
    weight: np.ndarray  # of each feature for label 1
    edge: np.ndarray    # [group, parent's label, child's label]


def marginals(f: Forest, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum-product on every tree: (probability of label 1, pair probabilities [node, parent's label, own
    label], log of each tree's normaliser at its root)."""
    n = len(f.parent)
    score = np.zeros((n, 2))
    score[:, 1] = np.bincount(f.node, model.weight[f.feature], n)
    up = score.copy()                     # own score plus the children's messages
    message = np.zeros((n, 2))            # to the parent
    deepest = int(f.level.max(initial=0))
    by_level = [np.flatnonzero(f.level == d) for d in range(deepest + 1)]
    for d in range(deepest, 0, -1):
        i = by_level[d]
        z = model.edge[f.group[i]] + up[i][:, None, :]
        top = z.max(2)
        message[i] = top + np.log(np.exp(z - top[:, :, None]).sum(2))
        for y in (0, 1):
            up[:, y] += np.bincount(f.parent[i], message[i, y], n)
    down = np.zeros((n, 2))               # message from the parent
    belief = np.zeros((n, 2))
    pair = np.zeros((n, 2, 2))
    root = by_level[0]
    logz = np.logaddexp(up[root, 0], up[root, 1])
    belief[root] = np.exp(up[root] - logz[:, None])
    for d in range(1, deepest + 1):
        i = by_level[d]
        q = f.parent[i]
        rest = up[q] + down[q] - message[i]  # the parent without this child
        z = rest[:, :, None] + model.edge[f.group[i]]
        top = z.max(1)
        down[i] = top + np.log(np.exp(z - top[:, None, :]).sum(1))
        joint = z + up[i][:, None, :]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        pair[i] = joint / joint.sum((1, 2), keepdims=True)
        belief[i] = pair[i].sum(1)
    return belief[:, 1], pair, logz


def labels_of(trees: list[Tree]) -> np.ndarray:
    """Labels of all nodes: text blocks as marked, an element by the larger part of its text."""
    out = []
    for t in trees:
        m = len(t.parent)
        yes, all_ = [0.0] * m, [0.0] * m
        for i in range(m - 1, -1, -1):
            if t.text[i] is not None:
                all_[i], yes[i] = len(t.text[i]), len(t.text[i]) * (t.label[i] or 0)
            if t.parent[i] >= 0:
                yes[t.parent[i]] += yes[i]
                all_[t.parent[i]] += all_[i]
        out += [int(2 * a > b) for a, b in zip(yes, all_)]
    return np.array(out)


def train(pages: list[str], steps: int = STEPS) -> Model:
    """Weights of largest penalised likelihood of labelled pages, by gradient steps (Adam)."""
    trees = [parse(p) for p in pages]
    f, y = forest(trees), labels_of(trees)
    model = Model(np.zeros(N_FEATURES), np.zeros((4, 2, 2)))
    inner = np.flatnonzero(f.parent >= 0)
    seen_w = np.bincount(f.feature, y[f.node], N_FEATURES)
    seen_e = np.zeros_like(model.edge)
    np.add.at(seen_e, (f.group[inner], y[f.parent[inner]], y[inner]), 1)
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (model.weight, model.edge)]
    for t in range(1, steps + 1):
        p, pair, _ = marginals(f, model)
        want_e = np.zeros_like(model.edge)
        np.add.at(want_e, f.group[inner], pair[inner])
        for x, g, (m, v) in zip((model.weight, model.edge), (seen_w - np.bincount(f.feature, p[f.node], N_FEATURES), seen_e - want_e), state):
            g = g / len(pages) - PENALTY * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return model


def main_texts(pages: list[str], model: Model) -> list[str]:
    """The main text of each page: its likely text blocks in page order, joined by a space."""
    trees = [parse(p) for p in pages]
    f = forest(trees)
    p, _, _ = marginals(f, model)
    keep = iter((p > 0.5).tolist())
    out = []
    for t in trees:
        out.append(" ".join(s for s, k in zip(t.text, [next(keep) for _ in t.text]) if s is not None and k))
    return out


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Model | None = None) -> DataFrame:
    """``id, url, text, n_chars`` of every row; null or empty html gives the empty text, and so does a page
    without likely main text.  Rows keep their number and their url, also null and repeated ones."""
    pages = only(df, id=id_col, url=url_col, html=html_col)
    shared = df.sparkSession.sparkContext.broadcast(model or train(labelled_pages(PAGES)))

    def run(batches):
        for b in batches:
            texts, some, size = [], [], 0
            for s in b.column(2):
                s = s.as_py() or ""
                some.append(s)
                size += len(s)
                if size > FOREST:
                    texts += main_texts(some, shared.value)
                    some, size = [], 0
            if some:
                texts += main_texts(some, shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(s) for s in texts], pa.int64())],
                                             ["id", "url", "text", "n_chars"])

    return arrow_map(pages, run, f"id {pages.schema['id'].dataType.simpleString()}, url string, text string, n_chars long")


def op2_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
