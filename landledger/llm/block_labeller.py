"""Main-text extraction by a recurrent labeller of page blocks.

A page becomes the sequence of its leaf blocks: runs of text between block-level
tags. Each block is a vector of its hashed tag path (tags with their class, id
and role words), its hashed words and a few counts. A bidirectional LSTM reads
the whole sequence, so that every block is labelled with the page before and
after it in view. Blocks labelled as content are joined in page order.

Training data come from the pages themselves, at most ``MAX_PAGES`` of them. A
block's label is what its markup says (inside an article or main element and in
none of the boilerplate sections). To teach more than this corpus shows,
sections of each kind of boilerplate are inserted with text of other pages,
the article's element is varied, and path features are dropped at random, so
that neighbours and words must carry the decision. Everything is numpy; the
network is trained on the driver and shipped to the tasks, which map over whole
pages.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.shared import hashed_sample, table

# Bounds of the training sample only.
MAX_PAGES, MAX_BLOCKS = 300, 150
PATH_SLOTS, WORD_SLOTS, COUNTS = 96, 32, 6
WIDTH = PATH_SLOTS + WORD_SLOTS + COUNTS
HIDDEN = 16
EPOCHS, BATCH, RATE = 20, 16, 0.01
CELLS = 20_000  # blocks that are labelled at once

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template title textarea iframe object svg math select head".split())
_OPAQUE = frozenset("script style title textarea iframe noscript".split())
# What may stand in a head; what ends an unclosed svg or math; what cannot stand in a select.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_PAGE = frozenset(
    "address article aside blockquote body dl figure footer form h1 h2 h3 h4 h5 h6 header main nav ol p pre section table ul".split()
)
_BREAKOUT = _PAGE | frozenset(
    "b big br center code dd div dt em embed hr i img li listing menu nobr ruby s small span strike strong sub sup tt u var".split()
)
_ANY_CONTENT = frozenset("template object foreignobject desc annotation-xml".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = frozenset("ul ol dl table article section div nav aside header footer main body form blockquote".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


def _node(tag: str, attributes: str) -> str:
    """A path element: the tag and the words of its class, id and role."""
    if "=" not in attributes:
        return tag
    words = [w.rstrip("s") for m in _NAMED.finditer(attributes) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())]
    return " ".join([tag, *words])


def _hidden_end(stack: list[str], tag: str) -> int | None:
    """Place of the outermost hidden element that the start of ``tag`` shows to be over."""
    found = None
    for k in range(len(stack) - 1, -1, -1):
        top = stack[k]
        if top in _ANY_CONTENT:
            break
        if top == "head" and tag not in _IN_HEAD or top in ("svg", "math") and tag in _BREAKOUT or top == "select" and tag in _PAGE:
            found = k
    return found


def leaf_blocks(page: str | None) -> list[tuple[tuple[str, ...], str]]:
    """(path, text) of every leaf block with text, in page order.

    Character references are decoded and white space is one space. Scripts,
    styles, comments, titles and other elements that are not shown give no
    block. Unclosed and stray tags are forgiven: a head ends where text or a tag
    begins that cannot stand in it, svg, math and select at a tag of the page.
    An object or template may hold any tag and ends with its end tag or that of
    an ancestor. A text without tags is one block.
    """
    page = page or ""
    blocks: list[tuple[tuple[str, ...], str]] = []
    stack: list[str] = []
    nodes: list[str] = []
    parts: list[str] = []
    hidden = 0
    at = 0

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                blocks.append((path[0], text))

    path = [()]

    def add(text: str):
        nonlocal hidden
        if hidden and stack[-1] == "head" and text.strip():
            hidden -= 1
            del stack[-1], nodes[-1]
        if text and not hidden:
            if not parts:
                if text.isspace():
                    return
                path[0] = tuple(nodes)
            parts.append(text)

    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        if tag not in _INLINE:
            flush()
        if closing:
            if tag in stack:
                while True:
                    top = stack.pop()
                    nodes.pop()
                    hidden -= top in _RAW
                    if top == tag:
                        break
            continue
        over = _hidden_end(stack, tag) if hidden else None
        if over is not None:
            hidden -= sum(t in _RAW for t in stack[over:])
            del stack[over:], nodes[over:]
        attributes = m[3] or m[6] or ""
        if tag in _VOID or attributes.endswith("/"):
            continue
        if tag in _OPAQUE:
            end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        ended = _CLOSES.get(tag) or ({"p"} if tag not in _INLINE else None)
        if ended:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in ended:
                    hidden -= sum(t in _RAW for t in stack[k:])
                    del stack[k:], nodes[k:]
                    break
                if stack[k] in _SCOPE:
                    break
        stack.append(tag)
        nodes.append(_node(tag, attributes))
        hidden += tag in _RAW
    flush()
    return blocks


def _slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % slots


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH_SLOTS, np.float32)
    for depth, node in enumerate(path):
        words = node.split(" ")
        out[_slot(words[0], PATH_SLOTS)] = 1
        for w in words[1:]:
            out[_slot("." + w, PATH_SLOTS)] = 1
    if path:
        out[_slot("last " + path[-1].split(" ")[0], PATH_SLOTS)] = 1
    return out


def block_vectors(blocks: list[tuple[tuple[str, ...], str]], paths: dict) -> np.ndarray:
    """blocks x WIDTH. ``paths`` remembers the vectors of paths seen."""
    out = np.zeros((len(blocks), WIDTH), np.float32)
    total = len(blocks)
    for i, (path, text) in enumerate(blocks):
        vector = paths.get(path)
        if vector is None:
            if len(paths) > 20_000:
                paths.clear()
            vector = paths[path] = path_vector(path)
        row = out[i]
        row[:PATH_SLOTS] = vector
        words = text.split(" ")
        distinct = set(words)
        for w in distinct:
            row[PATH_SLOTS + _slot(w.lower(), WORD_SLOTS)] += 1
        row[PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] /= np.sqrt(len(distinct))
        row[-6:] = (
            np.log1p(len(words)) / 5, len(distinct) / len(words), (text[-1] in ".!?") * 1.0,
            i / total, "a" in {p.split(" ")[0] for p in path}, len(path) / 10,
        )
    return out


@dataclass
class Network:
    """Weights of both directions (index 0 forwards, 1 backwards) and of the output."""

    inputs: list[np.ndarray]
    states: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, *self.biases, self.out, self.bias]


def new_network(seed: int = 11) -> Network:
    draw = np.random.default_rng(seed)
    make = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    biases = []
    for _ in range(2):
        b = np.zeros(4 * HIDDEN, np.float32)
        b[HIDDEN : 2 * HIDDEN] = 1  # gates start open
        biases.append(b)
    return Network(
        [make(WIDTH, 4 * HIDDEN) for _ in range(2)], [make(HIDDEN, 4 * HIDDEN) for _ in range(2)], biases,
        make(2 * HIDDEN, 1)[:, 0], np.zeros(1, np.float32),
    )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(gates: np.ndarray, state: np.ndarray, live: np.ndarray, back: bool, keep: list | None = None) -> np.ndarray:
    """Hidden states of one direction; ``gates`` is pages x blocks x 4 HIDDEN of inputs."""
    n, t, _ = gates.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out = np.zeros((n, t, HIDDEN), np.float32)
    for k in range(t - 1, -1, -1) if back else range(t):
        on = live[:, k, None]
        z = gates[:, k] + h @ state
        i, f, o = (_sigmoid(z[:, j * HIDDEN : (j + 1) * HIDDEN]) for j in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        if keep is not None:
            keep.append((k, h, c, i, f, o, g, tanh_c, on))
        c = np.where(on, new_c, c)
        h = np.where(on, o * tanh_c, h)
        out[:, k] = h
    return out


def label_probabilities(x: np.ndarray, live: np.ndarray, net: Network) -> np.ndarray:
    """Probability of content for pages x blocks (padding where ``live`` is False)."""
    hidden = [_run(x @ net.inputs[d] + net.biases[d], net.states[d], live, bool(d)) for d in (0, 1)]
    return _sigmoid(np.concatenate(hidden, -1) @ net.out + net.bias)


def _gradients(x: np.ndarray, live: np.ndarray, y: np.ndarray, net: Network) -> list[np.ndarray]:
    """Back-propagation through time of the mean cross entropy over live blocks."""
    tapes: list[list] = [[], []]
    hidden = [_run(x @ net.inputs[d] + net.biases[d], net.states[d], live, bool(d), tapes[d]) for d in (0, 1)]
    both = np.concatenate(hidden, -1)
    p = _sigmoid(both @ net.out + net.bias)
    error = ((p - y) * live / max(live.sum(), 1)).astype(np.float32)
    grad_out, grad_bias = np.einsum("ntk,nt->k", both, error), error.sum(keepdims=True).reshape(1)
    result: list[list[np.ndarray]] = [[], [], []]
    for d in (0, 1):
        from_out = error[..., None] * net.out[d * HIDDEN : (d + 1) * HIDDEN]
        dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        grad_state = np.zeros_like(net.states[d])
        dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
        for k, h, c, i, f, o, g, tanh_c, on in reversed(tapes[d]):
            dh = dh + from_out[:, k]
            inner_h, inner_c = dh * on, dc * on
            inner_c = inner_c + inner_h * o * (1 - tanh_c**2)
            dz = np.concatenate(
                [inner_c * g * i * (1 - i), inner_c * c * f * (1 - f), inner_h * tanh_c * o * (1 - o), inner_c * i * (1 - g**2)], 1
            )
            dz_all[:, k] = dz
            grad_state += h.T @ dz
            dh = dh * ~on + dz @ net.states[d].T
            dc = dc * ~on + inner_c * f
        result[0].append(np.einsum("ntw,ntz->wz", x, dz_all, optimize=True))
        result[1].append(grad_state)
        result[2].append(dz_all.sum((0, 1)))
    return [*result[0], *result[1], *result[2], grad_out, grad_bias]


_CONTENT = frozenset(("article", "main"))
_BOILERPLATE = frozenset("nav header footer aside form ad advert sidebar menu cookie notice comment banner".split())
# Markup of inserted boilerplate: (opening path elements, block elements).
_SECTIONS = [
    (("nav",), ("ul", "li", "a")), (("div menu",), ("ul", "li", "a")), (("header",), ("h1",)), (("header",), ("p",)),
    (("div header",), ("div",)), (("footer",), ("p",)), (("div footer",), ("ul", "li", "a")), (("aside",), ("p",)),
    (("aside",), ("h3",)), (("aside",), ("ul", "li", "a")), (("div sidebar",), ("ul", "li", "a")), (("div sidebar",), ("p",)),
    (("div widget",), ("p",)), (("div cookie notice",), ("p",)), (("div cookie banner",), ()), (("div notice",), ("p",)),
    (("div consent",), ("button",)), (("div ad",), ()), (("div advert",), ("p",)), (("div sponsor",), ("a",)),
    (("div promo",), ("p",)), (("form",), ("label",)), (("form search",), ("button",)), (("form",), ("p",)),
    (("section comment",), ("h2",)), (("div comment",), ("p",)), (("div comment",), ("div comment body", "p")),
    (("ul comment",), ("li comment", "p")), (("ol comment",), ("li", "p")), (("div related",), ("ul", "li", "a")),
    (("div share",), ("a",)), (("div social",), ("a",)), (("div breadcrumb",), ("a",)), (("div pagination",), ("a",)),
    (("div newsletter",), ("p",)), (("div popup",), ("p",)), (("div",), ("ul", "li", "a")),
]
_INSIDE = [k for k, (opening, _) in enumerate(_SECTIONS) if any(w in opening[0] for w in ("ad", "comment", "aside", "related", "share", "form", "newsletter", "sponsor", "promo", "notice"))]
_ARTICLES = [
    "article", "article", "article", "main", "div content", "div article", "div post", "div entry content", "section article",
    "div post body", "div main", "div story",
]
# What text of an article may stand in besides paragraphs and headings.
_BODIES: list[tuple[str, ...]] = [
    ("ul", "li"), ("ol", "li"), ("blockquote",), ("blockquote", "p"), ("pre",), ("table", "tr", "td"), ("dl", "dd"),
    ("h1",), ("h2",), ("h3",), ("div",), ("div", "p"), ("section", "p"), ("figure", "figcaption"), (),
]
_FILLERS = ["div", "section", "div wrapper", "div container", "div row"]


def markup_label(path: tuple[str, ...]) -> int:
    words = {w for node in path for w in node.split(" ")}
    return int(bool(words & _CONTENT) and not words & _BOILERPLATE)


def _varied(blocks, labels, texts: list[str], draw) -> tuple[list, list]:
    """A training page with other markup and inserted boilerplate."""
    article = _ARTICLES[draw.integers(len(_ARTICLES))]
    fillers = tuple(_FILLERS[i] for i in draw.integers(len(_FILLERS), size=draw.integers(0, 3)))
    out: list[tuple] = []
    found: list[int] = []

    def insert(prefix: tuple[str, ...], kinds) -> None:
        opening, inner = _SECTIONS[kinds[draw.integers(len(kinds))]]
        for _ in range(draw.integers(1, 5)):
            words = texts[draw.integers(len(texts))].split(" ")
            count = int(draw.integers(1, 4)) if inner[-1:] in (("a",), ("button",), ("label",)) else int(draw.integers(2, 60))
            out.append(((*prefix, *opening, *inner), " ".join(words[:count])))
            found.append(0)

    every = range(len(_SECTIONS))
    base: tuple[str, ...] = ("html", "body", *fillers)
    for _ in range(draw.integers(0, 4)):
        insert(base, every)
    inside = False
    for (path, text), label in zip(blocks, labels):
        if label:
            inside = True
            last = next(k for k, node in enumerate(path) if node.split(" ")[0] in _CONTENT)
            rest = path[last + 1 :]
            if rest[:1] == ("h1",) and draw.random() < 0.3:
                rest = ("header", *rest)
            if draw.random() < 0.15:
                rest = _BODIES[draw.integers(len(_BODIES))]
            if draw.random() < 0.15:
                text = " ".join(text.split(" ")[: draw.integers(1, 8)])
            path = (*base, article, *rest)
            if draw.random() < 0.04:
                insert((*base, article), _INSIDE)
        elif inside:
            inside = False
            for _ in range(draw.integers(0, 3)):
                insert((*base, article) if draw.random() < 0.3 else base, _INSIDE)
        out.append((path, text))
        found.append(label)
    for _ in range(draw.integers(0, 4)):
        insert(base, every)
    return _stretch(out, found, draw)


def _stretch(blocks: list, labels: list, draw) -> tuple[list, list]:
    """At most MAX_BLOCKS blocks in a row, from anywhere in a page; its ends come as often as its middle."""
    rest = len(blocks) - MAX_BLOCKS
    if rest <= 0:
        return blocks, labels
    begin = (0, rest, int(draw.integers(rest + 1)))[draw.integers(3)]
    return blocks[begin : begin + MAX_BLOCKS], labels[begin : begin + MAX_BLOCKS]


def train(pages: list[list[tuple[tuple[str, ...], str]]], seed: int = 5) -> Network:
    """Fit the network to marked-up pages (lists of leaf blocks). Deterministic.

    Pages that have no block inside an article or main element do not teach;
    without any page that does, the untrained network's output is replaced by
    the rule that long blocks outside links are content.
    """
    net, draw = new_network(), np.random.default_rng(seed)
    marked = [(p, [markup_label(path) for path, _ in p]) for p in pages]
    marked = [(p, y) for p, y in marked if any(y)]
    if not marked:
        return _by_length(net)
    texts = [text for p, _ in marked for _, text in p]
    first = [np.zeros_like(w) for w in net.parameters()]
    second = [np.zeros_like(w) for w in net.parameters()]
    paths: dict = {}
    step = 0
    for epoch in range(EPOCHS):
        sample = []
        for p, y in marked:
            blocks, labels = _stretch(p, y, draw) if draw.random() < 0.3 else _varied(p, y, texts, draw)
            x = block_vectors(blocks, paths)
            if draw.random() < 0.3:
                x[:, :PATH_SLOTS] *= draw.random((1, PATH_SLOTS)) > 0.2
            sample.append((x, np.array(labels, np.float32)))
        sample.sort(key=lambda s: len(s[0]))
        starts = np.arange(0, len(sample), BATCH)
        for begin in draw.permutation(starts):
            some = sample[begin : begin + BATCH]
            longest = max(len(x) for x, _ in some)
            x = np.zeros((len(some), longest, WIDTH), np.float32)
            y, live = np.zeros((len(some), longest), np.float32), np.zeros((len(some), longest), bool)
            for k, (vectors, labels) in enumerate(some):
                x[k, : len(vectors)], y[k, : len(labels)], live[k, : len(labels)] = vectors, labels, True
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, (w, g) in enumerate(zip(net.parameters(), _gradients(x, live, y, net))):
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _by_length(net: Network) -> Network:
    for w in net.parameters():
        w[...] = 0
    net.inputs[0][-6, 3 * HIDDEN], net.inputs[0][-2, 3 * HIDDEN] = 4.0, -6.0
    net.biases[0][:] = 0
    net.biases[0][HIDDEN : 2 * HIDDEN] = -30  # no memory
    net.biases[0][3 * HIDDEN] = -1.5
    net.out[0] = 10
    return net


def extract(pages: list[str | None], net: Network, paths: dict) -> list[str]:
    """Main text of every page. Pages with like numbers of blocks run together."""
    blocks = [leaf_blocks(p) for p in pages]
    sizes = np.array([len(b) for b in blocks])
    out = [""] * len(pages)
    order = [i for i in np.argsort(sizes, kind="stable") if sizes[i]]
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < len(order) and (end - begin + 1) * sizes[order[end]] <= CELLS:
            end += 1
        some = order[begin:end]
        x = np.zeros((len(some), sizes[some[-1]], WIDTH), np.float32)
        live = np.zeros(x.shape[:2], bool)
        for k, i in enumerate(some):
            x[k, : sizes[i]], live[k, : sizes[i]] = block_vectors(blocks[i], paths), True
        p = label_probabilities(x, live, net)
        for k, i in enumerate(some):
            out[i] = " ".join(text for (_, text), q in zip(blocks[i], p[k]) if q >= 0.5)
        begin = end
    return out


def fit(pages: DataFrame, max_pages: int = MAX_PAGES) -> Network:
    """Train on the ``max_pages`` pages of least hashed id."""
    # sampling only: pages are labelled whole
    known = pages.filter("html IS NOT NULL").select("page_id", "html")
    sample = hashed_sample(known, "page_id", max_pages).collect()
    return train([leaf_blocks(html) for html in sorted(r.html for r in sample)])


def with_main_text(pages: DataFrame, net: Network) -> DataFrame:
    """Pages with ``text`` and ``n_chars`` (code points); the columns are replaced if they exist.

    A NULL or empty html, or one without content, gives an empty text. Rows are
    neither dropped nor joined.
    """

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        paths: dict = {}
        for pages in batches:
            out, portion, size = [], [], 0
            for page in pages:
                portion.append(page)
                size += len(page or "")
                if size > 2_000_000:
                    out += extract(portion, net, paths)
                    portion, size = [], 0
            yield pd.Series(out + extract(portion, net, paths), dtype=object)

    return pages.drop("text", "n_chars").withColumn("text", main_text("html")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


def op10_block_labeller(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return with_main_text(pages, fit(pages)).select("page_id", "url", "text", "n_chars")
