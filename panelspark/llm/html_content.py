"""Main text of pages by a tree-structured graphical model.

Every block element of a page is a node with the label main text or not. Node potentials come from the
element's name, its class words and its text; edge potentials tie a child's label to its parent's.
Sum-product messages run once up and once down the tree and give the exact marginals. The potentials
are trained by maximum likelihood on labelled pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html import unescape
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import quoted
from panelspark.llm.labelled_pages import LABELLED_PAGES

# Elements by role (fixed values).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img area param source track "
    # Formulas
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts none mtable mtr mtd maction semantics".split()
)
#: Nothing below these is text of the page: scripts, styles, drawings, frames, parts of forms, what is never
#: shown (a formula's source in another notation, templates).
HIDDEN = frozenset(
    "script style template head title svg iframe select option button textarea datalist annotation "
    "annotation-xml".split()
)
#: Their text stands in for what cannot be shown. It is text of the block around or, outside any block, a
#: node of its own.
FALLBACK = frozenset("object audio video noscript canvas map".split())
#: What a head holds; any other element ends a head without an end tag.
IN_HEAD = frozenset("base link meta script style noscript template title".split())
#: Elements that end an unclosed drawing, and the parts of one that hold elements of the page.
ENDS_SVG = frozenset(
    "article aside b blockquote br center code dd div dl dt em footer h1 h2 h3 h4 h5 h6 header hr i img li main "
    "menu nav ol p pre ruby s section small span strong sub sup table tt u ul var".split()
)
IN_SVG = ("foreignobject", "desc", "title")
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: A start tag that ends open elements: the element, those that it ends, and where the search stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
TAG_GROUPS = {
    "paragraph": "p pre blockquote figure figcaption",
    "heading": "h1 h2 h3 h4 h5 h6",
    "list": "ul ol dl li dt dd menu",
    "table": "table tbody thead tfoot tr td th caption",
    "article": "article",
    "main": "main",
    "container": "div section center html body object audio video noscript canvas map",
    "nav": "nav",
    "header": "header",
    "footer": "footer address",
    "aside": "aside",
    "form": "form fieldset label legend input",
}
#: Words of class, id and role attributes by what they point to.
CLASS_WORDS = {
    "is_main": "article content main post entry story body text maintext",
    "is_nav": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toolbar tabs",
    "is_header": "header masthead logo topbar",
    "is_footer": "footer contentinfo copyright imprint legal",
    "is_side": "sidebar aside related widget complementary recommended popular teaser rail",
    "is_notice": "cookie cookies notice banner alert consent popup modal overlay gdpr message warning",
    "is_ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion promoted adsense",
    "is_form": "form subscribe newsletter login signup search register",
    "is_comment": "comment comments reply replies disqus discussion respond feedback reader readers",
    "is_meta": "share social byline tags author meta toolbox print",
}
_GROUP_OF = {t: g for g, ts in TAG_GROUPS.items() for t in ts.split()}
_CLASS_OF = {w: g for g, ws in CLASS_WORDS.items() for w in ws.split()}
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")

FEATURES = [
    "bias", *TAG_GROUPS, "other_tag", *CLASS_WORDS,
    "empty", "tiny", "short", "medium", "long", "linked", "half_linked", "sentence", "mark",
]
_NUMBER = {f: i for i, f in enumerate(FEATURES)}
#: Edge potentials differ by the child's kind.
EDGE_KINDS = ("text", "box", "other")
_TEXTUAL = frozenset({"paragraph", "heading", "list", "table"})


@dataclass
class Page:
    """Block elements in page order (a parent comes before its children) and their runs of text."""

    parents: list[int]
    features: list[list[int]]
    kinds: list[int]
    labels: list[int]
    runs: list[tuple[int, str]]


# A comment ends at --> or --!>; <!--> and <!---> are whole ones.
_COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>)", re.S)
# Attribute values in quotes may hold ">"; possessive repeats keep the match linear.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(
    r"(class|id|role|data-main)\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>\"']++))", re.IGNORECASE
)
#: Elements whose content is text up to their end tag.
RAW = {
    name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE)
    for name in ("script", "style", "textarea", "title", "iframe")
}


class _Reader:
    """Collects nodes and runs of text; tolerant of missing and stray end tags."""

    def __init__(self) -> None:
        self.parents, self.tags, self.words, self.labels = [-1], ["html"], [[]], [0]
        self.stack = [0]
        self.open: dict[str, int] = {"html": 1}
        self.hidden: list[str] = []  # a hidden element and the open elements in it
        self.inside: dict[str, int] = {}  # their number by name
        self.linked = 0
        self.runs: list[tuple[int, list[str]]] = []
        self.text_size, self.link_size = [0], [0]
        self.broken = True

    def feed(self, html: str) -> None:
        """Walks from tag to tag. A tag that the text ends in is dropped, as is an open comment."""
        at, end, strict = 0, len(html), True
        while at < end:
            less = html.find("<", at)
            if less < 0:
                self.handle_data(html[at:])
                return
            if less > at:
                self.handle_data(html[at:less])
            match = _TAG.match(html, less) if strict else None
            if match is None:
                # An odd quote would be looked for to the end again and again.
                match = _LOOSE_TAG.match(html, less)
                strict = strict and match is None
            if match:
                at, name = match.end(), match[2].lower()
                if match[1]:
                    self.handle_endtag(name)
                    continue
                empty = match[3].endswith("/") and (
                    name in {"svg", "math"} or bool(self.inside.get("svg"))
                )
                if empty:
                    continue
                self.handle_starttag(name, match[3])
                if name in RAW:
                    close = RAW[name].search(html, at)
                    at = close.start() if close else end
            elif html.startswith("<!--", less):
                close = _COMMENT.match(html, less)
                at = close.end() if close else end
            elif html[less + 1 : less + 2] in {"!", "?", "/"} or html[less + 1 : less + 2].isalpha():
                close = html.find(">", less + 2)
                at = close + 1 if close >= 0 else end
            else:
                self.handle_data("<")
                at = less + 1

    def handle_starttag(self, tag: str, attrs: str) -> None:
        if self.hidden:
            if tag in {"button", "select"} and self.inside.get(tag):
                self._show(tag)  # these do not nest
            elif tag == "body" or (self.hidden == ["head"] and tag not in IN_HEAD):
                self._show(self.hidden[0])
            elif tag in ENDS_SVG and self.inside.get("svg") and not any(map(self.inside.get, IN_SVG)):
                self._show("svg")
        if self.hidden or tag in HIDDEN:
            if tag not in VOID:
                self.hidden.append(tag)
                self.inside[tag] = self.inside.get(tag, 0) + 1
            return
        if tag in INLINE:
            if tag == "a":
                self.linked = 1
            elif tag == "br":
                self.handle_data(" ")
            return
        if tag in {"html", "body"}:
            self._attributes(0, attrs)
            self.broken = True
            return
        if tag in FALLBACK:
            if self.stack[-1] == 0:
                self._open(tag, attrs)
            return
        # A block ends an open paragraph, an item ends its predecessor.
        if self.open.get("p"):
            self._close("p")
        ends, stops = ENDS.get(tag, (set(), set()))
        for index in range(len(self.stack) - 1, 0, -1):
            name = self.tags[self.stack[index]]
            if name in ends:
                self._pop(index)
                if tag != "tr":
                    break
            elif name in stops or not ends:
                break
        self.broken = True
        if tag not in VOID:
            self._open(tag, attrs)

    def _open(self, tag: str, attrs: str) -> None:
        node = len(self.tags)
        self.parents.append(self.stack[-1])
        self.tags.append(tag)
        self.words.append([])
        self.labels.append(self.labels[self.stack[-1]])
        self.text_size.append(0)
        self.link_size.append(0)
        self._attributes(node, attrs)
        self.stack.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _attributes(self, node: int, attrs: str) -> None:
        if "=" not in attrs:
            return
        for match in _ATTRIBUTE.finditer(attrs):
            value = match[2] or match[3] or match[4] or ""
            if match[1].lower() == "data-main":
                self.labels[node] = int(value == "1")
            else:
                self.words[node] += [w.lower() for w in _SPLIT.split(value) if w]

    def _pop(self, index: int) -> None:
        for node in self.stack[index:]:
            self.open[self.tags[node]] -= 1
            if self.tags[node] not in FALLBACK:
                self.linked, self.broken = 0, True
        del self.stack[index:]

    def _show(self, tag: str) -> None:
        """Ends the innermost open ``tag`` of the hidden elements, with all in it."""
        while True:
            name = self.hidden.pop()
            self.inside[name] -= 1
            if name == tag:
                return

    def _close(self, tag: str) -> None:
        for index in range(len(self.stack) - 1, 0, -1):
            if self.tags[self.stack[index]] == tag:
                self._pop(index)
                return

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if self.inside.get(tag):
                self._show(tag)
                return
            # The end of an element around it ends a hidden element without an end tag.
            if not (self.linked if tag == "a" else tag not in {"html", "body"} and self.open.get(tag)):
                return
            self.hidden, self.inside = [], {}
        if tag == "a":
            self.linked = 0
        elif tag not in INLINE and tag not in {"html", "body"} and self.open.get(tag):
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        node = self.stack[-1]
        if "&" in data:
            data = unescape(data)
        blank = self.tags[node] in FALLBACK and not data.strip()
        if self.broken or not self.runs or (self.runs[-1][0] != node and not blank):
            if blank:
                return
            self.runs.append((node, []))
            self.broken = False
        self.runs[-1][1].append(data)
        size = len(data.strip())
        self.text_size[node] += size
        if self.linked:
            self.link_size[node] += size

    def drop_empty(self) -> None:
        """Takes out stand-ins without text, so that a picture's or a film's does not change the tree."""
        used = set(self.parents)
        kept = [
            node
            for node, tag in enumerate(self.tags)
            if tag not in FALLBACK or self.text_size[node] or node in used
        ]
        if len(kept) == len(self.tags):
            return
        number = {node: i for i, node in enumerate(kept)} | {-1: -1}
        self.parents = [number[self.parents[node]] for node in kept]
        for name in ("tags", "words", "labels", "text_size", "link_size"):
            values = getattr(self, name)
            setattr(self, name, [values[node] for node in kept])
        self.runs = [(number[node], parts) for node, parts in self.runs]


def read_page(html: str | None) -> Page:
    """The nodes and text runs of a page; one node and no run for an empty page."""
    reader = _Reader()
    reader.feed(html or "")
    reader.drop_empty()
    runs = [(node, " ".join("".join(parts).split())) for node, parts in reader.runs]
    own = [""] * len(reader.tags)
    for node, text in runs:
        own[node] = own[node] or text
    features, kinds = [], []
    for node, tag in enumerate(reader.tags):
        group = _GROUP_OF.get(tag)
        active = ["bias", group or "other_tag"]
        active += sorted({_CLASS_OF[w] for w in reader.words[node] if w in _CLASS_OF})
        size = reader.text_size[node]
        active.append(
            "empty" if not size else "tiny" if size < 20 else "short" if size < 80
            else "medium" if size < 300 else "long"
        )
        if size and reader.link_size[node] >= 0.8 * size:
            active.append("linked")
        elif size and reader.link_size[node] >= 0.3 * size:
            active.append("half_linked")
        if own[node].endswith((".", "!", "?", ":", '"')):
            active.append("sentence")
        if "©" in own[node] or "(c)" in own[node]:
            active.append("mark")
        features.append([_NUMBER[f] for f in active])
        kinds.append(0 if group in _TEXTUAL else 1 if group == "container" else 2)
    return Page(reader.parents, features, kinds, reader.labels, [r for r in runs if r[1]])


def _joint(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + log1p(exp(b - a)) if a > b else b + log1p(exp(a - b))


def marginals(
    page: Page, node_weights: Sequence[float], edge: Sequence[Sequence[float]]
) -> tuple[list[float], list[tuple[float, float, float, float]], float]:
    """Sum-product on the tree: P(main) by node, P(parent, child) by node's upper edge, log partition.

    ``edge[kind]`` has the potentials of (parent, child) = (0, 0), (0, 1), (1, 0), (1, 1). Messages are
    kept as logs, and as differences between the two labels where a common term does not matter.
    """
    n = len(page.parents)
    unary = [sum(node_weights[f] for f in fs) for fs in page.features]  # for label 1; 0 for label 0
    low, high = [0.0] * n, unary[:]  # what a node and all below it say for labels 0 and 1
    up = [(0.0, 0.0)] * n
    for node in range(n - 1, 0, -1):
        e, a, b = edge[page.kinds[node]], low[node], high[node]
        message = (_joint(e[0] + a, e[1] + b), _joint(e[2] + a, e[3] + b))
        up[node] = message
        parent = page.parents[node]
        low[parent] += message[0]
        high[parent] += message[1]
    log_partition = _joint(low[0], high[0])
    probability, pairs = [0.0] * n, [(0.0, 0.0, 0.0, 0.0)] * n
    top_low, top_high = [0.0] * n, [0.0] * n  # what all but the node's subtree says
    for node in range(n):
        if node:
            parent, e = page.parents[node], edge[page.kinds[node]]
            p0 = top_low[parent] + low[parent] - up[node][0]
            p1 = top_high[parent] + high[parent] - up[node][1]
            a, b = low[node], high[node]
            joint = (p0 + e[0] + a, p0 + e[1] + b, p1 + e[2] + a, p1 + e[3] + b)
            pairs[node] = tuple(exp(min(0.0, x - log_partition)) for x in joint)
            top_low[node], top_high[node] = _joint(p0 + e[0], p1 + e[2]), _joint(p0 + e[1], p1 + e[3])
        probability[node] = exp(min(0.0, top_high[node] + high[node] - log_partition))
    return probability, pairs, log_partition


@dataclass(frozen=True)
class ContentModel:
    """Weights of the node features for main text, and edge potentials by the child's kind."""

    nodes: tuple[float, ...]
    edges: tuple[tuple[float, ...], ...]

    def text(self, html: str | None, threshold: float = 0.5) -> str:
        """The runs of text whose block is main text, in page order, joined by an empty line."""
        page = read_page(html)
        if not page.runs:
            return ""
        probability, _, _ = marginals(page, self.nodes, self.edges)
        return "\n\n".join(t for node, t in page.runs if probability[node] >= threshold)


def fit(
    labelled: Sequence[str] = LABELLED_PAGES, steps: int = 150, penalty: float = 0.02
) -> ContentModel:
    """A model from labelled pages, by Adam on the exact gradient of the penalised likelihood."""
    pages = [read_page(p) for p in labelled]
    size, kinds = len(FEATURES), len(EDGE_KINDS)
    theta = np.zeros(size + 4 * kinds)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        gradient = penalty * theta
        nodes, edges = theta[:size].tolist(), theta[size:].reshape(kinds, 4).tolist()
        for page in pages:
            probability, pairs, _ = marginals(page, nodes, edges)
            for node, fs in enumerate(page.features):
                gradient[fs] += (probability[node] - page.labels[node]) / len(pages)
                if node:
                    at = size + 4 * page.kinds[node]
                    gradient[at : at + 4] += np.array(pairs[node]) / len(pages)
                    seen = 2 * page.labels[page.parents[node]] + page.labels[node]
                    gradient[at + seen] -= 1 / len(pages)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = 0.1 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        theta -= rate * first / (np.sqrt(second) + 1e-9)
    return ContentModel(
        tuple(theta[:size].tolist()), tuple(map(tuple, theta[size:].reshape(kinds, 4).tolist()))
    )


def extract(pages: DataFrame, model: ContentModel, html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points.

    Character references are decoded, white space inside a block becomes one blank, blocks are
    trimmed and joined by an empty line. Pages that are NULL, empty or without main text give the empty
    text. One row per input row; output names replace input columns.
    """

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield pa.array([model.text(x.as_py()) for x in array], pa.string())

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    body = F.arrow_udf(convert, "string").asNondeterministic()(F.col(html))
    names = {"text", "n_chars"}
    kept = [F.col(quoted(c)) for c in pages.columns if c.lower() not in names]
    found = pages.select(*kept, body.alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
