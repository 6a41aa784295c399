"""Main text of web pages by a tree-structured graphical model.

Each block-level element and each run of text inside one is a node with two states, content or
not. Node potentials come from tags, class words and the shape of the text, parent-child potentials
from the parent's tag. Sum-product messages go up the tree and down again and give every run its
marginal; runs that are no less likely content than not are the page's text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.batches import slices, texts_of
from postflow.llm.common import drawn

# What HTML says of its elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var".split())
UNSEEN = frozenset(
    "head script style noscript template svg math iframe object select textarea canvas audio "
    "video title datalist".split())
# What may stand in a page's head: any other element, and any text, ends it.
IN_HEAD = frozenset("head title base link meta style script noscript template".split())
# An element that a start tag closes first, if it is open in the same list, table or block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tbody thead section article div main body td th".split())

# Prior knowledge, in place of labels: tags and class words that by themselves say what a part is.
OUTSIDE_TAGS = frozenset("nav header footer aside form button menu dialog fieldset".split())
INSIDE_TAGS = frozenset("article main".split())
OUTSIDE_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts "
    "advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "notice notices alert popup modal overlay comment comments commentlist reply replies disqus "
    "respond share sharing social related recommended newsletter subscribe subscription signup "
    "login search breadcrumb breadcrumbs pagination pager widget toolbar disclaimer copyright "
    "form skip".split())
INSIDE_WORDS = frozenset("article content post entry story main body text".split())
# What follows one of these in a class tells how the page is laid out ("has-comments").
MODIFIERS = frozenset("has have no non not without with hide show is enable disable".split())
PRIOR = 40.0  # log odds of such a tag or word, and the bound of what is learned of it
# Elements that may wrap a whole page. Where most text lies below one of them, or below an element
# that says it is content, its tag and class words tell of the layout and not of a part.
WRAPPERS = frozenset("html body form".split())
# A prior weighs as much as so many labelled nodes; what more of them say outweighs it.
PSEUDO = 4.0
# Share of labels against a prior that are taken as errors: an advertisement may equal a line.
WRONG = 0.05
GENERIC, SHAPE = 0.5, 1.0  # bounds of the learned log odds of other tags, and of text shapes
COUPLING = 5.0  # bound of the learned log odds between a parent and its child
TIE = -1e-6  # nothing known, up to rounding: taken as content
# The model is fitted on a bounded sample of labelled pages of at most so many characters.
SAMPLE_PAGES, SAMPLE_CHARS = 400, 60_000


@dataclass
class Node:
    tag: str
    parent: int
    features: tuple[str, ...] = ()
    # Of a run of text (tag "#run"): its parts, and the numbers of inline nodes between them.
    pieces: list[str | int] = field(default_factory=list)
    linked: int = 0
    length: int = 0
    inline: bool = False


class Tree(HTMLParser):
    """Block elements and runs of text, parents before children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1)]
        self.open: list[tuple[str, int]] = [("#page", 0)]  # open tags and the block each is in
        self.count = Counter()  # open tags by name
        self.run: Node | None = None
        self.around: list[tuple[int, Node]] = []  # runs that go on after an inline node
        self.links = 0
        self.hidden = 0

    def push(self, tag: str, block: int) -> None:
        self.open.append((tag, block))
        self.count[tag] += 1

    def end_head(self) -> None:
        at = max(i for i, (name, _) in enumerate(self.open) if name == "head")
        if all(name == "head" for name, _ in self.open[at:]):
            self.pop(at)

    def handle_starttag(self, tag, attrs):
        if self.count["head"] and tag not in IN_HEAD:
            self.end_head()
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag in ("hr", "input"):
                self.run = None
            return
        if tag in UNSEEN:
            self.hidden += 1
            self.push(tag, self.open[-1][1])
            return
        marks = words_of(attrs)
        if tag in INLINE and not marks & (OUTSIDE_WORDS | {"#hidden"}):
            self.links += tag == "a"
            self.push(tag, self.open[-1][1])
            return
        if tag not in INLINE:
            self.close_first(tag)
        elif self.run is not None:
            self.run.pieces.append(len(self.nodes))
            self.around.append((len(self.nodes), self.run))
        self.run = None
        known = marks & (OUTSIDE_WORDS | INSIDE_WORDS | {"#hidden"})
        self.nodes.append(Node(tag, self.open[-1][1],
                               (f"tag:{tag}", *(f"word:{w}" for w in sorted(known))),
                               inline=tag in INLINE))
        self.push(tag, len(self.nodes) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def close_first(self, tag: str) -> None:
        """Ends an open paragraph before a block, and an open item before the next one."""
        ends = CLOSES.get(tag, frozenset())
        if not self.count["p"] and not any(self.count[x] for x in ends):
            return
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at][0]
            if name == "p" or name in ends:
                self.pop(at)
                return
            if name in SCOPES:
                return

    def pop(self, at: int) -> None:
        """Closes the element and all inside. The text goes on if only inline elements and unseen
        ones end."""
        inside = self.open[at - 1][1]
        if self.open[-1][1] != inside:
            self.run = None
        for name, block in self.open[at:]:
            self.links -= name == "a" and self.links > 0
            self.hidden -= name in UNSEEN
            self.count[name] -= 1
        while self.around and self.around[-1][0] > inside:
            node, run = self.around.pop()
            if self.nodes[node].parent == inside:
                self.run = run
        del self.open[at:]

    def handle_endtag(self, tag):
        if not self.count[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                self.pop(at)
                return

    def handle_data(self, data):
        if self.count["head"] and data.strip():
            self.end_head()
        if self.hidden or not data:
            return
        if self.run is None:
            if not data.strip():
                return
            self.run = Node("#run", self.open[-1][1])
            self.nodes.append(self.run)
        self.run.pieces.append(data)
        self.run.length += len(data)
        self.run.linked += len(data) if self.links else 0


def words_of(attrs) -> set[str]:
    """Words of an element's class, id and role; ``#hidden`` if it isn't shown."""
    found = set()
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for part in re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower().split():
                words = re.findall(r"[a-z]+", part)
                if not words or words[0] not in MODIFIERS:
                    found.update(words)
        elif name == "hidden" or name == "aria-hidden" and value == "true" \
                or name == "style" and value and re.search(r"display\s*:\s*none", value):
            found.add("#hidden")
    return found


def text_of(node: Node) -> str:
    return " ".join("".join(x for x in node.pieces if isinstance(x, str)).split())


def tree_of(html: str) -> list[Node]:
    tree = Tree()
    tree.feed(html)
    tree.close()
    for node in tree.nodes:
        if node.tag == "#run":
            share = node.linked / max(1, node.length)
            node.features = (
                f"links:{'all' if share > 0.9 else 'many' if share > 0.4 else 'few'}",
                f"long:{min(4, int(math.log10(node.length + 1) * 1.5))}")
    unwrap(tree.nodes)
    return tree.nodes


def unwrap(nodes: list[Node]) -> None:
    """Takes outside words from wrappers with most of the page's text below them, and reads a form
    of this kind as a body. An element that says it is content is such a wrapper too, unless it
    lies in a part that is none."""
    below = [node.length for node in nodes]
    for at in range(len(nodes) - 1, 0, -1):
        below[nodes[at].parent] += below[at]
    outside = [False] * len(nodes)
    for at, (node, length) in enumerate(zip(nodes, below)):
        outside[at] = at > 0 and outside[node.parent]
        inside = any(prior_of(f) > 0 for f in node.features)
        if 2 * length > below[0] and (
                node.tag in WRAPPERS or inside and not outside[at]):
            node.tag = "body" if node.tag == "form" else node.tag
            node.features = (f"tag:{node.tag}", *(
                f for f in node.features[1:] if f == "word:#hidden" or prior_of(f) > 0))
        outside[at] |= any(prior_of(f) < 0 for f in node.features)


def prior_of(feature: str) -> float:
    """Prior log odds of a feature; 0 if it has none."""
    kind, _, name = feature.partition(":")
    if kind == "tag":
        return -PRIOR if name in OUTSIDE_TAGS else PRIOR / 2 if name in INSIDE_TAGS else 0.0
    if kind == "word":
        return -PRIOR if name in OUTSIDE_WORDS or name == "#hidden" else PRIOR / 8
    return 0.0


def learned(feature: str, content: int, other: int, total: Counter) -> float:
    """Log odds of a feature from the labelled nodes that have it, with its prior as pseudo-counts.
    Without a prior it is bounded by what a parent says, so that no tag or shape stands against it."""
    prior = prior_of(feature)
    if prior:
        share = math.exp(prior) / (1 + math.exp(prior))
        rest = 1 / (1 + math.exp(prior))
        errors = WRONG * (content + other)
        if prior < 0:
            content = max(0.0, content - errors)
        else:
            other = max(0.0, other - errors)
        odds = (math.log((content + PSEUDO * share) / (total[True] + PSEUDO))
                - math.log((other + PSEUDO * rest) / (total[False] + PSEUDO)))
        return max(-PRIOR, min(PRIOR, odds))
    odds = math.log((content + 1) / (total[True] + 2)) - math.log((other + 1) / (total[False] + 2))
    bound = GENERIC if feature.startswith("tag:") else SHAPE
    return max(-bound, min(bound, odds))


@dataclass
class Model:
    odds: dict[str, float] = field(default_factory=dict)  # by feature, in place of its prior
    child: dict[str, tuple[float, float]] = field(default_factory=dict)  # by the parent's tag
    usual: tuple[float, float] = (-COUPLING, COUPLING)

    def node(self, node: Node) -> float:
        """Log odds of content by the node's own features."""
        return sum(self.odds[f] if f in self.odds else prior_of(f) for f in node.features)

    def edge(self, tag: str) -> tuple[float, float]:
        """Log odds that a child is content, if its parent isn't and if it is."""
        return self.child.get(tag, self.usual)

    def edge_of(self, nodes: list[Node], at: int) -> tuple[float, float]:
        """The edge above a node. Some words inside a block tell nothing about the block."""
        return (0.0, 0.0) if nodes[at].inline else self.edge(nodes[nodes[at].parent].tag)


def marginals(model: Model, nodes: list[Node]) -> np.ndarray:
    """Log odds of content for every node, by messages to the root and back, all in log odds."""
    own = [model.node(n) for n in nodes]
    up = [0.0] * len(nodes)  # what a node tells its parent
    for at in range(len(nodes) - 1, 0, -1):
        parent = nodes[at].parent
        if0, if1 = model.edge_of(nodes, at)
        up[at] = passed(own[at], if0, if1)
        own[parent] += up[at]
    found = own[:]
    for at in range(1, len(nodes)):  # a parent stands before its children
        parent = nodes[at].parent
        found[at] = own[at] + told(found[parent] - up[at], *model.edge_of(nodes, at))
    return np.array(found)


def soft(x: float) -> float:
    """log(1 + e^x)"""
    return x if x > 30 else math.log1p(math.exp(x)) if x > -30 else 0.0


def passed(child: float, if0: float, if1: float) -> float:
    """A child's message up: how much likelier what lies below is if the parent is content."""
    return (soft(child + if1) - soft(if1)) - (soft(child + if0) - soft(if0))


def told(parent: float, if0: float, if1: float) -> float:
    """The message down: log odds of the child's states, summed over the parent's."""
    one = soft_sum(parent + if1 - soft(if1), if0 - soft(if0))
    zero = soft_sum(parent - soft(if1), -soft(if0))
    return one - zero


def soft_sum(a: float, b: float) -> float:
    return max(a, b) + soft(-abs(a - b))


def main_text(model: Model, html: str) -> str:
    nodes = tree_of(html)
    kept = [node.tag == "#run" and value > TIE for node, value in zip(nodes, marginals(model, nodes))]
    # Runs below an inline node stand where this stands in the run around it.
    inner: dict[int, int] = {x: x for node in nodes for x in node.pieces if isinstance(x, int)}
    inline: dict[int, list[Node]] = {x: [] for x in inner}
    lines = []
    for at, node in enumerate(nodes):
        if node.parent in inner:
            inner.setdefault(at, inner[node.parent])
        if not kept[at]:
            continue
        if at in inner:
            inline[inner[at]].append(node)
        else:
            lines.append(node)
    texts = (" ".join("".join(flat(node, inline)).split()) for node in lines)
    return "\n".join(text for text in texts if text)


def flat(node: Node, inline: dict[int, list[Node]]) -> Iterator[str]:
    """The parts of a run, with those of the inline nodes between them."""
    todo: list = [node]
    while todo:
        one = todo.pop()
        if isinstance(one, str):
            yield one
        else:
            held = one.pieces if isinstance(one, Node) else inline[one]
            todo.extend(reversed(held))


def states(nodes: list[Node], source: str) -> list[bool] | None:
    """Labels from the text that a page was made of: a run is content if it is a line of it, or a
    heading that begins it; an element if most text below it is. None if no run is found there."""
    lines = {" ".join(line.split()) for line in source.split("\n")} - {""}
    whole = " ".join(source.split())
    held = np.zeros((len(nodes), 2))
    for at, node in enumerate(nodes):
        if node.tag == "#run":
            text = text_of(node)
            if text:
                content = text in lines or len(text) >= 20 and whole.startswith(text)
                held[at, int(content)] += len(text)
    if not held[:, 1].any():
        return None
    for at in range(len(nodes) - 1, 0, -1):
        held[nodes[at].parent] += held[at]
    return (held[:, 1] > held[:, 0]).tolist()


def fitted(pages: list[tuple[str, str]]) -> Model:
    """A model from (html, text that the page shows) of labelled pages; without any, the priors."""
    seen: dict[str, Counter] = {}
    pairs: dict[str, Counter] = {}
    total = Counter()
    for html, source in pages:
        nodes = tree_of(html)
        labels = states(nodes, source)
        if labels is None:
            continue
        for node, label in zip(nodes, labels):
            total[label] += 1
            for feature in node.features:
                seen.setdefault(feature, Counter())[label] += 1
            if node.parent >= 0 and not node.inline:
                pairs.setdefault(nodes[node.parent].tag, Counter())[labels[node.parent], label] += 1
    model = Model()
    for feature, counts in seen.items():
        model.odds[feature] = learned(feature, counts[True], counts[False], total)
    for tag, counts in pairs.items():
        model.child[tag] = tuple(
            max(-COUPLING, min(COUPLING, math.log(
                (counts[state, True] + prior) / (counts[state, False] + 1 - prior))))
            for state, prior in ((False, 0.01), (True, 0.99)))
    return model


def sample(pages: DataFrame, docs: DataFrame, key: str = "page_id", url: str = "url",
           html: str = "html") -> list[tuple[str, str]]:
    """The bounded sample of labelled pages: html, and the text of the document that the first
    number of the url's path names. Chosen by hash of the page's id among the pages that have such
    a document; of several rows of one id one is taken."""
    number = F.regexp_extract(F.col(url), r"://[^/?#]*/[^?#]*?([0-9]{1,18})", 1)
    known = pages.select(
        F.col(key).alias("page"), F.col(html).alias("html"),
        F.when(number != "", number.cast("long")).alias("doc_id")).filter(
        F.col("doc_id").isNotNull() & (F.char_length("html") <= SAMPLE_CHARS))
    # Only pages whose document there is are labelled: the sample is drawn from these alone.
    named = known.select("page", "doc_id").join(
        docs.select("doc_id"), "doc_id", "left_semi").groupBy("page").agg(
        F.min("doc_id").alias("doc_id"))
    chosen = F.broadcast(drawn(named, "page", SAMPLE_PAGES, named.count()))
    # Bounded: at most SAMPLE_PAGES rows of SAMPLE_CHARS characters.
    rows = known.join(chosen, ["page", "doc_id"]).groupBy("page", "doc_id").agg(
        F.min("html").alias("html")).collect()
    wanted = sorted({r["doc_id"] for r in rows})
    if not wanted:
        return []
    texts = dict(docs.filter(F.col("doc_id").isin(wanted)).groupBy("doc_id").agg(
        F.max(F.substring(F.coalesce("text", F.lit("")), 1, SAMPLE_CHARS)).alias("text"))
        .limit(SAMPLE_PAGES).collect())
    return [(r["html"], texts[r["doc_id"]]) for r in rows if r["doc_id"] in texts]


def extracted(pages: DataFrame, model: Model, key: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (empty if none), n_chars.

    Whole pages are parsed; a null page counts as empty; broken markup is read as far as it goes;
    repeated rows are read each; an empty table gives an empty result; a null url is carried.
    White space inside a block becomes one space; blocks are joined by line breaks. Other columns
    are not read.
    """
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                texts = [main_text(model, x) for x in texts_of(batch, "html")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                        F.col(html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")
