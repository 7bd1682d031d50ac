"""Main text of web pages: a tree-structured graphical model over the DOM.

Each element is main text or not.  Potentials connect an element's state to
its parent's and to what can be seen of it: its tag and its parent's together,
the words of its class and id and of its parent's, how much text it holds, how
much of that directly and how much of it in links.  Messages go up from the
leaves and down from the root (sum-product), which on a tree gives
exact marginals.  The potentials are counted on labelled pages.  A page is
parsed, judged and joined again in its own row.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.columns import carries_columns
from tidemark.llm.labelled_pages import pages as labelled_pages

MARK = "data-main"
#: Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style head title template noscript iframe svg canvas select textarea button datalist".split())
#: What may stand in a head; all else ends it, as its end tag may be left out.
HEAD = set("head html base basefont bgsound link meta title noscript noframes script style template".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Formulas and what stands for an object are text of the element around them, and no nodes of their own.
FORMULA = set(
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics object".split()
)
#: Cells of formulas, apart from what is before them.
APART = {"mtr", "mtd"}
#: A formula's source, which is not shown beside it.
SOURCE = {"annotation", "annotation-xml"}
#: An element of these tags ends an open element of the given ones.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
#: Open elements of these tags are not ended from inside.
SCOPES = set("table ul ol dl select article section aside nav main div body html td th li".split())
#: Elements that end a formula left open.
BLOCKS = SCOPES | set("p h1 h2 h3 h4 h5 h6 pre blockquote header footer figure form dd dt tr hr".split())


@dataclass
class Node:
    """An element; ``runs`` are numbers of the text runs that stand directly in its blocks."""

    tag: str
    words: tuple[str, ...] = ()
    parent: int = -1
    chars: int = 0
    linked: int = 0
    label: int | None = None
    children: list[int] = field(default_factory=list)


class Dom(HTMLParser):
    """Nodes in page order and blocks of text, each (node, text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#root")]
        self.open = [0]
        self.owners = [0]  # open elements that are not inline
        self.depths: dict[str, list[int]] = defaultdict(list)  # where open elements of a tag stand
        self.blocks: list[tuple[int, list[str]]] = []
        self.fresh = True
        self.unseen = 0
        self.source = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body":
            self._end({"head"}, {"template"})
        elif tag not in HEAD:
            self._end_head()
        elif tag == "head" and self.depths["head"]:
            return
        if tag in SOURCE or tag in FORMULA:
            self.source |= tag in SOURCE
            if tag in APART:
                self.handle_data(" ")
            return
        if self.source and tag not in BLOCKS:
            return
        self.source = False
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "hr":
                self.fresh = True
            return
        if tag not in INLINE:
            self.fresh = True
            self._end({"p"}, {"table", "td", "th", "li", "div", "article", "section", "aside", "main", "body"})
        if tag in ENDS:
            self._end(ENDS[tag], SCOPES - ENDS[tag])
        given = dict(attrs)
        words = re.findall(r"[a-z]+", f"{given.get('class') or ''} {given.get('id') or ''} {given.get('role') or ''}".lower())
        node = Node(tag, tuple(words), self.open[-1])
        if MARK in given:
            node.label = int(given[MARK] == "1")
        self.nodes[self.open[-1]].children.append(len(self.nodes))
        self.depths[tag].append(len(self.open))
        self.open.append(len(self.nodes))
        if tag not in INLINE:
            self.owners.append(len(self.nodes))
        self.nodes.append(node)
        self.unseen += tag in UNSEEN

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag in self.CDATA_CONTENT_ELEMENTS and self.depths["svg"] == []:
            self.set_cdata_mode(tag)  # the slash does not end it
        elif tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in SOURCE or tag in FORMULA:
            self.source &= tag not in SOURCE | {"semantics", "math"}
            return
        if tag not in INLINE:
            self.fresh = True
        if self.depths[tag]:
            while self._close() != tag:
                pass

    def _end(self, tags: set[str], scope: set[str]) -> None:
        """Close the innermost open element of ``tags``, unless one of ``scope`` is in between."""
        depth = max((self.depths[tag][-1] for tag in tags if self.depths[tag]), default=0)
        if depth and depth >= max((self.depths[tag][-1] for tag in scope if self.depths[tag]), default=0):
            while len(self.open) > depth:
                self._close()

    def _end_head(self) -> None:
        """Close a head that stands open, unless something in it is open too."""
        if self.nodes[self.open[-1]].tag == "head":
            self._close()
            self.fresh = True

    def _close(self) -> str:
        tag = self.nodes[self.open.pop()].tag
        self.depths[tag].pop()
        if tag not in INLINE:
            self.owners.pop()
        self.unseen -= tag in UNSEEN
        return tag

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head()
        if self.unseen or self.source:
            return
        owner = self.owners[-1]
        if self.fresh or not self.blocks or self.blocks[-1][0] != owner:
            if not data.strip():
                return
            self.blocks.append((owner, []))
            self.fresh = False
        self.blocks[-1][1].append(data)
        size = len(data.strip())
        self.nodes[owner].chars += size
        if self.depths["a"]:
            self.nodes[owner].linked += size


def parse(html: str) -> Dom:
    dom = Dom()
    dom.feed(html)
    dom.close()
    return dom


def seen(nodes: list[Node]) -> list[list[str]]:
    """What can be seen of each node, from its own text and all below it."""
    chars, linked = [n.chars for n in nodes], [n.linked for n in nodes]
    for at in range(len(nodes) - 1, 0, -1):
        chars[nodes[at].parent] += chars[at]
        linked[nodes[at].parent] += linked[at]
    out = []
    for at, node in enumerate(nodes):
        share = linked[at] / chars[at] if chars[at] else 0
        size = min(5, int(math.log10(chars[at] + 1) * 2)) if chars[at] else -1
        own = min(5, int(math.log10(node.chars + 1) * 2))
        here = [f"links={min(3, int(share * 4))}", f"size={size}", f"own={own}"]
        if node.tag not in INLINE:  # what an inline element holds is seen at the one around it
            here += [f"tag={node.tag}", f"place={node.tag}<{nodes[node.parent].tag if at else ''}"]
        else:
            here = []
        above = nodes[node.parent].words if at else ()
        out.append(here + [f"word={word}" for word in sorted(set(node.words))] + [f"under={word}" for word in sorted(set(above))])
    return out


@dataclass
class Model:
    """Logarithms: the root's prior, child given parent, and each sight given the state."""

    prior: tuple[float, float]
    step: tuple[tuple[float, float], tuple[float, float]]
    sights: dict[str, tuple[float, float]]

    def evidence(self, sights: list[str]) -> list[float]:
        """What the sights of a node say for each state; the tag counts only where the pair of tags is not known."""
        pair = [0.0, 0.0]
        placed = any(sight.startswith("place=") and sight in self.sights for sight in sights)
        for sight in sights:
            known = self.sights.get(sight)
            if known and not (placed and sight.startswith("tag=")):
                pair[0] += known[0]
                pair[1] += known[1]
        return pair

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability that each node is main text, by messages up and down the tree."""
        own = [self.evidence(sights) for sights in seen(nodes)]
        up = [(0.0, 0.0)] * len(nodes)  # message of a node to its parent
        inside = own  # own sight and the messages from below
        step = self.step
        for at in range(len(nodes) - 1, 0, -1):
            a, b = inside[at]
            up[at] = (add(step[0][0] + a, step[0][1] + b), add(step[1][0] + a, step[1][1] + b))
            above = inside[nodes[at].parent]
            above[0] += up[at][0]
            above[1] += up[at][1]
        whole = [(0.0, 0.0)] * len(nodes)
        whole[0] = (inside[0][0] + self.prior[0], inside[0][1] + self.prior[1])
        out = [share(whole[0])]
        for at in range(1, len(nodes)):
            a, b = whole[nodes[at].parent]
            a, b = a - up[at][0], b - up[at][1]  # the parent without this child
            down = (add(a + step[0][0], b + step[1][0]), add(a + step[0][1], b + step[1][1]))
            whole[at] = (inside[at][0] + down[0], inside[at][1] + down[1])
            out.append(share(whole[at]))
        return out


def add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def share(pair: tuple[float, float]) -> float:
    return 1 / (1 + math.exp(max(-500.0, min(500.0, pair[0] - pair[1]))))


def train(pages: list[str], more: float = 0.02) -> Model:
    """Potentials counted on pages with marks, each count raised by ``more``."""
    prior, step, sights, total = [more, more], [[more, more], [more, more]], Counter(), [0, 0]
    for page in pages:
        nodes = parse(page).nodes
        for at, (node, here) in enumerate(zip(nodes, seen(nodes))):
            state = node.label if node.label is not None else (nodes[node.parent].label if at else 0)
            node.label = state
            total[state] += 1
            if at:
                step[nodes[node.parent].label][state] += 1
            else:
                prior[state] += 1
            sights.update((sight, state) for sight in here)
    names = {sight for sight, _ in sights}
    kinds = Counter(name.partition("=")[0] for name in names)

    def log_share(sight: str, state: int) -> float:
        kind = kinds[sight.partition("=")[0]] + 1
        return math.log((sights[sight, state] + more) / (total[state] + more * kind))

    return Model(
        tuple(math.log(x / sum(prior)) for x in prior),
        tuple(tuple(math.log(x / sum(row)) for x in row) for row in step),
        {sight: (log_share(sight, 0), log_share(sight, 1)) for sight in names},
    )


def main_text(html: str | None, model: Model) -> str:
    """Blocks whose element is main text more likely than not, one a line."""
    if not html:
        return ""
    dom = parse(html)
    main = model.marginals(dom.nodes)
    blocks = (" ".join("".join(runs).split()) for node, runs in dom.blocks if main[node] >= 0.5)
    return "\n".join(block for block in blocks if block)


@carries_columns
def extract(pages: DataFrame, model: Model | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``pages`` (all, if not given) beside the page's main text.

    Null and empty pages, and pages without main text, give an empty text; a
    column named text is replaced; repeated rows are judged alike.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train(labelled_pages()))
    kept = [c for c in (keep or pages.columns) if c != "text"]

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [main_text(html, model) for html in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns[: len(kept)] + [pa.array(texts, pa.string())], names=[*kept, "text"])

    columns = [f"`{c}`" for c in kept]
    schema = pages.select(*columns).schema.add("text", "string")
    return pages.select(*columns, pages["html"].alias("_html")).mapInArrow(extracted, schema)
