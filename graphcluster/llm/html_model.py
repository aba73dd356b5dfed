"""Operator 7: main text of web pages by a tree-structured graphical model.

A page is parsed into its DOM tree.  Every node is content or not; the model
couples a parent and a child by a potential (how likely a child is content
given its parent) and ties a node to its features (tag, class and id words,
length, share of link text, punctuation).  Sum-product messages go from the
leaves up and from the root down once each, which gives every node's exact
marginal; the text runs of blocks that are more likely content than not make the
main text (an inline element goes with its block).

Training needs labelled pages: those of a bounded sample that mark their
article themselves (``article`` or ``main``), where its nodes are content but
for the page parts inside it that are named as such, and a few short labelled
layouts below for names that the sample may lack.

Cases: null html counts as empty and gives an empty text; what isn't closed ends
with its parent, a paragraph also with the next block; cut pages are read to
their end; ``br`` is white space; text in script, style, title and the like is
never content; repeated rows and extra columns pass through (columns named like
an output are replaced); an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import partial
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from graphcluster.llm.common import arrow_map, ship

SAMPLE = 600        #: pages that train the model (in expectation; chosen by a hash of the id)
SEED_WEIGHT = 20    #: weight of each labelled layout
CAP_TAG, CAP_NAME, CAP_TEXT = 2.5, 6.0, 2.0   #: largest log-odds of a feature of each kind

# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("head title script style noscript template iframe object svg select button textarea option".split())
BLOCK = frozenset("""address article aside blockquote body canvas dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot
    th thead tr ul""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}}
ASIDE = frozenset("nav aside footer form".split())   # page parts, also inside an article
NAMES = frozenset("""ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies
    footer menu nav navigation newsletter notice pagination popup promo promotion related share sharing sidebar
    social sponsor sponsored subscribe toolbar widget""".split())

#: Labelled layouts; data-y is 1 for content and 0 else, for the element and all below it.
LAYOUTS = [
    """<body data-y=0><header><a href=/>Home</a><h1>Site</h1></header><nav><ul><li><a href=a>One</a></li></ul></nav>
    <div id=main data-y=1><div class=post><h1>Title here</h1><p>A long paragraph of text, with sentences. It goes on,
    and on, for quite some while. Then it ends.</p><ul><li>A point, made here.</li><li>Another <a href=x>one</a>.</li>
    </ul><blockquote><p>Quoted words of someone, at length.</p></blockquote><div class=share data-y=0><a href=f>Share
    </a></div><p>And so it closes, with <em>some</em> emphasis and a <a href=q>link</a>.</p></div></div>
    <aside class=sidebar><h3>Popular</h3><ul><li><a href=b>Read this</a></li></ul></aside>
    <div class=comments><h3>Comments</h3><div class=comment><p>I liked this very much, thank you. Well done.</p></div>
    </div><footer><p>Copyright. <a href=t>Terms</a></p></footer></body>""",
    """<body data-y=0><div class=cookie-notice><p>We use cookies. By staying you agree to our policy, and more.</p>
    <button>Accept</button></div><div class=menu><a href=a>A</a> <a href=b>B</a></div><main data-y=1><article>
    <header><h1>Headline</h1></header><section><h2>Part</h2><p>Words, many of them, stand in this part. They are the
    content.</p><table><tr><td>Cell</td><td>1.5</td></tr></table><pre>code here</pre><figure><img src=i><figcaption>A
    picture of it.</figcaption></figure></section><div class=ad data-y=0><p>Buy now, this is a great offer.</p></div>
    <aside class=related data-y=0><a href=r>Related story</a></aside><form class=newsletter data-y=0><p>Subscribe to
    our letter today.</p><input></form><p>Last paragraph of the text, which closes it.</p></article></main><div id=sidebar>
    <p>About the author, some words. Follow us.</p></div><div id=footer><p>All rights reserved, of course.</p></div></body>""",
    """<body data-y=0><div id=header><p>A site about things, and such.</p></div><div class=breadcrumbs><a href=h>Home</a>
    </div><div class=content data-y=1><div class=entry><h2>Heading</h2>Text without a paragraph, which is content as
    well. It has sentences.<br>And lines.<div>More text in a box, also content.</div><ol><li>First thing to do, then
    rest.</li></ol></div><section id=comments data-y=0><h4>Replies</h4><p>Some reader wrote this, at length. They
    did.</p><form><p>Leave a reply, please.</p><textarea></textarea></form></section></div><div class=promo><p>
    Advertisement, do look at it. It is good.</p></div><div class=social><a href=s>S</a></div></body>""",
]


class Dom(HTMLParser):
    """Nodes in page order (a parent before its children) and text runs.

    Where the open elements of a name stand is kept by name, so a tag never
    looks through them: time is in proportion to the page.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.attrs = [-1], ["#root"], [{}]
        self.open = [0]
        self.where: dict[str, list[int]] = {}  # of each name, its places in ``open``
        self.blocks: list[int] = []            # of block elements, their places in ``open``
        self.runs: list[tuple[int, str]] = []  # (node, text); node -1 is a block boundary
        self.feed(html)
        self.close()

    def _top(self, names) -> int:
        """The place of the innermost open element with one of the names; 0 if none."""
        return max((self.where[x][-1] for x in names if self.where.get(x)), default=0)

    def _push(self, tag: str) -> None:
        self.where.setdefault(tag, []).append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(len(self.tag) - 1)

    def _pop_to(self, i: int) -> None:
        if self.blocks and self.blocks[-1] >= i:
            self.runs.append((-1, ""))
        while len(self.open) > i:
            self.where[self.tag[self.open.pop()]].pop()
        while self.blocks and self.blocks[-1] >= i:
            self.blocks.pop()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK and self.blocks and self.tag[self.open[self.blocks[-1]]] == "p":
            self._pop_to(self.blocks[-1])  # a paragraph ends where a block begins
        while tag in CLOSES:
            i = self._top(CLOSES[tag])
            if i <= self._top(SCOPE[tag]):
                break
            name = self.tag[self.open[i]]
            self._pop_to(i)
            if tag != "tr" or name == "tr":
                break
        if tag in BLOCK:
            self.runs.append((-1, ""))
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.attrs.append(dict(attrs))
        if tag == "br":
            self.runs.append((self.open[-1], " "))
        if tag not in VOID:
            self._push(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "path"):
            self._pop_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        i = self._top((tag,))
        if i:
            self._pop_to(i)

    def handle_data(self, data):
        self.runs.append((self.open[-1], data))

    def unknown_decl(self, data):
        pass


def names(attrs: dict) -> set[str]:
    found = " ".join(str(attrs.get(a) or "") for a in ("class", "id", "role"))
    return set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", found).lower())) if found.strip() else set()


def features(dom: Dom) -> list[list[str]]:
    """Feature names of every node: t: tag, n: class and id words, x: text."""
    n = len(dom.tag)
    size, linked, marks = [0] * n, [0] * n, [0] * n
    for node, text in dom.runs:
        if node > 0 and dom.tag[node] not in HIDDEN:
            size[node] += len(text.strip())
            marks[node] += sum(map(text.count, ".,;!?"))
    for i in range(n - 1, 0, -1):
        if dom.tag[i] == "a":
            linked[i] = size[i]
        p = dom.parent[i]
        size[p] += size[i]
        linked[p] += linked[i]
        marks[p] += marks[i]
    out = []
    for i in range(n):
        own = [f"t:{dom.tag[i]}", f"x:size{min(12, size[i].bit_length())}"]
        if size[i]:
            own += [f"x:link{4 * linked[i] // size[i]}", f"x:mark{min(4, 100 * marks[i] // size[i])}"]
        out.append(own + [f"n:{w}" for w in names(dom.attrs[i])])
    return out


def labels(dom: Dom, layout: bool = False) -> list[int] | None:
    """Labels of a page that marks its article (a layout: has data-y); None if it doesn't."""
    y, marked = [0] * len(dom.tag), False
    for i in range(1, len(dom.tag)):
        tag, attrs = dom.tag[i], dom.attrs[i]
        y[i] = y[dom.parent[i]]
        if layout and "data-y" in attrs:
            y[i], marked = int(attrs["data-y"]), True
        elif tag in ("article", "main") and not y[i]:
            y[i] = marked = 1
        elif y[i] and (tag in ASIDE or tag in HIDDEN or names(attrs) & NAMES):
            y[i] = 0
    return y if marked else None


@dataclass
class Model:
    """Log-odds of features and the conditional table of child given parent."""
    odds: dict[str, float] = field(default_factory=dict)
    child: list[list[float]] = field(default_factory=list)  # child[parent label][label]
    root: float = 0.5

    @classmethod
    def train(cls, feature: Counter, edge: Counter) -> Model:
        nodes = [sum(n for (f, y), n in feature.items() if y == k and f.startswith("t:")) for k in (0, 1)]
        odds = {}
        for f in {f for f, _ in feature}:
            a, b = feature[f, 1] + 0.5, feature[f, 0] + 0.5
            cap = {"t": CAP_TAG, "n": CAP_NAME}.get(f[0], CAP_TEXT)
            odds[f] = max(-cap, min(cap, math.log(a / (nodes[1] + 1)) - math.log(b / (nodes[0] + 1))))
        child = []
        for p in (0, 1):
            one = (edge[p, 1] + 1) / (edge[p, 0] + edge[p, 1] + 2)
            child.append([1 - one, one])
        return cls(odds, child, 0.02)

    def marginals(self, dom: Dom) -> list[float]:
        """Probability of content of every node, by messages up and down the tree."""
        n, parent, child = len(dom.tag), dom.parent, self.child
        (c00, c01), (c10, c11) = child
        local = []
        for tag, own in zip(dom.tag, features(dom)):
            if tag in HIDDEN:
                local.append((1.0, 1e-12))
            else:
                o = max(-30.0, min(30.0, sum(self.odds.get(f, 0.0) for f in own)))
                local.append((1.0, math.exp(o)) if o < 0 else (math.exp(-o), 1.0))
        up = [(1.0, 1.0)] * n        # message of a node to its parent
        below = list(local)          # a node's potential times its children's messages
        for i in range(n - 1, 0, -1):
            b0, b1 = below[i]
            m0, m1 = c00 * b0 + c01 * b1, c10 * b0 + c11 * b1
            z = m0 + m1
            up[i] = m0, m1 = m0 / z, m1 / z
            p0, p1 = below[parent[i]]
            p0, p1 = p0 * m0, p1 * m1
            z = p0 + p1
            below[parent[i]] = (p0 / z, p1 / z)
        out, down = [0.0] * n, [(1.0, 1.0)] * n
        down[0] = (1 - self.root, self.root)
        for i in range(n):
            if i:
                p = parent[i]
                m0, m1 = up[i]
                q0, q1 = below[p][0] * down[p][0] / m0, below[p][1] * down[p][1] / m1
                d0, d1 = q0 * c00 + q1 * c10, q0 * c01 + q1 * c11
                z = d0 + d1
                down[i] = (d0 / z, d1 / z)
            b0, b1 = below[i][0] * down[i][0], below[i][1] * down[i][1]
            out[i] = b1 / (b0 + b1)
        return out

    def text(self, html: str | None) -> str:
        """The blocks of the content nodes, one per line."""
        if not html:
            return ""
        dom = Dom(html)
        keep = [m > 0.5 for m in self.marginals(dom)]
        for i in range(1, len(keep)):  # inline elements go with their block
            if dom.tag[i] not in BLOCK:
                keep[i] = keep[dom.parent[i]] and dom.tag[i] not in HIDDEN
        blocks, parts = [], []
        for node, text in [*dom.runs, (-1, "")]:
            if node < 0:
                if parts:
                    block = " ".join("".join(parts).split())
                    if block:
                        blocks.append(block)
                    parts = []
            elif keep[node]:
                parts.append(text)
        return "\n".join(blocks)


def observe(pages: list[str], weight: int = 1, layout: bool = True) -> tuple[Counter, Counter]:
    """Counts of (feature, label) and (parent's label, label) over the labelled pages."""
    feature, edge = Counter(), Counter()
    for html in pages:
        dom = Dom(html)
        y = labels(dom, layout)
        if y is None:
            continue
        for i, own in enumerate(features(dom)):
            if i and dom.tag[i] not in HIDDEN:
                edge[y[dom.parent[i]], y[i]] += weight
                for f in own:
                    feature[f, y[i]] += weight
    return feature, edge


def learn(pages: DataFrame, html: str = "html", key: str = "page_id", sample: int = SAMPLE) -> Model:
    """Train on the labelled layouts and the labelled ones of about ``sample`` pages."""
    ship(pages.sparkSession)
    feature, edge = observe(LAYOUTS, SEED_WEIGHT)
    rows = pages.where(F.col(html).isNotNull())
    n, cut = rows.count(), 1 << 30
    if n:
        rate = min(cut, -(-cut * sample // n))
        chosen = rows.where(F.pmod(F.xxhash64(F.lit("pages"), key), F.lit(cut)) < rate).select(html)

        def count(batches):
            for b in batches:
                f, e = observe(b.column(0).to_pylist(), layout=False)
                yield pa.RecordBatch.from_pylist(
                    [{"name": k, "y": y, "n": v} for (k, y), v in f.items()]
                    + [{"name": f"e:{p}", "y": y, "n": v} for (p, y), v in e.items()],
                    schema=pa.schema([("name", pa.string()), ("y", pa.int64()), ("n", pa.int64())]))

        # features of a bounded sample
        for r in chosen.mapInArrow(count, "name string, y long, n long").groupBy("name", "y").agg(
                F.sum("n").alias("n")).collect():
            if r["name"].startswith("e:"):
                edge[int(r["name"][2:]), r["y"]] += r["n"]
            else:
                feature[r["name"], r["y"]] += r["n"]
    return Model.train(feature, edge)


def _extract(model: Model, pages: pa.Array) -> list:
    out = [model.text(h.as_py()) for h in pages]
    return [out, [len(t) for t in out]]


def extract(pages: DataFrame, model: Model, html: str = "html", text: str = "text",
            n_chars: str = "n_chars") -> DataFrame:
    """Append the main text and its number of code points."""
    return arrow_map(pages, [html], [StructField(text, StringType(), False),
                                     StructField(n_chars, LongType(), False)], partial(_extract, model))
