"""Main text of web pages: boosted trees judge every node of the page, and the best judgement without contradiction wins.

A node is all article, all other, or mixed. Gradient-boosted trees give the three probabilities from the node's own
tag and attribute words, those above it, the density of text and links in its subtree, its depth, place, and siblings.
Decoding takes the most likely assignment in which all below an article node is article, all below an other node is
other, and only mixed nodes leave the choice to their children; a text run is one or the other. This is exact, by one
pass up and one down the tree.

The trees are fitted in numpy on ``PAGES`` pages of ``layouts``, whose article texts are known (``pages`` has no labels).
The model is small and goes to the tasks; each page is read whole and alone, so nothing is shuffled.

Defined results: a null or empty page has an empty text; text outside markup is judged like any other; repeated rows
and rows with null ids give a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm import boosting, layouts
from tidemill.llm.common import slices
from tidemill.llm.dom import BIT, GROUPS, Blocks

PAGES = 700
OTHER, ARTICLE, MIXED = 0, 1, 2
TAGS = {
    "p": "p", "#page": "page", "html": "page", "body": "page", "div": "div", "section": "div", "article": "article", "main": "article",
    "li": "li", "ul": "list", "ol": "list", "dl": "list", "td": "cell", "th": "cell", "table": "table", "tr": "table", "tbody": "table",
    "blockquote": "quote", "pre": "quote", "figure": "quote", "h1": "h1", **{f"h{k}": "h" for k in range(2, 7)}, "": "run",
}
KINDS = sorted({*TAGS.values(), "other"})
KIND = {t: KINDS.index(k) for t, k in TAGS.items()}
GOOD = BIT["article"]
# Kinds of which it counts whether one lies above a node.
NOTED = {t: 1 << ("article", "li", "table", "p", "quote").index(k) for t, k in TAGS.items() if k in ("article", "li", "table", "p", "quote")}


def features(blocks: Blocks) -> np.ndarray:
    """One row per node; all sums over subtrees are differences of running sums, as a subtree is a stretch of nodes."""
    n = len(blocks.tag)
    nodes = np.arange(n)
    parent, stop, depth = (np.array(x, dtype=np.int64) for x in (blocks.parent, blocks.stop, blocks.depth))
    own, above = np.array(blocks.own, dtype=np.int64), np.array(blocks.above, dtype=np.int64)
    kind = np.array([KIND.get(t, KINDS.index("other")) for t in blocks.tag])
    chars = np.array([len(t) for t in blocks.text], dtype=np.float64)
    words = np.array([t.count(" ") + 1 if t else 0 for t in blocks.text], dtype=np.float64)
    marks = np.array([t.count(".") + t.count(",") + t.count("!") + t.count("?") if t else 0 for t in blocks.text], dtype=np.float64)
    linked = np.array(blocks.linked, dtype=np.float64)
    leaf = kind == KIND[""]

    def below(x: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(x)))
        return total[stop] - total[:-1]

    sub_chars, sub_words, sub_links, runs = below(chars), below(words), below(linked), below(leaf)
    page = np.searchsorted(np.array(blocks.pages), nodes, side="right") - 1
    start = np.array(blocks.pages)[page]
    whole = np.maximum(sub_chars[start], 1)
    before = np.concatenate(([0.0], np.cumsum(chars)))[:-1]
    before -= before[start]
    # Siblings lie in page order: sorted by parent they are neighbours.
    by_parent = np.lexsort((nodes, parent))
    by_parent = by_parent[parent[by_parent] != by_parent]
    same = parent[by_parent][1:] == parent[by_parent][:-1]
    previous, following = np.full(n, -1), np.full(n, -1)
    previous[by_parent[1:][same]] = by_parent[:-1][same]
    following[by_parent[:-1][same]] = by_parent[1:][same]
    children = np.bincount(parent[by_parent], minlength=n)
    place = np.zeros(n)
    firsts = np.concatenate(([True], ~same)) if len(by_parent) else np.zeros(0, dtype=bool)
    place[by_parent] = np.arange(len(by_parent)) - np.maximum.accumulate(np.where(firsts, np.arange(len(by_parent)), 0))
    alike = np.bincount(np.unique(parent[by_parent] * len(KINDS) + kind[by_parent], return_inverse=True)[1]) if len(by_parent) else None
    like = np.zeros(n)
    if alike is not None:
        like[by_parent] = alike[np.unique(parent[by_parent] * len(KINDS) + kind[by_parent], return_inverse=True)[1]]
    density = sub_links / np.maximum(sub_chars, 1)
    size = np.log1p(sub_chars)
    beside = lambda x, at: np.where(at >= 0, x[at], -1)
    # The nearest node above, or the node itself, that says something: 1 for the article, -1 against it.
    nearest = np.where(own & ~GOOD, -1, np.where(own & GOOD, 1, 0)).tolist()
    noted = [NOTED.get(t, 0) for t in blocks.tag]
    kinds_above = [0] * n
    for k, p in enumerate(blocks.parent):  # parents come first
        if p != k:
            nearest[k] = nearest[k] or nearest[p]
            kinds_above[k] = kinds_above[p] | noted[p]
    nearest, kinds_above = np.array(nearest), np.array(kinds_above)
    holds = [below((own & bit) > 0) > 0 for bit in BIT.values()]
    columns = [
        *(kind == k for k in range(len(KINDS))), *((own & bit) > 0 for bit in BIT.values()),
        *((above & bit) > 0 for bit in BIT.values()), *holds, *((kinds_above >> k) & 1 for k in range(5)), nearest, nearest[parent],
        size, np.log1p(sub_words), density, below(marks) / np.maximum(sub_words, 1), sub_chars / np.maximum(sub_words, 1),
        sub_chars / whole, before / whole, (before + sub_chars) / whole, depth, np.log1p(children), np.log1p(runs),
        sub_chars / np.maximum(runs, 1), place, like, like / np.maximum(children[parent], 1), np.log1p(children[parent]),
        density[parent], size[parent], beside(size, previous), beside(density, previous), beside(size, following),
        beside(density, following), beside(nearest, previous), beside(nearest, following),
        below(kind == KIND["p"]), below(kind == KIND["article"]) > 0, beside(kind == KIND["p"], previous), beside(kind == KIND["p"], following),
    ]
    return np.stack([np.asarray(c, dtype=np.float32) for c in columns], axis=1)


def decode(blocks: Blocks, shares: np.ndarray) -> list[bool]:
    """For every node whether it belongs to the article, from log probabilities by node."""
    n = len(blocks.tag)
    total = np.concatenate((np.zeros((1, 2)), np.cumsum(shares[:, :2], axis=0)))
    ends = np.array(blocks.stop)
    other = (total[ends, 0] - total[:-1, 0]).tolist()
    article = (total[ends, 1] - total[:-1, 1]).tolist()
    mixed = shares[:, 2].tolist()
    parent, tag = blocks.parent, blocks.tag
    for k in range(n - 1, -1, -1):
        if not tag[k]:
            mixed[k] = -np.inf
        if parent[k] != k:
            mixed[parent[k]] += max(other[k], article[k], mixed[k])
    chosen = [MIXED] * n
    for k in range(n):
        if parent[k] == k:  # the page as such is always open
            continue
        up = chosen[parent[k]]
        if up != MIXED:
            chosen[k] = up
        elif mixed[k] > other[k] and mixed[k] > article[k]:
            chosen[k] = MIXED
        else:
            chosen[k] = ARTICLE if article[k] > other[k] else OTHER
    return [c == ARTICLE for c in chosen]


def texts(blocks: Blocks, model: boosting.Boosted) -> list[str]:
    """Main text of every page: its article runs, two line feeds between them."""
    if not blocks.pages:
        return []
    kept = decode(blocks, model.log_shares(features(blocks)))
    bounds = [*blocks.pages, len(blocks.tag)]
    return ["\n\n".join(blocks.text[k] for k in range(a, b) if kept[k] and blocks.text[k]) for a, b in zip(bounds, bounds[1:])]


def labelled(pages: list[str]) -> tuple[Blocks, np.ndarray]:
    """Nodes of marked pages, their marks taken off, and what each node is; nodes without text are other."""
    blocks = Blocks()
    for page in pages:
        blocks.add(page)
    mine = np.array([t.startswith(layouts.MARK) for t in blocks.text])
    blocks.text = [t.replace(layouts.MARK, "") for t in blocks.text]
    chars = np.array([len(t) for t in blocks.text])
    total = lambda x: np.concatenate(([0], np.cumsum(x)))
    stop = np.array(blocks.stop)
    good, all_ = (total(c)[stop] - total(c)[:-1] for c in (chars * mine, chars))
    return blocks, np.where(good == 0, OTHER, np.where(good == all_, ARTICLE, MIXED))


@lru_cache(maxsize=4)
def train(pages: int = PAGES, kinds: tuple[str, ...] = layouts.LAYOUTS) -> boosting.Boosted:
    blocks, labels = labelled(layouts.pages(pages, layouts=kinds))
    return boosting.fit(features(blocks), labels, 3)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, ``text`` and ``n_chars`` of every page."""
    rows = pages.select("page_id", "url", F.col(html).alias("html"))
    model = pages.sparkSession.sparkContext.broadcast(train())
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 1 << 20):
            blocks = Blocks()
            for page in batch.column("html").to_pylist():
                blocks.add(page or "")
            found = texts(blocks, model.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
