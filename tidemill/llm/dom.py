"""HTML to blocks: a forgiving reader that gives the block elements of a page as a tree, their text runs as leaves.

Inline markup is folded into the text run around it; a run ends where a block starts or ends. Comments, scripts, styles
and other elements whose content is no text are skipped. Character references are decoded and white space becomes one blank.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

# What attribute words and tags say about a node; the first speaks for the article, the others against it.
GROUPS = ("article", "nav", "head", "foot", "side", "ad", "notice", "comment", "share", "form", "hidden")
BIT = {g: 1 << k for k, g in enumerate(GROUPS)}
# Whole words, and stems that longer words may hold.
WORDS = {
    "article": "article content contents main body post entry story text prose page hentry markdown blog",
    "nav": "nav menu menus toc tabs pager links crumbs skip", "head": "header head masthead topbar logo brand branding top",
    "foot": "footer foot bottom copyright colophon legal", "side": "sidebar side aside rail widget widgets related more trending popular",
    "ad": "ad ads adv dfp adslot adbox sponsor promo banner outbrain taboola", "notice": "notice alert popup modal overlay toast gdpr dialog warning disclaimer",
    "comment": "comment comments reply replies respond disqus thread", "share": "share sharing social follow like tweet",
    "form": "form search login signin signup register button input", "hidden": "hidden invisible none hide",
}
STEMS = {
    "nav": "navbar navig breadcrumb paginat sitemap", "head": "masthead siteheader pageheader", "foot": "footer copyright",
    "side": "sidebar related recommend trending", "ad": "advert sponsor adsense promot", "notice": "cookie consent newsletter subscri paywall",
    "comment": "comment discuss", "share": "sharing sharebar social",
}
TAG_GROUP = {
    "article": "article", "main": "article", "nav": "nav", "menu": "nav", "header": "head", "footer": "foot", "aside": "side",
    "form": "form", "button": "form", "select": "form", "label": "form", "fieldset": "form", "option": "form", "legend": "form",
    "noscript": "notice", "dialog": "notice",
}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template iframe noembed noframes textarea title svg math object video audio canvas".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav noscript ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCKS - frozenset("body button caption html label legend noscript option select tbody td tfoot th thead tr".split())
# A start tag ends an open element of these names, looked for up to the nearest element that bounds it.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"),
        "thead": ("tbody", "thead", "tfoot", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tfoot", "tr", "td", "th")}
BOUNDS = frozenset("ul ol menu dir dl table select html body".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>""",
    re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
SPEAKING = frozenset(("class", "id", "role", "itemprop", "aria-label"))
_word = {w: BIT[g] for g, ws in WORDS.items() for w in ws.split()}
_stem = {s: BIT[g] for g, ss in STEMS.items() for s in ss.split()}


@lru_cache(maxsize=1 << 14)
def attribute_groups(attributes: str) -> int:
    """Groups that the words of class, id and role name."""
    bits = 0
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("hidden", "aria-hidden") and value.strip("\"'").lower() != "false":
            bits |= BIT["hidden"]
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            bits |= BIT["hidden"]
        elif name in SPEAKING:
            for word in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value):
                word = word.lower()
                bits |= _word.get(word, 0)
                for stem, bit in _stem.items():
                    if stem in word:
                        bits |= bit
            joined = value.strip("\"'").lower()
            bits |= _word.get(joined, 0)
    return bits


class Blocks:
    """Nodes of any number of pages in page order, as parallel lists. A leaf (``tag`` empty) is a text run.

    ``stop`` is the place behind the last node of the subtree; the first node of a page is its own parent.
    """

    def __init__(self):
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.own: list[int] = []
        self.above: list[int] = []
        self.stop: list[int] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self.pages: list[int] = []

    def _node(self, tag: str, parent: int, groups: int) -> int:
        k = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent if parent >= 0 else k)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.own.append(groups)
        self.above.append(self.above[parent] | self.own[parent] if parent >= 0 else 0)
        self.stop.append(k + 1)
        self.text.append("")
        self.linked.append(0)
        return k

    def add(self, page: str) -> None:
        """Read one page."""
        root = self._node("#page", -1, 0)
        self.pages.append(root)
        stack = [root]
        run: list[str] = []
        links: list[str] = []
        in_link = False
        tags = self.tag

        def flush() -> None:
            if run:
                text = " ".join("".join(run).split())
                if text:
                    leaf = self._node("", stack[-1], 0)
                    self.text[leaf] = text
                    self.linked[leaf] = min(len(" ".join("".join(links).split())), len(text))
                run.clear()
                links.clear()

        def close(to: int) -> None:
            flush()
            while len(stack) > to:
                self.stop[stack.pop()] = len(tags)

        at, end = 0, len(page)
        while at < end:
            found = TOKEN.search(page, at)
            if at < (stop := found.start() if found else end):
                piece = page[at:stop]
                if "&" in piece:
                    piece = html.unescape(piece)
                run.append(piece)
                if in_link:
                    links.append(piece)
            if not found:
                break
            at = found.end()
            if name := found[2]:
                name = name.lower()
                attributes = found[3]
                if name in SKIPPED and not attributes.endswith("/"):
                    closing = _closing(name).search(page, at)
                    at = closing.end() if closing else end
                elif name == "a":
                    in_link = True
                elif name in VOID:
                    if name == "hr":
                        flush()
                    elif name == "br":
                        run.append(" ")
                elif name in BLOCKS:
                    in_link = in_link and name not in ENDS_P
                    if name in ENDS_P:
                        for k in range(len(stack) - 1, 0, -1):
                            if tags[stack[k]] == "p":
                                close(k)
                                break
                            if tags[stack[k]] in ("td", "th", "button", "table"):
                                break
                    ended = ENDS.get(name)
                    if ended:
                        cut = 0
                        for k in range(len(stack) - 1, 0, -1):
                            if tags[stack[k]] in ended:
                                cut = k
                                if len(ended) == 1:
                                    break
                            elif tags[stack[k]] in BOUNDS:
                                break
                        if cut:
                            close(cut)
                    flush()
                    group = TAG_GROUP.get(name)
                    groups = BIT[group] if group else 0
                    if attributes:
                        groups |= attribute_groups(attributes)
                    if name in ("html", "body"):
                        groups = 0
                    stack.append(self._node(name, stack[-1], groups))
            elif name := found[1]:
                name = name.lower()
                if name == "a":
                    in_link = False
                elif name in BLOCKS and name not in ("body", "html"):
                    for k in range(len(stack) - 1, 0, -1):
                        if tags[stack[k]] == name:
                            close(k)
                            break
        close(0)


@lru_cache(maxsize=64)
def _closing(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I)
