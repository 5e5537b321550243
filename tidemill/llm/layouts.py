"""Labelled pages for the main-text model: page layouts drawn by chance, with a mark before every text of the article.

Wording, lengths and languages are the same for articles and everything else, so only the structure can be learnt.
"""

from __future__ import annotations

import random

MARK = ""
SYLLABLES = "the an re ing tion ble ed of ou ha nd sch ein un ver lich la que ment eau de os ción para lo é ä ü ñ".split()
LAYOUTS = ("article", "main", "soup", "table", "bare", "section", "sparse")
MENU = ["nav", "menu", "main-menu", "navbar", "top-nav", "navigation", "breadcrumbs", "pagination", "site-nav", "tabs"]
HEAD = ["header", "site-header", "masthead", "topbar", "page-header", "branding"]
FOOT = ["footer", "site-footer", "page-footer", "copyright", "colophon", "bottom"]
SIDE = ["sidebar", "side", "widget-area", "rail", "related-posts", "recommended", "trending", "more-stories", "aside"]
AD = ["ad", "ads", "advert", "advertisement", "ad-slot", "sponsored", "promo", "banner", "adsbygoogle", "promotion"]
NOTICE = ["cookie-notice", "cookie-banner", "notice", "alert", "popup", "modal", "newsletter", "subscribe-box", "consent", "site-notice", "gdpr"]
COMMENT = ["comments", "comment-list", "discussion", "responses replies", "comments-area", "disqus_thread"]
SHARE = ["share", "social-links", "share-buttons", "follow-us", "social"]
FORM = ["search-form", "login", "signup", "contact-form", "register"]
CONTENT = ["content", "post", "article", "entry-content", "post-body", "article-body", "main-content", "story", "page-content", "entry", "text"]
PLAIN = ["wrap", "container", "row", "col-8", "inner", "box", "sc-1a2b", "u-flex", "grid", "css-x9f"]


class Page:
    def __init__(self, seed: int, layout: str | None = None):
        self.r = random.Random(seed)
        self.layout = layout or self.r.choice(LAYOUTS)
        self.named = self.r.random() > 0.12  # some pages have names that say nothing

    def words(self, n: int) -> str:
        out = ["".join(self.r.choices(SYLLABLES, k=self.r.randint(1, 3))) for _ in range(n)]
        for k in range(len(out)):
            if k == 0 or out[k - 1].endswith("."):
                out[k] = out[k].capitalize()
            if self.r.random() < 0.1:
                out[k] += self.r.choice([".", ",", ".", " |", ":"])
            if self.r.random() < 0.01:
                out[k] = str(self.r.randint(1, 10 ** 9))
        return " ".join(out) + self.r.choice(["", ".", ".", ".", "!"])

    def attr(self, names: list[str]) -> str:
        if not self.named:
            names = PLAIN
        return self.r.choice(['class="{}"', 'class="{}"', 'id="{}"', "class='{}'", 'class="x {}"']).format(self.r.choice(names))

    def some(self, share: float) -> bool:
        return self.r.random() < share

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{k}">{self.words(self.r.randint(1, 4))}</a></li>' for k in range(n))

    # ---- what is not the article

    def menu(self) -> str:
        tag = self.r.choice(["nav", "nav", "div", "ul"])
        items = self.links(self.r.randint(3, 9))
        if tag == "ul":
            return f"<ul {self.attr(MENU)}>{items}</ul>"
        if self.some(0.3):
            items = " | ".join(f'<a href="#">{self.words(1)}</a>' for _ in range(5))
        return f"<{tag}{'' if tag == 'nav' and self.some(0.5) else ' ' + self.attr(MENU)}><ul>{items}</ul></{tag}>"

    def header(self) -> str:
        inner = self.r.choice([f"<h1>{self.words(2)}</h1>", f"<div>{self.words(3)}</div>", f"<p>{self.words(self.r.randint(2, 12))}</p>"])
        inner += self.menu() if self.some(0.5) else ""
        return f"<header>{inner}</header>" if self.some(0.5) else f"<div {self.attr(HEAD)}>{inner}</div>"

    def footer(self) -> str:
        text = "&copy; " + self.words(self.r.randint(2, 25))
        inner = self.r.choice([text, f"<p>{text}</p>", f"<ul>{self.links(4)}</ul><p>{text}</p>"])
        return f"<footer>{inner}</footer>" if self.some(0.6) else f"<div {self.attr(FOOT)}>{inner}</div>"

    def sidebar(self) -> str:
        inner = f"<h3>{self.words(2)}</h3><ul>{self.links(self.r.randint(2, 8))}</ul>"
        inner += f"<p>{self.words(self.r.randint(5, 40))}</p>" if self.some(0.4) else ""
        return f"<aside>{inner}</aside>" if self.some(0.5) else f"<div {self.attr(SIDE)}>{inner}</div>"

    def block(self, names: list[str], most: int = 30) -> str:
        tag = self.r.choice(["div", "div", "section", "p", "aside"])
        text = self.words(self.r.randint(2, most))
        inner = self.r.choice([text, text, f"<p>{text}</p>", f'<a href="#">{text}</a>']) if tag != "p" else text
        return f"<{tag} {self.attr(names)}>{inner}</{tag}>"

    def form(self) -> str:
        inner = f"<label>{self.words(2)}</label><input name=q><button>{self.words(1)}</button>"
        inner += f"<p>{self.words(self.r.randint(3, 20))}</p>" if self.some(0.5) else ""
        return f"<form {self.attr(FORM)}>{inner}</form>" if self.some(0.8) else f"<div {self.attr(FORM)}>{inner}</div>"

    def comments(self) -> str:
        tag = self.r.choice(["div", "li", "article", "section"])
        each = "".join(
            f'<{tag} class="{self.r.choice(["comment", "reply", "comment-body"])}"><p>{self.words(self.r.randint(2, 80))}</p></{tag}>'
            for _ in range(self.r.randint(1, 6)))
        named, self.named = self.named, True
        out = f"<{(outer := self.r.choice(['section', 'div', 'div']))} {self.attr(COMMENT)}><h3>{self.words(2)}</h3>{each}</{outer}>"
        self.named = named
        return out

    def extra(self) -> str:
        """Something between or beside the parts of the article."""
        kind = self.r.randrange(5)
        if kind == 0:
            return self.block(AD)
        if kind == 1:
            return self.block(NOTICE)
        if kind == 2:
            return f"<div {self.attr(SHARE)}><ul>{self.links(3)}</ul></div>" if self.some(0.5) else self.block(SHARE, 6)
        return self.form() if kind == 3 else self.sidebar()

    # ---- the article

    def own(self, n: int) -> str:
        words = self.words(n).split(" ")
        if n > 6 and self.some(0.2):
            words[3] = f'<a href="/x">{words[3]}</a>'
        if n > 8 and self.some(0.2):
            words[5] = f"<b>{words[5]}</b>"
        return MARK + " ".join(words)

    def paragraph(self) -> str:
        n = self.r.choice([1, 2, 4, 10, 30, 60, 120, 250])
        kind = self.r.random()
        if kind < 0.62:
            return f"<p>{self.own(n)}{'</p>' if self.some(0.85) else ''}"
        if kind < 0.72:
            return f"<p><b>{self.own(n)}<br><p>{self.own(self.r.randint(1, 60))}</p>"
        if kind < 0.80:
            return f"<h{(k := self.r.randint(2, 4))}>{self.own(self.r.randint(1, 8))}</h{k}>"
        if kind < 0.88:
            return "<ul>" + "".join(f"<li>{self.own(self.r.randint(1, 20))}</li>" for _ in range(self.r.randint(2, 6))) + "</ul>"
        if kind < 0.92:
            return f"<blockquote><p>{self.own(n)}</p></blockquote>"
        if kind < 0.95:
            return f"<pre>{self.own(n)}</pre>"
        if kind < 0.98:
            return "<table>" + "".join(
                f"<tr><td>{self.own(2)}</td><td>{self.own(self.r.randint(1, 5))}</td></tr>" for _ in range(3)) + "</table>"
        return f"<div>{self.own(n)}</div>"

    def article(self) -> str:
        out = [f"<h1>{self.own(self.r.randint(2, 14))}</h1>"] if self.some(0.85) else []
        if out and self.some(0.15):
            out = [f"<header>{out[0]}</header>"]
        for _ in range(self.r.randint(1, 12)):
            out.append(self.paragraph())
            if self.some(0.08):
                out.append("</p>" + self.extra())
        if self.some(0.15):
            out.append("</p>" + self.comments())
        return "".join(out)

    def body(self) -> str:
        text = self.article()
        kind = self.layout
        if kind == "bare":  # nothing but the article
            return text if self.some(0.7) else self.own(80)
        before = [f for f in (self.header, self.menu, lambda: self.block(AD), lambda: self.block(NOTICE), self.form) if self.some(0.45)]
        after = [f for f in (self.sidebar, self.comments, lambda: self.block(AD), lambda: self.block(NOTICE), self.extra) if self.some(0.3)]
        start, stop = "".join(f() for f in before), "".join(f() for f in after) + (self.footer() if self.some(0.8) else "")
        if kind == "article":
            return f"{start}<article>{text}</article>{stop}"
        if kind == "main":
            return f"{start}<main><div {self.attr(PLAIN)}><article {self.attr(CONTENT)}>{text}</article>{stop}</div></main>{self.footer()}"
        if kind == "section":
            return f"<div {self.attr(PLAIN)}>{start}<section {self.attr(CONTENT)}>{text}</section>{stop}</div>"
        if kind == "soup":
            return (f"<div {self.attr(PLAIN)}><div>{start}</div><div {self.attr(CONTENT)}><div {self.attr(PLAIN)}>{text}</div></div>"
                    f"<div>{stop}</div></div>")
        if kind == "table":
            return f"<table><tr><td>{start}</td><td {self.attr(CONTENT)}>{text}</td><td>{stop}</td></tr></table>"
        return f"{start}{text}{stop}"  # sparse: the article's parts lie in the body itself

    def html(self) -> str:
        body = self.body()
        if self.some(0.1):
            return body
        return f"<!DOCTYPE html><html><head><title>{self.words(5)}</title><style>p{{}}</style></head><body>{body}" + (
            "</body></html>" if self.some(0.9) else "")


def pages(n: int, seed: int = 11, layouts: tuple[str, ...] = LAYOUTS) -> list[str]:
    return [Page(seed * 100_003 + k, layouts[k % len(layouts)]).html() for k in range(n)]
