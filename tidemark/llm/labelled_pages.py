"""Labelled pages for the extraction model: drawn from a grammar of page layouts, content blocks marked."""

from __future__ import annotations

import random
from collections.abc import Iterator

#: Stands before the text of each block that belongs to the article.
CONTENT_MARK = "\ue000"
# Syllables of invented words, and class names per part of a page.
_SYLLABLES = "an ber ca do el fi gu ha in jo ka le mi no or pa que ri sta tu ver wi zo é ü ment tion".split()
_CLASSES = {
    "nav": ["nav", "main-menu", "navbar top", "breadcrumbs", "site-navigation"],
    "header": ["site-header", "masthead", "topbar", "banner", "logo"],
    "footer": ["footer", "site-footer", "colophon", "legal bottom"],
    "aside": ["sidebar", "related", "widget recent", "right-rail", "trending"],
    "notice": ["cookie-notice", "notice", "alert", "consent-banner", "newsletter popup", "message"],
    "advert": ["ad", "ads", "advert", "sponsored", "promo-box", "advertisement"],
    "form": ["search-form", "login", "contact-form", "signup"],
    "comments": ["comments", "comment-list", "reader-comments", "discussion", "replies"],
    "content": ["content", "post", "entry-content", "story", "article-body", "css-x1", "wrap", "page", "col-8"],
}


class _Page:
    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choices(_SYLLABLES, k=self.rng.randint(1, 3)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def sentences(self, most: int) -> str:
        return " ".join(self.words(2, 14).capitalize() + self.rng.choice("....?!") for _ in range(self.rng.randint(1, most)))

    def link(self, text: str) -> str:
        return f'<a href="/{self.word()}">{text}</a>'

    def named(self, kind: str) -> str:
        name = self.rng.choice(_CLASSES[kind])
        return f' {self.rng.choice(["class", "class", "id"])}="{name}"'

    def element(self, tag: str, kind: str, inner: str, named_share: float) -> str:
        name = self.named(kind) if self.rng.random() < named_share else ""
        return f"<{tag}{name}>{inner}</{tag}>"

    def links(self) -> str:
        items = [self.link(self.words(1, 3)) for _ in range(self.rng.randint(2, 6))]
        form = self.rng.random()
        if form < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return " | ".join(items) if form < 0.8 else "".join(f"<div>{x}</div>" for x in items)

    def around(self, kind: str) -> str:
        rng = self.rng
        if kind == "nav":
            return self.element("nav", kind, self.links(), 0.3) if rng.random() < 0.6 else self.element("div", kind, self.links(), 1)
        if kind == "header":
            inner = rng.choice([f"<h1>{self.words(1, 4)}</h1>", f"<div>{self.link(self.words(1, 3))}</div>", f"<p>{self.sentences(1)}</p>"])
            inner += rng.choice(["", f"<p>{self.words(2, 6)}</p>", self.links()])
            return self.element("header", kind, inner, 0.3) if rng.random() < 0.6 else self.element("div", kind, inner, 1)
        if kind == "footer":
            inner = rng.choice(["&copy; ", "© 2020 ", "Copyright ", ""]) + self.words(1, 3)
            inner = rng.choice([inner + " &middot; " + self.sentences(1), f"<p>{inner}. All rights reserved.</p>", self.links() + inner, f"<p>{self.sentences(3)}</p>"])
            return self.element("footer", kind, inner, 0.3) if rng.random() < 0.6 else self.element("div", kind, inner, 1)
        if kind == "aside":
            inner = f"<{rng.choice(['h2', 'h3', 'h4'])}>{self.words(1, 4)}</h3>" + rng.choice([self.links(), f"<p>{self.sentences(3)}</p>", self.links() + f"<p>{self.sentences(2)}</p>", f"<ul><li>{self.sentences(1)}</li><li>{self.words(2, 8)}</li></ul>"])
            return self.element("aside", kind, inner, 0.4) if rng.random() < 0.6 else self.element(rng.choice(["div", "section"]), kind, inner, 1)
        if kind == "notice":
            inner = rng.choice([self.sentences(2), f"<p>{self.sentences(3)}</p>", f"<p>We use cookies. {self.sentences(1)}</p><button>{self.word()}</button>", f"<h4>{self.words(1, 4)}</h4><p>{self.sentences(2)}</p>"])
            if rng.random() < 0.15:
                return f'<div {rng.choice(["hidden", "aria-hidden=true", "style=display:none"])}>{inner}</div>'
            if rng.random() < 0.2:
                return f'<div role="{rng.choice(["alert", "dialog"])}">{inner}</div>'
            return self.element(rng.choice(["div", "div", "section", "aside", "p"]) if "<" not in inner else rng.choice(["div", "section"]), kind, inner, 1)
        if kind == "advert":
            inner = rng.choice([self.sentences(2), f"<p>{self.sentences(2)}</p>", self.link(self.sentences(1)), f"<h3>{self.words(2, 5)}</h3><p>{self.sentences(2)}</p>"])
            return self.element(rng.choice(["div", "div", "aside", "section", "ins"]) if "<" in inner else rng.choice(["div", "div", "p"]), kind, inner, 1)
        if kind == "form":
            inner = rng.choice([f"<p>{self.sentences(2)}</p>", f"<label>{self.words(1, 3)}</label>", f"<legend>{self.words(1, 3)}</legend>"])
            inner += f'<input type="text"><select><option>{self.word()}<option>{self.word()}</select><button>{self.words(1, 2)}</button>'
            return self.element("form", kind, inner, 0.3)
        items = [
            rng.choice([f"<p>{self.sentences(4)}</p>", f"<h4>{self.words(1, 2)}</h4><p>{self.sentences(3)}</p>", self.sentences(2)])
            for _ in range(rng.randint(1, 4))
        ]
        tag, name = rng.choice([("div", "comment"), ("article", "comment"), ("li", "comment"), ("div", ""), ("article", "reply"), ("blockquote", "")])
        inner = rng.choice(["", f"<h2>{self.words(1, 2)}</h2>", "<h3>Comments</h3>"]) + "".join(
            f'<{tag} class="{name}">{x}</{tag}>' if name else f"<{tag}>{x}</{tag}>" for x in items
        )
        return self.element(rng.choice(["section", "div", "ol", "aside"]), "comments", inner, 1)

    def body_block(self) -> str:
        rng, m = self.rng, CONTENT_MARK
        form = rng.random()
        text = self.sentences(rng.choice([1, 2, 6]))
        if form < 0.62:
            if rng.random() < 0.3:
                text = text.replace(" ", f" {self.link(self.word())} ", 1)
            return f"<p>{m}{text}" + rng.choice(["</p>", "</p>", "</p>", ""])
        if form < 0.72:
            return f"<{rng.choice(['h2', 'h3'])}>{m}{self.words(1, 7)}</h2>"
        if form < 0.8:
            return "<ul>" + "".join(f"<li>{m}{rng.choice([self.words(1, 9), self.sentences(2)])}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        if form < 0.85:
            return f"<blockquote><p>{m}{text}</p></blockquote>" if rng.random() < 0.5 else f"<blockquote>{m}{text}</blockquote>"
        if form < 0.89:
            return f"<figure><img src=x><figcaption>{m}{self.words(2, 9)}</figcaption></figure>"
        if form < 0.93:
            return "<table><tr>" + "".join(f"<td>{m}{self.words(1, 3)}</td>" for _ in range(3)) + "</tr></table>"
        if form < 0.97:
            return f"<div>{m}{text}</div>"
        return f"<pre>{m}{self.words(3, 20)}</pre>"

    def content(self) -> str:
        rng, m = self.rng, CONTENT_MARK
        title = f"<h1>{m}{self.words(1, 9)}</h1>"
        if rng.random() < 0.25:
            title = f"<header>{title}</header>"
        elif rng.random() < 0.1:
            title = ""
        blocks = [self.body_block() for _ in range(rng.randint(1, 10))]
        for kind in ("advert", "aside", "notice", "form", "comments"):
            if rng.random() < 0.15:
                blocks.insert(len(blocks) if kind == "comments" else rng.randint(0, len(blocks)), "</p>" + self.around(kind))
        inner = title + "".join(blocks)
        form = rng.random()
        if form < 0.4:
            return self.element("article", "content", inner, 0.3)
        if form < 0.55:
            return self.element("main", "content", inner, 0.3)
        if form < 0.65:
            return f"<main>{self.element('article', 'content', inner, 0.3)}</main>"
        if form < 0.9:
            return self.element(rng.choice(["div", "div", "section"]), "content", inner, 0.8)
        return inner if form < 0.95 else f"<table><tr><td>{inner}</td></tr></table>"

    def page(self) -> str:
        rng = self.rng
        before = [self.around(k) for k in ("notice", "header", "nav", "advert", "form", "aside") if rng.random() < 0.5]
        after = [self.around(k) for k in ("comments", "aside", "advert", "form", "notice", "footer") if rng.random() < 0.5]
        if rng.random() < 0.3:
            rng.shuffle(before)
        return f"<html><head><title>{self.words(2, 5)}</title></head><body>{''.join(before)}{self.content()}{''.join(after)}</body></html>"


def labelled_pages(count: int, seed: int = 7) -> Iterator[str]:
    """So many pages; equal arguments give equal pages."""
    return (_Page(seed * 1_000_003 + i).page() for i in range(count))
