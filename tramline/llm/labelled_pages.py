"""Labelled pages: page layouts put together at random, each block marked.

A page is HTML in which every text block carries its label, 1 for main text and
0 for anything around it. The layouts cover usual ways of building pages: with
and without article elements, menus as lists and as rows of links, side bars,
notices, adverts, forms, comments, unclosed paragraphs. Words are invented, so
that nothing but structure, link share and shape of text can be learnt.
"""

from __future__ import annotations

import random

#: Class and id names that pages use, by what they hold.
NAMES = {
    "nav": ("nav", "menu", "navbar", "main-menu", "breadcrumbs", "site-nav", "pagination"),
    "header": ("header", "site-header", "masthead", "top-bar", "banner-top"),
    "footer": ("footer", "site-footer", "copyright", "bottom", "legal"),
    "side": ("sidebar", "aside", "widget", "related", "side-column", "popular", "tags", "share"),
    "ad": ("ad", "ads", "advert", "sponsored", "promo", "banner", "ad-slot"),
    "notice": ("cookie", "cookie-notice", "consent", "notice", "newsletter", "subscribe", "popup", "alert"),
    "comments": ("comments", "comment-list", "comment", "reader-comments", "replies", "discussion"),
    "content": ("content", "post", "entry", "article-body", "story", "main-text", "post-content", "entry-content"),
    "page": ("wrapper", "container", "page", "row", "col", "layout", "site"),
}


class Page:
    """HTML under construction."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.out: list[str] = []
        self.labels: list[int] = []

    def word(self) -> str:
        return "".join(self.r.choice(("ka", "lo", "mi", "ren", "tu", "sa", "vel", "on", "ira", "pe")) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(4, 16).capitalize() + self.r.choice((".", ".", ".", "!", "?")) for _ in range(self.r.randint(low, high)))

    def tag(self, name: str, kind: str | None = None) -> str:
        how = self.r.random()
        if kind is None or how < 0.2:
            return f"<{name}>"
        return f'<{name} {"class" if how < 0.8 else "id"}="{self.r.choice(NAMES[kind])}">'

    def block(self, name: str, label: int, text: str, close: bool = True) -> None:
        self.labels.append(label)
        self.out.append(f"<{name}>{text}" + (f"</{name}>" if close else ""))

    def links(self, kind: str, element: str) -> None:
        name = element if self.r.random() < 0.6 else "div"
        self.out.append(f'<{name} class="{self.r.choice(NAMES[kind])}">' if name == "div" else self.tag(name, kind))
        listed = self.r.random() < 0.7
        self.out.append("<ul>" * listed)
        for _ in range(self.r.randint(2, 8)):
            self.block("li" if listed else "div", 0, f'<a href="/{self.word()}">{self.words(1, 4)}</a>')
        self.out.append("</ul>" * listed + f"</{name}>")

    def box(self, kind: str, element: str = "div") -> None:
        """A piece of text beside the main one: an advert, a notice, a side bar."""
        name = element if self.r.random() < 0.5 else "div"
        self.out.append(f'<{name} class="{self.r.choice(NAMES[kind])}">' if name == "div" else self.tag(name, kind))
        for _ in range(self.r.randint(1, 3)):
            style = self.r.random()
            text = self.sentences(1, 3) if style < 0.7 else f'<a href="#">{self.words(2, 6)}</a>'
            if style < 0.3:
                self.labels.append(0)
                self.out.append(text)
                break
            self.block(self.r.choice(("p", "p", "div", "h3")), 0, text)
        self.out.append(f"</{name}>")

    def form(self) -> None:
        self.out.append(self.tag("form", "notice"))
        self.block("label", 0, self.words(1, 4))
        self.block("button", 0, self.words(1, 2).capitalize())
        self.out.append("</form>")

    def comments(self) -> None:
        name = self.r.choice(("section", "div", "ol"))
        self.out.append(f'<{name} {self.r.choice(("class", "id"))}="{self.r.choice(NAMES["comments"])}">')
        if self.r.random() < 0.6:
            self.block("h3", 0, self.words(1, 3).capitalize())
        for _ in range(self.r.randint(1, 5)):
            self.block("li" if name == "ol" else self.r.choice(("p", "div")), 0, self.sentences(1, 4))
        self.out.append(f"</{name}>")

    def main(self) -> None:
        element = self.r.choice(("article", "article", "main", "div", "section"))
        self.out.append(f'<{element} {self.r.choice(("class", "id"))}="{self.r.choice(NAMES["content"])}">' if element in ("div", "section") else self.tag(element, "content"))
        if self.r.random() < 0.8:
            self.block(self.r.choice(("h1", "h1", "h2")), 1, self.words(2, 10).capitalize())
        for _ in range(self.r.randint(2, 12)):
            kind = self.r.random()
            if kind < 0.62:
                text = self.sentences(1, 8)
                if self.r.random() < 0.2:
                    text = text.replace(" ", f' <a href="/{self.word()}">{self.words(1, 3)}</a> ', 1)
                self.block("p", 1, text, close=self.r.random() < 0.85)
            elif kind < 0.7:
                self.block("p", 1, f"<b>{self.words(1, 12).capitalize()}.<br>", close=False)
            elif kind < 0.76:
                self.block(self.r.choice(("h2", "h3")), 1, self.words(1, 6).capitalize())
            elif kind < 0.82:
                self.out.append("<ul>")
                for _ in range(self.r.randint(1, 5)):
                    self.block("li", 1, self.sentences(1, 2))
                self.out.append("</ul>")
            elif kind < 0.87:
                self.block("blockquote", 1, self.sentences(1, 3))
            elif kind < 0.9:
                self.block("pre", 1, self.words(3, 9))
            elif kind < 0.93:
                self.out.append("<table><tr>")
                for _ in range(self.r.randint(2, 4)):
                    self.block("td", 1, self.words(1, 3))
                self.out.append("</tr></table>")
            elif kind < 0.96:
                self.box("ad")
            elif kind < 0.98:
                self.box("side", "aside")
            else:
                self.out.append("<script>track('<p>')</script><!-- x -->")
        self.out.append(f"</{element}>")

    def made(self) -> tuple[str, list[int]]:
        wrapped = self.r.random() < 0.4
        self.out.append("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>" + self.tag("div", "page") * wrapped)
        before = [("header", 0.5), ("nav", 0.8), ("notice", 0.3), ("ad", 0.5), ("side", 0.25)]
        after = [("comments", 0.45), ("side", 0.4), ("ad", 0.3), ("form", 0.25), ("footer", 0.8), ("notice", 0.2)]
        for part, share in before:
            self.part(part, share)
        self.main()
        for part, share in after:
            self.part(part, share)
        self.out.append("</div>" * wrapped + "</body></html>" * (self.r.random() < 0.9))
        return "".join(self.out), self.labels

    def part(self, part: str, share: float) -> None:
        if self.r.random() > share:
            return
        if part == "nav" or part == "side" and self.r.random() < 0.5:
            self.links(part, "nav" if part == "nav" else "aside")
        elif part == "form":
            self.form()
        elif part == "comments":
            self.comments()
        else:
            self.box(part, {"header": "header", "footer": "footer", "side": "aside"}.get(part, "section"))


def labelled_pages(n: int, seed: int = 0) -> list[tuple[str, list[int]]]:
    """``n`` pages as (html, label of each text block in page order)."""
    return [Page(seed * 1_000_003 + k).made() for k in range(n)]
