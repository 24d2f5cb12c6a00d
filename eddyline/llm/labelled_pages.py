"""Labelled pages to train the extraction model on.

Pages are composed at random (fixed seed) from parts of known role: an article in one of
several wrappings, and around or inside it menus, headers, footers, sidebars, notices,
adverts, forms, related links and reader comments. Each text starts with a mark that is its
label: ``YES`` if it belongs to the article, ``NO`` otherwise. Words are invented, so a model can learn from structure, hints in
class names and the shape of a text, not from topics.
"""

from __future__ import annotations

import numpy as np

PAGES = 400
SEED = 20240607
NO, YES = "\ue000", "\ue001"  # private-use characters, found in no word
SYLLABLES = "ta ri on el mu sa ve no ki la pe do ran tor ing est ali ent our".split()


class _Writer:
    def __init__(self, rng: np.random.Generator):
        self.rng, self.html = rng, []

    def pick(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def word(self) -> str:
        return "".join(self.pick(*SYLLABLES) for _ in range(int(self.rng.integers(1, 4))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(int(self.rng.integers(low, high))))

    def sentence(self, low: int = 3, high: int = 18) -> str:
        return self.words(low, high).capitalize() + self.pick(".", ".", ".", "!", "?")

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(int(self.rng.integers(low, high))))

    def raw(self, html: str) -> None:
        self.html.append(html)

    def block(self, tag: str, text: str, label: int, attrs: str = "", link: bool = False) -> None:
        text = (NO, YES)[label] + text
        inner = f'<a href="/{self.word()}">{text}</a>' if link else text
        self.html.append(f"<{tag}{attrs}>{inner}</{tag}>" if tag else inner)

    def menu(self, tag: str, name: str) -> None:
        attrs = f' class="{name}"' if name else ""
        self.raw(f"<{tag}{attrs}><ul>")
        for _ in range(int(self.rng.integers(2, 8))):
            self.block("li", self.words(1, 4), 0, link=True)
        self.raw(f"</ul></{tag}>")

    def box(self, tag: str, name: str, low: int = 1, high: int = 4, link: float = 0.2) -> None:
        attrs = f' {self.pick("class", "class", "id")}="{name}"' if name else ""
        self.raw(f"<{tag}{attrs}>")
        for _ in range(int(self.rng.integers(low, high))):
            self.block(self.pick("p", "div", "p", "span"), self.pick(self.prose(1, 3), self.words(1, 7)), 0, link=self.chance(link))
            self.raw("<br>" if self.html[-1].startswith("<span") else "")
        self.raw(f"</{tag}>")

    def comments(self) -> None:
        self.raw(f'<{(t := self.pick("section", "div"))} {self.pick("id", "class")}="{self.pick("comments", "comment-list", "user-comments", "disqus_thread", "responses")}">')
        if self.chance(0.6):
            self.block(self.pick("h2", "h3"), self.pick("Comments", "3 comments", self.words(1, 3)), 0)
        for _ in range(int(self.rng.integers(1, 5))):
            self.raw(f'<div class="{self.pick("comment", "comment-body", "reply")}">')
            if self.chance(0.5):
                self.block("span", self.words(1, 3), 0)
                self.raw("<br>")
            self.block("p", self.prose(1, 4), 0)
            self.raw("</div>")
        self.raw(f"</{t}>")

    def form(self) -> None:
        self.raw(f'<form action="/x"{self.pick("", " class=newsletter", " id=search")}>')
        for _ in range(int(self.rng.integers(1, 4))):
            self.block(self.pick("label", "p", "button", "div"), self.words(1, 6), 0)
            self.raw("<br>")
        self.raw('<input type="text"></form>')

    def clutter(self) -> None:
        kind = int(self.rng.integers(7))
        if kind == 0:
            self.box(self.pick("div", "aside", "section"), self.pick("ad", "ads", "advert", "ad-banner", "sponsored", "promo", "advertisement"))
        elif kind == 1:
            self.box(self.pick("aside", "div"), self.pick("sidebar", "widget", "side", "related", ""), link=0.5) if self.chance(0.7) else self.menu(
                "aside", ""
            )
        elif kind == 2:
            self.box(self.pick("div", "section"), self.pick("cookie-notice", "notice", "consent", "popup", "alert", "newsletter"))
        elif kind == 3:
            self.form()
        elif kind == 4:
            self.menu(self.pick("nav", "div"), self.pick("menu", "share", "breadcrumb", "related-links", "social", "pagination"))
        elif kind == 5:
            self.comments()
        else:
            self.box("aside", "")

    def article(self) -> None:
        wrapping = int(self.rng.integers(6))
        opening, closing = (
            ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"),
            ('<main><article class="post">', "</article></main>"), ('<div id="main"><div class="entry-content">', "</div></div>"),
            ("<article>", "</article>"),
        )[wrapping]
        self.raw(opening)
        if self.chance(0.8):
            inside = self.chance(0.15)
            self.raw("<header>" if inside else "")
            self.block("h1", self.words(2, 12).capitalize(), 1)
            self.raw("</header>" if inside else "")
        for _ in range(int(self.rng.integers(1, 12))):
            draw = self.rng.random()
            if draw < 0.6:
                self.block("p", self.pick(self.prose(1, 8), self.prose(1, 3), self.sentence(1, 4)), 1)
            elif draw < 0.66:
                self.block(self.pick("h2", "h3"), self.words(1, 8).capitalize(), 1)
            elif draw < 0.72:
                self.raw("<ul>")
                for _ in range(int(self.rng.integers(1, 5))):
                    self.block("li", self.pick(self.sentence(), self.words(2, 9)), 1)
                self.raw("</ul>")
            elif draw < 0.76:
                self.block("blockquote", self.prose(1, 3), 1)
            elif draw < 0.79:
                self.raw("<table><tr>")
                for _ in range(int(self.rng.integers(1, 4))):
                    self.block("td", self.words(1, 5), 1)
                self.raw("</tr></table>")
            elif draw < 0.82:
                self.block("pre", self.words(2, 10), 1)
            elif draw < 0.86:
                self.block("p", self.words(1, 5), 1, link=self.chance(0.3))
            else:
                self.clutter()
        self.raw(closing)

    def page(self) -> str:
        self.raw("<!DOCTYPE html><html><head><title>x</title></head><body>")
        if self.chance(0.5):
            self.raw("<header>") if (held := self.chance(0.7)) else self.raw('<div class="header">')
            self.block(self.pick("p", "div", "h1", "h2"), self.words(1, 6), 0, link=self.chance(0.5))
            self.raw("</header>" if held else "</div>")
        if self.chance(0.8):
            self.menu(self.pick("nav", "nav", "div"), self.pick("", "menu", "nav", "navbar", "main-menu"))
        for _ in range(int(self.rng.integers(0, 3))):
            self.clutter()
        self.article()
        for _ in range(int(self.rng.integers(0, 3))):
            self.clutter()
        if self.chance(0.4):
            self.comments()
        if self.chance(0.85):
            tag, name = ("footer", "") if self.chance(0.7) else ("div", "footer")
            self.raw(f'<{tag} class="{name}">' if name else f"<{tag}>")
            for _ in range(int(self.rng.integers(1, 4))):
                text = self.pick("© " + self.words(1, 4) + " · " + self.prose(1, 3), self.prose(1, 3), self.words(1, 6))
                self.block(self.pick("p", "div"), text, 0, link=self.chance(0.2))
            self.raw(f"</{tag}>")
        self.raw("</body></html>")
        return "".join(self.html)


def labelled_pages(count: int = PAGES, seed: int = SEED) -> list[str]:
    """Pages with marked texts."""
    rng = np.random.default_rng(seed)
    return [_Writer(rng).page() for _ in range(count)]
