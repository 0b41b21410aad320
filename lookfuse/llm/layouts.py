"""Labelled pages to train on: random layouts whose every element says whether main text is in it.

``data-truth`` marks the elements of the main text and those that hold it; the reader hands it to training only.
"""

from __future__ import annotations

import numpy as np

# Names that pages give to their parts.
NAMES = {
    "wrap": "wrap container page site outer inner layout grid row col x1 app root".split(),
    "content": "article content post entry story main-content post-body entry-content article-text prose".split(),
    "menu": "nav menu navbar main-menu breadcrumbs site-nav pagination links".split(),
    "header": "header masthead top-bar site-header banner logo brand".split(),
    "footer": "footer site-footer colophon bottom copyright legal".split(),
    "side": "sidebar aside widget related-posts recommended more-stories rail popular".split(),
    "advert": "ad ads ad-slot advert advertisement sponsored promo ad_top adsense".split(),
    "notice": "cookie-notice cookie-banner notice alert consent popup newsletter subscribe-box".split(),
    "comments": "comments comment-list discussion replies responses reader-comments".split(),
    "share": "share social share-bar follow-us post-meta tags byline".split(),
}
SYLLABLES = "an be cor den el fi gra hu in jo ka lum mi nor os pa qui re so ti un ver wa xi yo zen ö é ß ñ".split()


class Layouts:
    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def pick(self, items: list):
        return items[int(self.rng.integers(len(items)))]

    def text(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        found = ["".join(self.pick(SYLLABLES) for _ in range(int(self.rng.integers(1, 4)))) for _ in range(n)]
        for i in range(n):
            if i == n - 1 or self.chance(0.1):
                found[i] += "."
            elif self.chance(0.07):
                found[i] += ","
        if self.chance(0.1):
            found = [f + self.pick(["!!", "###", "&amp;&amp;", "$$$", " |"]) for f in found]
        return " ".join(found).capitalize()

    def el(self, tag: str, truth: int, inside: str, name: str | None = None, p: float = 0.9) -> str:
        named = ""
        if name and self.chance(p):
            value = self.pick(NAMES[name])
            value = self.pick([value, f"{value} {self.pick(NAMES['wrap'])}", f"{value}-{self.rng.integers(9)}", f"js-{value}"])
            named = f' {self.pick(["class", "class", "id"])}="{value}"'
        return f'<{tag} data-truth="{truth}"{named}>{inside}</{tag}>'

    def bare(self, tag: str, inside: str, name: str) -> str:
        """A part by its own element, often without a name, or by a div with one."""
        return self.el(tag, 0, inside, name, 0.4) if self.chance(0.6) else self.el(self.pick(["div", "section"]), 0, inside, name, 0.97)

    def links(self, low: int, high: int, listed: bool) -> str:
        found = [f'<a href="/{i}">{self.text(1, 3)}</a>' for i in range(int(self.rng.integers(low, high + 1)))]
        if listed:
            return self.el("ul", 0, "".join(self.el("li", 0, x) for x in found))
        return self.pick([" ", " | ", ""]).join(found)

    def menu(self) -> str:
        tag = self.pick(["nav", "nav", "div", "ul"])
        return self.el(tag, 0, self.links(2, 12, tag != "ul" and self.chance(0.7)), "menu", 0.5 if tag == "nav" else 0.9)

    def header(self) -> str:
        parts = [self.el(self.pick(["div", "p", "h1", "h2"]), 0, self.text(1, 4)), self.menu() if self.chance(0.6) else "", self.form() if self.chance(0.3) else ""]
        return self.bare("header", "".join(parts), "header")

    def advert(self) -> str:
        inside = self.text(2, 30)
        if self.chance(0.4):
            inside = f'<a href="/ad">{inside}</a>'
        if self.chance(0.4):
            inside = self.el(self.pick(["p", "div", "span"]), 0, inside)
        return self.el(self.pick(["div", "div", "aside", "section"]), 0, inside, "advert", 1)

    def notice(self) -> str:
        inside = self.el("p", 0, self.text(6, 40)) if self.chance(0.7) else self.text(6, 40)
        return self.el(self.pick(["div", "section", "aside"]), 0, inside + (f"<button>{self.text(1, 2)}</button>" if self.chance(0.6) else ""), "notice", 1)

    def form(self) -> str:
        inside = f"<label>{self.text(1, 3)}</label><input name=q>" + (self.el("p", 0, self.text(3, 12)) if self.chance(0.4) else "") + f"<button>{self.text(1, 1)}</button>"
        return self.el("form", 0, inside)

    def side(self) -> str:
        parts = []
        for _ in range(int(self.rng.integers(1, 4))):
            parts.append(self.el(self.pick(["h3", "h4", "p"]), 0, self.text(1, 4)))
            parts.append(self.links(2, 8, True) if self.chance(0.6) else self.el("p", 0, self.text(5, 40)))
            if self.chance(0.3):
                parts.append(self.advert())
        return self.bare("aside", "".join(parts), "side")

    def comments(self) -> str:
        def one() -> str:
            inside = self.el(self.pick(["p", "div", "h4"]), 0, self.text(1, 3)) + "".join(self.el("p", 0, self.text(4, 60)) for _ in range(int(self.rng.integers(1, 3))))
            return self.el(self.pick(["div", "li", "article"]), 0, inside, "comments", 0.6)

        inside = self.el("h3", 0, self.text(1, 3)) + "".join(one() for _ in range(int(self.rng.integers(1, 9)))) + (self.form() if self.chance(0.4) else "")
        return self.el(self.pick(["section", "div", "ol"]), 0, inside, "comments", 1)

    def share(self) -> str:
        return self.el(self.pick(["div", "ul", "p"]), 0, self.links(2, 6, False), "share", 1)

    def footer(self) -> str:
        copy = f"&copy; {self.text(1, 20)}" if self.chance(0.6) else self.text(3, 25)
        if self.chance(0.3):
            copy += f" &middot; {self.text(2, 12)}"
        inside = (self.el("p", 0, copy) if self.chance(0.5) else copy) + (self.links(1, 8, self.chance(0.4)) if self.chance(0.6) else "")
        return self.bare("footer", inside, "footer")

    def part(self) -> str:
        kind = self.rng.random()
        if kind < 0.74:
            body = self.text(1, 120) if self.chance(0.8) else self.text(1, 8)
            if self.chance(0.15):
                body = f'{body} <a href="/x">{self.text(1, 5)}</a> {self.text(1, 20)}'
            if self.chance(0.1):
                body = f"<b>{body}<br>"
            return self.el("p", 1, body)
        if kind < 0.82:
            return self.el(self.pick(["h2", "h3"]), 1, self.text(1, 8))
        if kind < 0.88:
            return self.el(self.pick(["ul", "ol"]), 1, "".join(self.el("li", 1, self.text(2, 25)) for _ in range(int(self.rng.integers(2, 6)))))
        if kind < 0.92:
            return self.el("blockquote", 1, self.el("p", 1, self.text(5, 40)))
        if kind < 0.94:
            return self.el("table", 1, "".join(self.el("tr", 1, "".join(self.el("td", 1, self.text(1, 4)) for _ in range(3))) for _ in range(int(self.rng.integers(2, 5)))))
        if kind < 0.96:
            return self.el("div", 1, self.text(10, 60))
        if kind < 0.97:
            return self.el("pre", 1, self.text(5, 30))
        return self.pick([self.advert, self.share, self.form, self.notice, self.side])()

    def content(self) -> str:
        inside = "".join(self.part() for _ in range(int(self.rng.integers(1, 14))))
        if self.chance(0.2):
            inside = self.el("div", 1, inside, "content", 0.5)
        title = self.el(self.pick(["h1", "h1", "h2"]), 1, self.text(1, 12))
        if self.chance(0.15):
            title = self.el("header", 1, title)
        inside = title + (self.share() if self.chance(0.15) else "") + inside + (self.share() if self.chance(0.15) else "")
        style = self.rng.random()
        if style < 0.08:
            return inside
        if style < 0.48:
            return self.el("article", 1, inside, "content", 0.3)
        if style < 0.63:
            return self.el("main", 1, inside if self.chance(0.5) else self.el("article", 1, inside), "content", 0.3)
        return self.el(self.pick(["div", "div", "section"]), 1, inside, "content", 0.8)

    def page(self) -> str:
        middle = self.content()
        if self.chance(0.4):
            both = [middle, self.side()]
            middle = self.el("div", 1, "".join(both if self.chance(0.7) else both[::-1]), "wrap", 0.7)
        before = [self.header() if self.chance(0.5) else "", self.menu() if self.chance(0.7) else "", self.notice() if self.chance(0.35) else "", self.advert() if self.chance(0.5) else ""]
        self.rng.shuffle(before)
        after = [self.comments() if self.chance(0.35) else "", self.side() if self.chance(0.2) else "", self.advert() if self.chance(0.2) else "", self.footer() if self.chance(0.85) else "", self.notice() if self.chance(0.1) else ""]
        inside = "".join([*map(str, before), middle, *after])
        for _ in range(int(self.rng.integers(0, 3))):
            inside = self.el("div", 1, inside, "wrap", 0.7)
        head = f"<head><title>{self.text(1, 8)}</title><style>p{{margin:0}}</style></head>"
        return f"<!DOCTYPE html><html>{head}<body>{inside}<script>var x = '<p>';</script></body></html>"
