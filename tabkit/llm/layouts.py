"""Labelled pages for training: texts of sampled pages in layouts whose parts are known."""

from __future__ import annotations

import random
from html import escape

#: Names that page parts commonly go by.
ARTICLE = "article content post entry main story body text page prose document markdown detail news blog single primary column wrapper".split()
PARTS = {
    "menu": ("nav", "nav menu navigation navbar topnav breadcrumb breadcrumbs links toc pagination pager tabs sitemap"),
    "header": ("header", "header masthead banner topbar branding logo site title hero"),
    "footer": ("footer", "footer bottom copyright legal colophon credits imprint"),
    "sidebar": ("aside", "sidebar aside widget related recommended popular trending teaser secondary rail more latest"),
    "notice": ("div", "notice cookie consent gdpr alert banner message popup modal overlay privacy paywall warning"),
    "advert": ("div", "ad ads advert advertisement sponsor sponsored promo promotion commercial affiliate dfp"),
    "form": ("form", "form search login signup newsletter subscribe subscription contact register poll survey"),
    "comments": ("section", "comments comment replies reply discussion disqus respond responses thread feedback reviews"),
    "share": ("div", "share social sharing tools follow buttons tags meta byline"),
}
TOKENS = sorted({t for _, names in PARTS.values() for t in names.split()} | set(ARTICLE) | {"hidden", "navigation", "contentinfo", "complementary", "search"})
ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "sidebar": "complementary", "form": "search", "notice": "alert"}


class Layout:
    def __init__(self, rng: random.Random, blocks: list[str]):
        self.rng = rng
        self.blocks = blocks
        self.plain = rng.random() < 0.25  # a page whose names say nothing
        self.semantic = rng.random() < 0.6

    def text(self, low: int, high: int) -> str:
        words = self.rng.choice(self.blocks).split()
        n = self.rng.randint(low, high)
        at = self.rng.randrange(max(1, len(words) - n))
        return escape(" ".join(words[at : at + n]), quote=False)

    def _name(self, names: list[str]) -> str:
        rng = self.rng
        if self.plain or rng.random() < 0.15:
            return f' class="{"".join(rng.choice("bcdfghjkl") for _ in range(6))}"' if rng.random() < 0.5 else ""
        said = rng.choice(names) + (rng.choice("-_") + rng.choice(["list", "box", "wrap", "1", "area", "inner"]) if rng.random() < 0.3 else "")
        return f' {rng.choice(["class", "class", "id"])}="{said}"'

    def _links(self, low: int, high: int) -> str:
        rng = self.rng
        rows = [f'<a href="/{i}">{self.text(1, 4)}</a>' for i in range(rng.randint(low, high))]
        if rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in rows) + "</ul>"
        return rng.choice([" | ", " ", " &middot; "]).join(rows)

    def part(self, kind: str) -> str:
        rng = self.rng
        tag, names = PARTS[kind]
        if kind != "form" and (not self.semantic or rng.random() < 0.3):
            tag = rng.choice(["div", "div", "section", "aside" if kind in ("sidebar", "advert", "notice") else "div"])
        attributes = self._name(names.split())
        if kind in ROLES and rng.random() < 0.15 and not self.plain:
            attributes += f' role="{ROLES[kind]}"'
        body = {
            "menu": lambda: self._links(2, 12),
            "header": lambda: f"<a href='/'>{self.text(1, 3)}</a>" + (f"<p>{self.text(2, 9)}</p>" if rng.random() < 0.5 else "") + (self._links(2, 6) if rng.random() < 0.4 else ""),
            "footer": lambda: f"&copy; {self.text(1, 3)} &middot; {self.text(2, 12)}" + (self._links(2, 8) if rng.random() < 0.5 else ""),
            "sidebar": lambda: f"<h3>{self.text(1, 4)}</h3>" + (self._links(2, 8) if rng.random() < 0.7 else "".join(f"<p>{self.text(4, 40)}</p>" for _ in range(rng.randint(1, 3)))),
            "notice": lambda: rng.choice([f"<p>{self.text(5, 30)}</p>", self.text(5, 30)]) + rng.choice(["", "<button>OK</button>", f"<a href='#'>{self.text(1, 3)}</a>"]),
            "advert": lambda: rng.choice([self.text(3, 16), f"<p>{self.text(3, 30)}</p>", f"<a href='#'>{self.text(2, 9)}</a>"]),
            "form": lambda: f"<label>{self.text(1, 4)}</label><input type=text>" + (f"<p>{self.text(3, 20)}</p>" if rng.random() < 0.5 else "") + "<button>Go</button>",
            "comments": lambda: (f"<h3>{self.text(1, 3)}</h3>" if rng.random() < 0.6 else "") + "".join(self._comment() for _ in range(rng.randint(1, 6))),
            "share": lambda: rng.choice([self._links(2, 5), f"<span>{self.text(2, 6)}</span>"]),
        }[kind]()
        return f'<{tag}{attributes} data-keep="0">{body}</{tag}>'

    def _comment(self) -> str:
        inner = rng_block = f"<p>{self.text(3, 60)}</p>"
        if self.rng.random() < 0.6:
            inner = f"<b>{self.text(1, 2)}</b>" + rng_block
        return self.rng.choice([f"<div{self._name(['comment', 'reply'])}>{inner}</div>", f"<li>{inner}</li>", inner])

    def article(self) -> str:
        rng = self.rng
        rows = [f"<h1>{self.text(2, 12)}</h1>"] if rng.random() < 0.85 else []
        for _ in range(rng.choice([1, 2, 3, 5, 8, 13])):
            kind = rng.random()
            if kind < 0.72:
                text = self.text(1, 6) if rng.random() < 0.15 else self.text(5, 160)
                rows.append(rng.choice([f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<p>{text} <a href='#'>{self.text(1, 4)}</a> {self.text(1, 20)}</p>"]))
            elif kind < 0.78:
                rows.append(f"<h2>{self.text(1, 8)}</h2>")
            elif kind < 0.84:
                rows.append("<ul>" + "".join(f"<li>{self.text(1, 25)}</li>" for _ in range(rng.randint(1, 6))) + "</ul>")
            elif kind < 0.87:
                rows.append(f"<blockquote>{self.text(3, 50)}</blockquote>")
            elif kind < 0.90:
                rows.append("<table>" + "".join(f"<tr><td>{self.text(1, 4)}</td><td>{self.text(1, 9)}</td></tr>" for _ in range(rng.randint(1, 5))) + "</table>")
            elif kind < 0.92:
                rows.append(f"<pre>{self.text(2, 30)}</pre>")
            elif kind < 0.94:
                rows.append(f"<figure><img src=x><figcaption>{self.text(2, 15)}</figcaption></figure>")
            elif not self.plain:
                rows.append(self.part(rng.choice(["share", "advert", "sidebar", "form", "comments"])))
        tag = rng.choice(["article", "article", "main"]) if self.semantic else rng.choice(["div", "section", "td"])
        name = self._name(ARTICLE) if rng.random() < 0.7 else ""
        inside = f'<{tag}{name} data-keep="1">' + "".join(rows)
        if rng.random() < 0.2 and not self.plain:
            inside += self.part("comments")
        inside += f"</{tag}>"
        if tag == "td":
            inside = f"<table><tr>{inside}</tr></table>"
        for _ in range(rng.randrange(3)):
            inside = f"<div{self._name(ARTICLE + ['container', 'layout', 'row'])}>{inside}</div>"
        return inside

    def page(self) -> str:
        rng = self.rng
        kinds = [k for k in PARTS if not (self.plain and k in ("comments", "share", "notice"))]
        before = [self.part(rng.choice(["menu", "header", "notice", "advert", "form", "menu", "share" if not self.plain else "menu"])) for _ in range(rng.randrange(4))]
        after = [self.part(rng.choice(kinds)) for _ in range(rng.randrange(4))]
        head = f"<title>{self.text(2, 8)}</title><style>p{{}}</style><script>var t='</p>';</script>"
        return f"<!DOCTYPE html><html><head>{head}</head><body>{''.join(before)}{self.article()}{''.join(after)}{self.part('footer') if rng.random() < 0.8 else ''}</body></html>"
