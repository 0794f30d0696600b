"""Training pages: texts of sampled pages set in many layouts, each part marked as main text or not.

The pages of a corpus seldom say which of their parts are the article, and those that do (by an `article` or `main` element) say it
all in one way. A model trained on them alone would learn that element. So their texts are set again: containers with and without telling
names, menus, notices, adverts, forms, comments, sidebars and footers in changing order and depth, all drawn by a seed.
"""

from __future__ import annotations

from html import escape

import numpy as np

from docmill.llm.dom import LABEL

# Names that authors give to parts of a page.
CONTENT = "content article post entry story main text body page-content post-body entry-content article-body main-content".split()
NEUTRAL = "wrapper container row col page site inner block box layout grid section outer".split()
MENU = "menu nav navbar navigation breadcrumbs breadcrumb topnav links toc pagination tabs".split()
HEADER = "header masthead top site-header banner branding page-header".split()
FOOTER = "footer site-footer bottom copyright legal colophon page-footer".split()
SIDEBAR = "sidebar aside widget secondary rail right-column left-column side".split()
NOTICE = "cookie cookie-banner notice consent gdpr alert message popup modal newsletter".split()
ADVERT = "ad ads advert advertisement sponsor sponsored promo banner-ad promotion".split()
SHARE = "share social sharing related related-posts recommended more-stories tags meta byline author-box".split()
COMMENTS = "comments comment comment-list responses discussion replies respond reader-comments".split()
FORM = "form search search-form subscribe signup login contact-form".split()


class Layouts:
    """Pages drawn from headings, paragraphs and short texts (each list holds one text at least)."""

    def __init__(self, seed: int, headings: list[str], paragraphs: list[str], shorts: list[str]):
        self.rng = np.random.default_rng(seed)
        self.headings, self.paragraphs, self.shorts = headings, paragraphs, shorts

    def one(self, choices: list) -> object:
        return choices[int(self.rng.integers(len(choices)))]

    def maybe(self, chance: float) -> bool:
        return bool(self.rng.random() < chance)

    def some(self, low: int, high: int) -> range:
        return range(int(self.rng.integers(low, high + 1)))

    def paragraph(self) -> str:
        text = escape(str(self.one(self.paragraphs)))
        if self.maybe(0.15):
            text = f'{text} <a href="/x">{self.short()}</a> {self.short()}.'
        return f"<b>{text}</b>" if self.maybe(0.05) else text

    def short(self) -> str:
        return escape(str(self.one(self.shorts)))

    def named(self, names: list[str], chance: float = 0.85) -> str:
        if not self.maybe(chance):
            return ""
        name = self.one(names)
        if self.maybe(0.3):
            name = f"{name} {self.one(NEUTRAL)}"
        return f' {"id" if self.maybe(0.3) else "class"}="{name}"'

    def part(self, tag: str, names: list[str], inside: str, kept: int = 0, chance: float = 0.85) -> str:
        return f'<{tag}{self.named(names, chance)} {LABEL}="{kept}">{inside}</{tag}>'

    def links(self, low: int, high: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{self.short()}</a></li>' for i in self.some(low, high)) + "</ul>"

    def menu(self) -> str:
        if self.maybe(0.3):
            inside = " | ".join(f'<a href="/{i}">{self.short()}</a>' for i in self.some(3, 9))
        else:
            inside = self.links(3, 12)
        return self.part("nav", MENU, inside, chance=0.3) if self.maybe(0.5) else self.part("div", MENU, inside, chance=0.9)

    def advert(self) -> str:
        return self.part(str(self.one(["div", "div", "aside", "section"])), ADVERT, self.paragraph() if self.maybe(0.6) else f"<p>{self.paragraph()}</p>", chance=0.97)

    def form(self) -> str:
        fields = "".join(f"<label>{self.short()}</label><input name=x>" for _ in self.some(1, 4))
        return self.part("form", FORM, f"<p>{self.short()}</p>{fields}<button>{self.short()}</button>", chance=0.5)

    def notice(self) -> str:
        return self.part(str(self.one(["div", "div", "aside", "section", "dialog"])), NOTICE, f"<p>{self.paragraph()}</p>" + (f"<button>{self.short()}</button>" if self.maybe(0.6) else ""), chance=0.97)

    def comments(self) -> str:
        item = str(self.one(["div", "li", "article"]))
        items = "".join(
            f'<{item}{self.named(COMMENTS, 0.7)}><{"div" if self.maybe(0.5) else "p"}>{self.short()}</{"div" if self.maybe(0.5) else "p"}><p>{self.paragraph()}</p></{item}>'
            for _ in self.some(1, 6))
        items = f"<ol>{items}</ol>" if item == "li" else items
        head = f"<h3>{self.short()}</h3>" if self.maybe(0.7) else ""
        return self.part(str(self.one(["div", "section", "section", "aside"])), COMMENTS, head + items + (self.form() if self.maybe(0.4) else ""), chance=0.97)

    def sidebar(self) -> str:
        inside = "".join(self.one([
            f"<h3>{self.short()}</h3>{self.links(2, 8)}", f"<div><p>{self.paragraph()}</p></div>", f"<h4>{self.short()}</h4><p>{self.short()}</p>", self.form(),
        ]) for _ in self.some(1, 4))
        return self.part("aside", SIDEBAR, inside, chance=0.5) if self.maybe(0.5) else self.part("div", SIDEBAR, inside, chance=0.97)

    def header(self) -> str:
        inside = (f"<h1>{self.short()}</h1>" if self.maybe(0.3) else f"<div>{self.short()}</div>") + (self.menu() if self.maybe(0.5) else "") + (f"<p>{self.short()}</p>" if self.maybe(0.4) else "")
        return self.part("header", HEADER, inside, chance=0.4) if self.maybe(0.6) else self.part("div", HEADER, inside, chance=0.97)

    def footer(self) -> str:
        inside = self.one([f"&copy; {self.paragraph()}", f"<p>&copy; {self.short()} &middot; {self.short()}</p>", self.links(2, 6) + f"<p>{self.paragraph()}</p>"])
        return self.part("footer", FOOTER, str(inside), chance=0.4) if self.maybe(0.6) else self.part("div", FOOTER, str(inside), chance=0.97)

    def share(self) -> str:
        return self.part("div", SHARE, self.links(2, 6) if self.maybe(0.5) else f"<p>{self.short()}</p>{self.links(1, 4)}", chance=0.97)

    def article(self) -> str:
        title = f'<h1 {LABEL}="1">{escape(str(self.one(self.headings)))}</h1>' if self.maybe(0.8) else ""
        parts = [f"<header>{title}</header>" if title and self.maybe(0.15) else title]
        if self.maybe(0.15):
            parts.append(self.share())
        plain = self.maybe(0.1)
        for _ in self.some(1, 14):
            text = self.paragraph() if self.maybe(0.8) else self.short()
            parts.append(text + "<br>" if plain and self.maybe(0.3) else f"<div>{text}</div>" if plain else f"<p>{text}</p>" if self.maybe(0.9) else f"<p>{text}")
            if self.maybe(0.08):
                parts.append(f"<h2>{self.short()}</h2>")
            if self.maybe(0.04):
                parts.append("<ul>" + "".join(f"<li>{self.paragraph()}</li>" for _ in self.some(1, 5)) + "</ul>")
            if self.maybe(0.03):
                parts.append(f"<blockquote><p>{self.paragraph()}</p></blockquote>")
            if self.maybe(0.03):
                parts.append("<table>" + "".join(f"<tr><td>{self.short()}</td><td>{self.short()}</td></tr>" for _ in self.some(1, 4)) + "</table>")
            if self.maybe(0.05):
                parts.append(str(self.one([self.advert, self.share, self.form, self.notice])()))
        if self.maybe(0.15):
            parts.append(str(self.one([self.share, self.comments, self.advert, self.sidebar])()))
        inside = "".join(parts)
        tag = str(self.one(["article", "article", "main", "div", "div", "div", "section", "td"]))
        if tag == "td":
            return f'<table><tr><td {LABEL}="1">{inside}</td></tr></table>'
        out = self.part(tag, CONTENT, inside, 1, chance=0.3 if tag in ("article", "main") else 0.85)
        if self.maybe(0.2):
            out = self.part("main", NEUTRAL, out, 1, chance=0.3)
        return out

    def page(self) -> str:
        before = [self.one([self.header, self.menu, self.notice, self.advert, self.form, self.sidebar]) for _ in self.some(0, 4)]
        after = [self.one([self.footer, self.comments, self.sidebar, self.advert, self.share, self.menu, self.notice, self.form]) for _ in self.some(0, 4)]
        if self.maybe(0.5):
            before.insert(0, self.header)
        if self.maybe(0.6):
            after.append(self.footer)
        middle = "".join(str(f()) for f in before[1:]) + self.article() + "".join(str(f()) for f in after[:-1])
        for _ in self.some(0, 3):
            middle = f"<div{self.named(NEUTRAL, 0.6)}>{middle}</div>"
        return "<body>" + "".join(str(f()) for f in before[:1]) + middle + "".join(str(f()) for f in after[-1:]) + "</body>"
