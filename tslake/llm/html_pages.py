"""Pages with known main text, made by rule, that the block labeller learns from.

No table labels the blocks of a page, so the labeller is fitted on a bounded
number of such pages: a seed, templates of menus, headers, adverts, notices,
sidebars, forms, comments and footers around articles of many shapes: in named
elements or in elements whose names tell nothing, as paragraphs or as lines
parted by ``br``, in the cells of a layout table, or as a page's only block. A
byline or date that stands in the article is part of it.
"""

from __future__ import annotations

import random

#: Stands before every block of main text.
MARK = "\x01"
_SYLLABLES = "th er on an re he in ed nd ha ent ing ion es or ti eau ou ch un sch ver keit gen co do ra mos ción lla é ü ß ñ".split()
_SMALL = "the of and to in a is that for it as was with be by on not he la le de les et des un en que der die und das el los y".split()
_BOILER = "home about contact privacy terms login register search menu share subscribe newsletter copyright rights reserved cookies accept advertisement sponsored related reply comment comments posted tags categories follow us sitemap help".split()


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        r = self.r
        return r.choice(_SMALL) if r.random() < 0.35 else "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def prose(self, low: int = 1, high: int = 6) -> str:
        r = self.r
        out = " ".join(self.words(1, 20).capitalize() + r.choice([".", ".", ".", "?", "!"]) for _ in range(r.randint(low, high)))
        style = r.random()
        if style < 0.05:
            out = out.upper().replace(" ", "!! ")
        elif style < 0.1:
            out = " ".join(w + r.choice(["***", "&amp;&amp;&amp;", "%%%", "$$$", "###"]) for w in out.split())
        return out

    def boiler(self) -> str:
        r = self.r
        if r.random() < 0.55:
            return self.prose(1, 3)
        return " ".join(r.choice(_BOILER) if r.random() < 0.5 else self.word() for _ in range(r.randint(1, 9))).capitalize()

    def tag(self, name: str, inner: str, *classes: str) -> str:
        r = self.r
        kind = [r.choice(classes)] if classes else []
        if r.random() < 0.2:
            kind.append(self.word())
        attribute = f' {r.choice(["class", "class", "id"])}="{" ".join(kind)}"' if kind else ""
        return f"<{name}{attribute}>{inner}</{name}>"

    def some(self, chance: float, make) -> str:
        return make() if self.r.random() < chance else ""

    # boilerplate

    def links(self) -> str:
        r = self.r
        items = [f'<a href="/{self.word()}">{self.words(1, 3) if r.random() < 0.7 else r.choice(_BOILER)}</a>' for _ in range(r.randint(2, 9))]
        if r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return r.choice([" ", " | ", " > "]).join(items)

    def menu(self) -> str:
        return self.tag("nav", self.links()) if self.r.random() < 0.6 else self.tag("div", self.links(), "nav", "menu", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs")

    def header(self) -> str:
        inner = self.some(0.6, lambda: self.tag(self.r.choice(["h1", "h2", "div", "p"]), self.words(1, 4))) + self.some(0.5, self.menu) + self.some(0.4, lambda: f"<p>{self.boiler()}</p>")
        return self.tag("header", inner) if self.r.random() < 0.6 else self.tag("div", inner, "header", "masthead", "site-header", "banner")

    def advert(self) -> str:
        inner = self.boiler() if self.r.random() < 0.6 else f"<p>{self.boiler()}</p>"
        return self.tag(self.r.choice(["div", "div", "aside", "section"]), inner, "ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot")

    def notice(self) -> str:
        inner = f"<p>{self.boiler()}</p>" + self.some(0.5, lambda: f'<a href="#">{self.words(1, 2)}</a>') if self.r.random() < 0.6 else self.boiler()
        return self.tag(self.r.choice(["div", "section"]), inner, "cookie-notice", "cookie", "notice", "alert", "gdpr", "consent", "popup", "modal")

    def sidebar(self) -> str:
        inner = self.some(0.6, lambda: f"<h3>{self.words(1, 4)}</h3>") + (self.links() if self.r.random() < 0.5 else f"<p>{self.boiler()}</p>" * self.r.randint(1, 2))
        return self.tag("aside", inner) if self.r.random() < 0.5 else self.tag("div", inner, "sidebar", "side", "widget", "related", "recommended")

    def form(self) -> str:
        return self.tag("form", f"<label>{self.boiler()}</label><input name='q'><button>{self.words(1, 2)}</button>" + self.some(0.5, lambda: f"<p>{self.boiler()}</p>"))

    def comments(self) -> str:
        r = self.r
        one = lambda: self.some(0.5, lambda: self.tag("div", self.words(1, 3), "author", "meta", "user")) + f"<p>{self.prose(1, 3)}</p>" + self.some(0.4, lambda: '<a href="#">Reply</a>')
        kind, item = r.choice([("ol", "li"), ("ul", "li"), ("div", "div"), ("section", "article"), ("section", "div")])
        inner = self.some(0.6, lambda: f"<h{r.randint(2, 3)}>{r.choice(['Comments', self.words(1, 3)])}</h3>") + "".join(
            self.tag(item, one(), "comment", "comment-body", "reply") if item != "li" or r.random() < 0.5 else f"<li>{one()}</li>" for _ in range(r.randint(1, 5))
        )
        return self.tag(kind, inner, "comments", "comment-list", "commentlist", "responses", "disqus")

    def share(self) -> str:
        return self.tag("div", self.links(), "share", "social", "tags", "related", "pagination")

    def footer(self) -> str:
        inner = self.r.choice([f"&copy; {self.word()}.{self.word()}.example &middot; {self.prose(1, 2)}", f"<p>{self.boiler()}</p>" + self.links(), self.links(), self.boiler()])
        return self.tag("footer", inner) if self.r.random() < 0.7 else self.tag("div", inner, "footer", "site-footer", "bottom", "copyright")

    # main text

    def paragraph(self) -> str:
        r = self.r
        text = MARK + (self.prose(1, 7) if r.random() < 0.9 else self.boiler() + r.choice([".", ""]))
        if r.random() < 0.15:
            text += f' <a href="/x">{self.words(1, 4)}</a> {self.words(1, 6)}.'
        if r.random() < 0.15:
            text = f"<{(t := r.choice(['b', 'em', 'strong', 'span', 'i']))}>{text}" + r.choice([f"</{t}>", "<br>"])
        return f"<p>{text}" + ("</p>" if r.random() < 0.9 else "")

    def byline(self) -> str:
        r = self.r
        text = r.choice([f"By {self.words(1, 3)}", self.words(1, 5), f"{r.randint(1, 31)} {self.word()} {r.randint(1990, 2030)}", f"{self.words(1, 3)}, {r.randint(1990, 2030)}-{r.randint(1, 12)}-{r.randint(1, 28)}"])
        return self.tag(r.choice(["div", "div", "p", "address"]), MARK + text, "byline", "meta", "date", "author", "published", "info")

    def loose(self) -> str:
        """An article in one element, its parts parted by br."""
        r = self.r
        gap = r.choice(["<br>", "<br><br>", "<br/>\n<br/>", "<br>\n"])
        text = MARK + gap.join(self.prose(1, 5) for _ in range(r.choice([1, 1, 2, 3, 5, 9])))
        head = self.some(0.4, lambda: f"<h{r.choice([1, 1, 2, 3])}>{MARK}{self.words(1, 9)}</h1>") + self.some(0.15, self.byline)
        more = self.some(0.3, lambda: f"<p>{MARK}{self.prose()}</p>")
        shape = r.random()
        if shape < 0.35:
            return self.tag("div", head + text + more, "content", "post", "entry", "article", "main", "text", "body", "story")
        if shape < 0.55:
            return self.tag("div", head + text + more, self.word(), self.word())
        if shape < 0.8:
            return f"<{(t := r.choice(['div', 'center', 'section', 'font']))}>{head}{text}{more}</{t}>"
        return head + text + more

    def plain_menu(self) -> str:
        """Links in an element whose name tells nothing."""
        return self.tag("div", self.links(), self.word(), "links", "list", "box", "top", "left") if self.r.random() < 0.7 else f"<div>{self.links()}</div>"

    def table_page(self) -> str:
        r = self.r

        def cell(inner: str, *classes: str) -> str:
            return self.tag("td", inner, *classes) if r.random() < 0.6 else f"<td>{inner}</td>"

        main = cell(self.loose() if r.random() < 0.5 else self.article(), "content", "main", "text", "body", self.word())
        cells = [main]
        for _ in range(r.choice([0, 1, 1, 2])):
            side = cell(r.choice([self.links, self.links, self.menu, self.sidebar, self.advert])(), "nav", "menu", "side", "sidebar", "left", "right", self.word())
            cells.insert(r.choice([0, 0, len(cells)]), side)
        row = lambda inner: f"<tr><td colspan={len(cells)}>{inner}</td></tr>"
        top = self.some(0.5, lambda: row(r.choice([self.header, self.links, lambda: f"<b>{self.words(1, 4)}</b>"])()))
        bottom = self.some(0.6, lambda: row(r.choice([self.footer, self.links, lambda: f"&copy; {self.boiler()}"])()))
        return f"<table width=100%>{top}<tr>{''.join(cells)}</tr>{bottom}</table>"

    def article(self) -> str:
        r = self.r
        parts = []
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 14])):
            kind = r.random()
            if kind < 0.78:
                parts.append(self.paragraph())
            elif kind < 0.84:
                parts.append(f"<h{r.randint(2, 4)}>{MARK}{self.words(1, 7)}</h3>")
            elif kind < 0.88:
                parts.append("<ul>" + "".join(f"<li>{MARK}{self.prose(1, 2)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.91:
                parts.append(f"<blockquote>{MARK}{self.prose()}</blockquote>")
            elif kind < 0.93:
                parts.append("<table>" + "".join(f"<tr><td>{MARK}{self.words(1, 5)}</td><td>{MARK}{self.words(1, 5)}</td></tr>" for _ in range(r.randint(1, 3))) + "</table>")
            elif kind < 0.95:
                parts.append(f"<pre>{MARK}{self.words(2, 20)}</pre>")
            elif kind < 0.97:
                parts.append(f"<figure><img src='x'><figcaption>{MARK}{self.words(2, 12)}</figcaption></figure>")
            else:
                parts.append(r.choice([self.advert, self.sidebar, self.share, self.notice, self.form])())
        head = self.some(0.85, lambda: f"<h{r.choice([1, 1, 1, 2])}>{MARK}{self.words(1, 9)}</h1>") + self.some(0.3, self.byline)
        if not parts and not head:
            head = self.paragraph()
        inner = head + "".join(parts)
        shape = r.random()
        if shape < 0.6:
            inner = f"<article>{inner}</article>" if r.random() < 0.8 else self.tag("article", inner, "post", "entry", "story")
            return f"<main>{inner}</main>" if r.random() < 0.3 else inner
        if shape < 0.7:
            return f"<main>{inner}</main>"
        if shape < 0.95:
            return self.tag(r.choice(["div", "section"]), inner, "content", "post", "entry", "article", "main", "story", "post-content", "article-body", "main-content")
        return f"<div>{inner}</div>" if shape < 0.975 else self.tag("div", inner, self.word(), self.word())

    def page(self) -> str:
        m = self.some
        before = m(0.5, self.header) + m(0.7, self.menu) + m(0.3, self.notice) + m(0.4, self.advert) + m(0.15, self.sidebar)
        after = m(0.2, self.share) + m(0.35, self.comments) + m(0.3, self.sidebar) + m(0.2, self.advert) + m(0.2, self.form) + m(0.8, self.footer) + m(0.1, self.notice)
        kind = self.r.random()
        if kind < 0.06:  # the page's only block or blocks
            before, after = "", ""
        elif kind < 0.2:
            before, after = before + m(0.5, self.plain_menu), m(0.3, self.plain_menu) + after
        if kind > 0.88:
            body = m(0.3, self.header) + self.table_page() + m(0.3, self.footer)
        else:
            body = before + (self.loose() if self.r.random() < 0.15 else self.article()) + after
        if self.r.random() < 0.3:
            body = f"<div>{body}</div>"
        return f"<html><head><title>{self.words(1, 6)}</title><style>p{{}}</style></head><body>{body}" + ("</body></html>" if self.r.random() < 0.9 else "")


def labelled_pages(count: int, seed: int) -> list[str]:
    maker = Maker(seed)
    return [maker.page() for _ in range(count)]
