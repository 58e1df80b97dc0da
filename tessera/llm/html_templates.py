"""Generated pages with known main text, from which the extractor's trees are learned.

There are no labelled pages among the tables. So pages are put together from random
parts in random order: containers for the article of many kinds, and menus, headers,
footers, sidebars, notices, adverts, forms, related links, share bars and reader
comments, inside and outside of it, with and without telling class names, well-formed
or not. Main text carries a mark that the parser takes out again.
"""

from __future__ import annotations

import random

MARK = "\ue000"  # a private-use character
SYLLABLES = "an the on er in re ti es or ha en st nd th ou ch qu ment tion ing ver ge le la ci ó é ü ß".split()


class PageMaker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(SYLLABLES, k=self.r.choice((1, 1, 2, 2, 3, 4))))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() + ("," if self.r.random() < 0.06 else "") for _ in range(self.r.randint(lo, hi)))

    def sentence(self, lo: int = 1, hi: int = 20) -> str:
        return self.words(lo, hi).capitalize() + self.r.choice(("...", ".", ".", ".", ".", "!", "?", ".***"))[:self.r.choice((1, 1, 1, 4))]

    def prose(self, most: int = 8) -> str:
        out = " ".join(self.sentence() for _ in range(self.r.choice((1, 1, 2, 3, self.r.randint(1, most)))))
        if self.r.random() < 0.2:
            w = self.word()
            out += self.r.choice((f' <a href="/{w}">{w}</a> ', f" <b>{w}</b> ", f" <em>{w} {w}</em>.", " &amp; &lt; "))
        return out

    def named(self, tag: str, names: list[str], inner: str, plain: float = 0.15) -> str:
        """An element with one of the names as class, id or role; sometimes without."""
        if self.r.random() < plain:
            return f"<{tag}>{inner}</{tag}>"
        name = self.r.choice(names)
        style = self.r.choice(('class="{}"', 'id="{}"', "class='{} wrap'", 'class="site-{}"', 'class="{}-box c1"', "id={}"))
        return f"<{tag} {style.format(name)}>{inner}</{tag}>"

    def links(self, lo: int = 3, hi: int = 9) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(lo, hi))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice((" | ", " ", " &middot; ")).join(items)

    def notes(self) -> str:
        """A few sentences of boilerplate, as bare text or in a paragraph."""
        text = " ".join(self.sentence(2, 14) for _ in range(self.r.choice((1, 1, 1, 2, 3))))
        return self.r.choice((text, f"<p>{text}</p>", f"<span>{text}</span>", f"<h3>{self.words(1, 3)}</h3><p>{text}</p>"))

    def menu(self) -> str:
        if self.r.random() < 0.7:
            return f"<nav>{self.links()}</nav>"
        return self.named("div", ["nav", "menu", "navbar", "topnav", "breadcrumbs"], self.links())

    def header(self) -> str:
        inner = self.r.choice((f"<a href='/'>{self.words(1, 3)}</a>", f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.sentence(2, 9)}</p>", self.notes())) + self.r.choice(("", self.menu()))
        return f"<header>{inner}</header>" if self.r.random() < 0.6 else self.named("div", ["header", "masthead", "topbar", "branding"], inner, 0)

    def footer(self) -> str:
        inner = self.r.choice(("&copy; ", "&copy; 2020 ", "", "Copyright ")) + self.word() + ".example.com" + self.r.choice((" &middot; ", " | ", "<br>")) + self.notes()
        inner += self.r.choice(("", self.links(2, 6)))
        return f"<footer>{inner}</footer>" if self.r.random() < 0.7 else self.named("div", ["footer", "bottom", "copyright", "legal"], inner, 0)

    def sidebar(self) -> str:
        inner = "".join(self.r.choice((self.notes(), f"<h3>{self.words(1, 3)}</h3>{self.links()}", f"<div>{self.notes()}</div>")) for _ in range(self.r.randint(1, 3)))
        return self.named("aside", ["sidebar", "side", "widget"], inner, 0.5) if self.r.random() < 0.6 else self.named("div", ["sidebar", "side", "rail", "widget"], inner, 0)

    def advert(self) -> str:
        return self.named(self.r.choice(("div", "div", "aside", "section")), ["ad", "ads", "advert", "sponsored", "promo", "banner"], self.notes(), 0)

    def notice(self) -> str:
        inner = self.notes() + self.r.choice(("", "<button>OK</button>", '<a href="#">OK</a>'))
        return self.named(self.r.choice(("div", "div", "section", "aside", "dialog")), ["notice", "cookie", "consent", "alert", "popup", "cookie-notice"], inner, 0)

    def form(self) -> str:
        inner = self.r.choice(("", f"<p>{self.sentence(2, 9)}</p>", f"<label>{self.words(1, 3)}</label>", f"<h3>{self.words(1, 4)}</h3>"))
        inner += self.words(1, 4) + '<input name="q"><button>Go</button>'
        form = f"<form>{inner}</form>"
        return form if self.r.random() < 0.5 else self.named("div", ["form", "newsletter", "login", "subscribe", "search"], form)

    def related(self) -> str:
        return self.named(self.r.choice(("div", "section", "aside")), ["related", "recommended", "more", "popular", "share", "social", "tags"],
                          f"<h3>{self.words(1, 3)}</h3>" * self.r.randint(0, 1) + self.links(), 0)

    def comments(self) -> str:
        one = self.r.choice((lambda: f"<li><b>{self.word()}</b> {self.prose(3)}</li>", lambda: self.named("div", ["comment", "reply"], f"<p>{self.word()}:</p><p>{self.prose(3)}</p>", 0.1),
                             lambda: f"<p>{self.prose(3)}</p>", lambda: f'<article class="comment">{self.prose(3)}</article>'))
        inner = f"<h2>{self.words(1, 3)}</h2>" * self.r.randint(0, 1) + "".join(one() for _ in range(self.r.randint(1, 7)))
        tag = self.r.choice(("section", "div", "div", "ul", "ol"))
        return self.named(tag, ["comments", "comment-list", "discussion", "replies", "responses", "reader-comments"], inner, 0)

    def boilerplate(self) -> str:
        return self.r.choice((self.menu, self.sidebar, self.advert, self.notice, self.form, self.related, self.advert, self.sidebar))()

    def article(self) -> str:
        r = self.r
        parts = [f"<h1>{MARK}{self.words(1, 10)}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.choice((1, 1, 2, 3, 5, 8, 14, 25))):
            kind = r.random()
            text = f"{MARK}{self.prose()}"
            if kind < 0.7:
                parts.append(f"<p>{text}</p>" if r.random() < 0.85 else f"<p>{text}")
            elif kind < 0.78:
                parts.append(f"<p><b>{text}<br><p>{MARK}{self.prose()}</p>")
            elif kind < 0.84:
                parts.append(f"<h2>{MARK}{self.words(1, 6)}</h2><p>{text}</p>")
            elif kind < 0.88:
                parts.append("<ul>" + "".join(f"<li>{MARK}{self.sentence(2, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.95:
                parts.append(f"<div>{text}</div>")
            else:
                parts.append("<table>" + "".join(f"<tr><td>{MARK}{self.words(1, 4)}</td><td>{MARK}{self.words(1, 4)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            parts.insert(r.randint(0, len(parts)), r.choice((self.advert, self.related, self.notice, self.form, self.sidebar))())
        inner = "".join(parts)
        kind = r.random()
        if kind < 0.5:
            return f"<article>{inner}</article>" if r.random() < 0.7 else self.named("article", ["post", "entry"], inner)
        if kind < 0.65:
            return f"<main>{inner}</main>"
        return self.named(r.choice(("div", "div", "section")), ["content", "article", "main", "post", "entry-content", "story", "article-body"], inner, 0.15)

    def page(self) -> str:
        r = self.r
        before = [f() for f in (self.header, self.menu, self.advert, self.notice, self.sidebar, self.form) if r.random() < 0.4]
        after = [f() for f in (self.comments, self.sidebar, self.advert, self.related, self.form, self.footer, self.footer) if r.random() < 0.4]
        r.shuffle(before)
        article = self.article()
        if r.random() < 0.3:  # in a wrapper together with some of the rest
            article = self.named("div", ["wrapper", "container", "page", "layout"], "".join([*before[-1:], article, *after[:1]]), 0.4)
            before, after = before[:-1], after[1:]
        body = "".join(x + r.choice(("", "", "\n", "<!-- x -->")) for x in [*before, article, *after])
        title = f"<title>{self.words(1, 9)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script>"
        return f"<!DOCTYPE html><html><head>{title}</head><body>{body}" + r.choice(("</body></html>", "", "</body></html>"))


def pages(n: int, seed: int) -> list[str]:
    maker = PageMaker(seed)
    return [maker.page() for _ in range(n)]
