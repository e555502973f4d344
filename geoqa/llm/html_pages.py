"""Labelled pages that the main-text model is trained on.

Page layouts are written by hand: every block that holds text carries ``data-y``
(1: main text, 0: not).  A layout is filled with invented words, and the class
names, tags and order of its parts vary, so one layout gives many pages.  The
attribute is read as the label and is never a feature.
"""

from __future__ import annotations

import random

_SYLLABLES = "ba de ki lo mu na pe ri so tu va we xi yo zu an er is ot ul ing tion ent ak".split()


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 3)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentence(self, lo: int = 5, hi: int = 18) -> str:
        s = self.words(lo, hi)
        if len(s) > 40 and self.r.random() < 0.4:
            s = s.replace(" ", ", ", 1)
        return s.capitalize() + self.r.choice("....?!")

    def text(self, lo: int = 1, hi: int = 6) -> str:
        odd = self.r.random()
        if odd < 0.04:  # lists of words, repeated words, words with signs
            return " | ".join(self.words(1, 2) for _ in range(self.r.randint(2, 30)))
        if odd < 0.08:
            return " ".join(w for _ in range(self.r.randint(1, 5)) for w in [self.word()] * self.r.randint(2, 40))
        if odd < 0.11:
            return " ".join(self.word() + self.r.choice(["###", "%%%", "$$$", "***", "!!", "&amp;&amp;"]) for _ in range(self.r.randint(2, 40)))
        if odd < 0.15:
            return self.words(3, 60)
        s = " ".join(self.sentence() for _ in range(self.r.randint(lo, hi)))
        if self.r.random() < 0.25:
            a, _, b = s.partition(" ")
            s = f"{a} <{(t := self.r.choice(['b', 'i', 'em', 'strong', 'a href=/x', 'span']))}>{self.word()}</{t.split()[0]}> {b}"
        return s

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def some(self, share: float, part: str) -> str:
        return part if self.r.random() < share else ""

    # parts that are not main text
    def links(self, n: int, tag: str = "li") -> str:
        return "".join(f'<{tag} data-y=0><a href="/{self.word()}">{self.words(1, 3)}</a></{tag}>' for _ in range(n))

    def nav(self) -> str:
        n = self.r.randint(2, 9)
        return self.pick(
            f"<nav><ul>{self.links(n)}</ul></nav>",
            f"<nav><div>{self.links(n, 'span')}</div></nav>",
            f'<div class="{self.pick("menu", "navbar", "nav-main", "topnav", "main-menu")}"><ul>{self.links(n)}</ul></div>',
            f'<ul id="{self.pick("menu", "navigation", "nav")}">{self.links(n)}</ul>',
            f'<div class="{self.pick("breadcrumb", "breadcrumbs", "crumbs")}">{self.links(n, "span")}</div>',
            f"<p data-y=0>{' | '.join(f'<a href=/{self.word()}>{self.word()}</a>' for _ in range(n))}</p>")

    def header(self) -> str:
        return self.pick(
            f"<header><h2 data-y=0>{self.words(1, 4)}</h2>{self.nav()}</header>",
            f"<header><p data-y=0>{self.words(1, 6)}</p></header>",
            f'<div class="{self.pick("header", "site-header", "masthead", "top", "branding")}"><p data-y=0>{self.sentence(2, 8)}</p></div>',
            f'<div id="{self.pick("header", "top", "logo")}"><a data-y=0 href="/">{self.words(1, 3)}</a>{self.nav()}</div>')

    def footer(self) -> str:
        body = self.pick(f"&copy; {self.word()}.example &middot; {self.sentence(3, 12)}", f"{self.sentence(3, 8)} All rights reserved.", self.text(1, 3))
        return self.pick(
            f"<footer data-y=0>{body}</footer>", f"<footer><p data-y=0>{body}</p>{self.some(0.5, self.nav())}</footer>",
            f'<div class="{self.pick("footer", "site-footer", "bottom", "copyright", "legal")}"><p data-y=0>{body}</p></div>',
            f'<div id="{self.pick("footer", "foot", "colophon")}" data-y=0>{body}</div>')

    def aside(self) -> str:
        inner = self.pick(f"<h3 data-y=0>{self.words(1, 4)}</h3><ul>{self.links(4)}</ul>", f"<p data-y=0>{self.text(1, 3)}</p>",
                          f"<h4 data-y=0>{self.words(1, 3)}</h4><p data-y=0>{self.text(1, 4)}</p>",
                          "".join(f'<div class="item" data-y=0><a href="/{self.word()}">{self.sentence(3, 9)}</a></div>' for _ in range(4)))
        return self.pick(f"<aside>{inner}</aside>", f'<aside class="{self.word()}">{inner}</aside>',
                         f'<div class="{self.pick("sidebar", "side", "related", "widget", "right-column", "recommended", "more-stories", "tags", "toc")}">{inner}</div>',
                         f'<section class="{self.pick("sidebar", "related", "widgets", "trending", "author-box")}">{inner}</section>',
                         f'<div id="{self.pick("sidebar", "aside", "rail")}">{inner}</div>')

    def advert(self) -> str:
        body = self.pick(self.sentence(3, 12), self.text(1, 2), f"<a href=//ads.example>{self.sentence(3, 8)}</a>")
        return self.pick(f'<div class="{self.pick("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "ad-slot")}" data-y=0>{body}</div>',
                         f'<div class="{self.pick("ad", "promo", "sponsor", "banner")}"><p data-y=0>{body}</p></div>',
                         f'<section class="{self.pick("promo", "sponsored", "advert")}"><p data-y=0>{body}</p></section>',
                         f'<div id="{self.pick("ad1", "advert", "banner")}" data-y=0>{body}</div>')

    def notice(self) -> str:
        body = self.text(1, 3)
        tag = self.pick("div", "section", "div")
        return self.pick(f'<{tag} class="{self.pick("cookie", "cookie-banner", "cookie-notice", "consent", "gdpr", "notice", "alert", "popup", "paywall", "disclaimer", "modal")}">'
                         f"<p data-y=0>{body}</p>{self.some(0.6, f'<button data-y=0>{self.word()}</button>')}</{tag}>",
                         f'<div id="{self.pick("cookies", "notice", "consent", "message")}" data-y=0>{body}</div>',
                         f'<div role="{self.pick("alert", "dialog", "alertdialog")}" data-y=0>{body}</div>')

    def form(self) -> str:
        rows = "".join(f"<label data-y=0>{self.words(1, 2)}</label><input type=text>" for _ in range(self.r.randint(1, 3)))
        return self.pick(f'<form action="/s"><p data-y=0>{self.sentence(2, 9)}</p>{rows}<button data-y=0>{self.word()}</button></form>',
                         f"<form>{rows}<select><option data-y=0>{self.word()}</option><option data-y=0>{self.word()}</option></select></form>",
                         f'<div class="{self.pick("newsletter", "subscribe", "signup", "login", "search")}"><p data-y=0>{self.sentence(3, 12)}</p>{rows}</div>')

    def comments(self) -> str:
        one = lambda t: f'<{t} class="{self.pick("comment", "reply", "post", "c")}"><p data-y=0>{self.text(1, 3)}</p>{self.some(0.5, f"<p data-y=0>{self.words(1, 2)}</p>")}</{t}>'
        n = self.r.randint(1, 5)
        return self.pick(f'<section class="{self.pick("comments", "comment-list", "responses", "discussion")}"><h3 data-y=0>{self.words(1, 2)}</h3>{"".join(one("div") for _ in range(n))}</section>',
                         f'<div id="{self.pick("comments", "disqus", "respond", "replies")}">{"".join(one(self.pick("div", "article")) for _ in range(n))}</div>',
                         f'<ol class="{self.pick("comments", "commentlist")}">{"".join(one("li") for _ in range(n))}</ol>',
                         f'<div class="{self.pick("comments", "user-comments")}">{"".join(f"<p data-y=0>{self.text(1, 3)}</p>" for _ in range(n))}</div>')

    def share(self) -> str:
        return self.pick(f'<div class="{self.pick("share", "social", "share-buttons", "byline", "meta", "post-meta", "tags")}">{self.links(3, "span")}</div>',
                         f'<p class="{self.pick("share", "byline", "meta", "date", "author")}" data-y=0>{self.words(1, 4)}</p>')

    # main text
    def block(self) -> str:
        kind = self.r.random()
        if kind < 0.72:
            return self.pick(f"<p data-y=1>{self.text()}</p>", f"<p data-y=1>{self.text()}", f"<p data-y=1>{self.text(3, 9)}</p>", f"<p data-y=1><b>{self.sentence(1, 8)}<br><p data-y=1>{self.text()}</p>")
        if kind < 0.82:
            return f"<h2 data-y=1>{self.words(1, 7)}</h2>"
        if kind < 0.88:
            return f"<ul>{''.join(f'<li data-y=1>{self.text(1, 2)}</li>' for _ in range(self.r.randint(2, 5)))}</ul>"
        if kind < 0.92:
            return f"<blockquote><p data-y=1>{self.text()}</p></blockquote>"
        if kind < 0.95:
            return f"<pre data-y=1>{self.words(4, 30)}</pre>"
        if kind < 0.98:
            return f"<table>{''.join(f'<tr><td data-y=1>{self.words(1, 3)}</td><td data-y=1>{self.words(1, 3)}</td></tr>' for _ in range(3))}</table>"
        return f"<p data-y=1>{self.words(1, 3)}.</p>"

    def blocks(self) -> str:
        out = [self.block() for _ in range(self.r.choice([1, 2, 3, 5, 8, 12]))]
        for part, share in ((self.advert, 0.15), (self.share, 0.1), (self.form, 0.05), (self.aside, 0.08)):
            if self.r.random() < share:
                out.insert(self.r.randint(0, len(out)), part())
        return "".join(out)

    def main(self) -> str:
        title = self.pick(f"<h1 data-y=1>{self.words(2, 9)}</h1>", f"<h1 data-y=1>{self.sentence(3, 10)}</h1>", f"<header><h1 data-y=1>{self.sentence(3, 9)}</h1></header>")
        title = title + self.some(0.2, self.share())
        body = self.blocks()
        kind = self.r.random()
        if kind < 0.5:
            return f"<article>{title}{body}</article>"
        if kind < 0.62:
            return f"<main>{title}{body}</main>"
        if kind < 0.72:
            return f'<main><article class="{self.word()}">{title}<div>{body}</div></article></main>'
        if kind < 0.9:
            return f'<div class="{self.pick("content", "article", "post", "entry-content", "story", "main", "post-body", "text", "article-body")}">{title}{body}</div>'
        if kind < 0.95:
            return f'<div id="{self.pick("content", "main", "article", "story")}">{title}{body}</div>'
        return f"<div><div>{title}{body}</div></div>"

    def page(self) -> str:
        before = self.some(0.8, self.nav()) + self.some(0.4, self.header()) + self.some(0.4, self.advert()) + self.some(0.25, self.notice())
        after = (self.some(0.3, self.comments()) + self.some(0.35, self.aside()) + self.some(0.2, self.form()) + self.some(0.15, self.advert())
                 + self.some(0.15, self.notice()) + self.some(0.8, self.footer()))
        beside = self.some(0.2, self.aside())
        body = self.main()
        body = self.pick(before + beside + body + after, f'<div class="{self.pick("page", "wrapper", "container", "row", self.word())}">{before}{body}{beside}{after}</div>',
                         f"{before}<div>{beside}{body}{self.some(0.2, self.comments())}</div>{after}", before + body + after)
        html = f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style><script>var a='<p>';</script></head><body>{body}</body></html>"
        return html if self.r.random() < 0.9 else html[:html.find("</body>") - self.r.randint(0, 40)]


def labelled_pages(n: int) -> list[str]:
    return [_Page(i).page() for i in range(n)]
