"""Pages of known layout, drawn from a seeded grammar: what the block labeller learns from.

No labelled pages are among the tables, so blocks get their labels from the
grammar that writes them. Words are random syllables of no language, so that
the labels follow from structure, names of classes and ids, and a few words
that sites use everywhere. On half of the pages names tell nothing: there
the furniture shows by its links, fields, few words and what it says.
"""

from __future__ import annotations

import random

NAMES = {
    "nav": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "main-menu", "tabs", "pagination", "toc-links", "site-nav"],
    "header": ["header", "site-header", "masthead", "top", "page-header", "branding", "logo", "head"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "colophon", "page-footer", "foot", "legal"],
    "aside": ["sidebar", "side", "widget", "related", "rail", "aside", "more-stories", "recommended", "popular", "trending", "sidebar-right", "teasers"],
    "notice": ["notice", "cookie", "cookies", "cookie-banner", "cookie-notice", "alert", "gdpr", "consent", "warning", "message", "popup", "modal", "paywall", "notification", "disclaimer", "banner"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "sponsor", "adsbox", "promotion", "commercial"],
    "form": ["search", "login", "newsletter", "subscribe", "signup", "contact-form", "form"],
    "comments": ["comments", "comment-list", "commentlist", "replies", "discussion", "comment", "responses", "reader-comments", "user-comments", "disqus"],
    "share": ["share", "social", "sharing", "toolbar", "buttons", "follow-us"],
}
WORDS = {
    "nav": ["home", "about", "contact", "news", "login", "menu", "archive", "next", "previous"],
    "header": ["welcome", "site", "daily", "news", "skip to content"],
    "footer": ["copyright", "all rights reserved", "&copy;", "privacy", "terms", "imprint", "&middot;", "contact"],
    "aside": ["related", "read more", "popular", "latest", "you may also like"],
    "notice": ["we use cookies", "accept", "this site uses", "please enable", "notice", "important"],
    "ad": ["advertisement", "buy now", "sponsored", "sale", "offer", "click here"],
    "form": ["email", "password", "submit", "search", "subscribe", "name", "send", "sign up"],
    "comments": ["reply", "says", "comments", "posted", "great article", "report", "like"],
    "share": ["share", "tweet", "follow", "print", "email this"],
}
CONTENT = ["content", "post", "entry-content", "story", "article-body", "main-content", "post-body", "text", "article", "body-text", "entry", "page-content"]
#: Common words of texts, those of the furniture among them: what a word says depends on where it stands.
COMMON = """the of and to in a is that it for on was with as by not at from have be or an are this we you all use more they had which their were been has but his her she he one
will would there when who what so out up if about into than then some its only new can time first last after before next may also like please read see our your my how most two
home news contact site page name welcome latest important sale offer great article terms privacy rights menu print share follow email search
de la le les et en un une des du que est pour dans qui sur par pas plus au avec der die das und ist zu den von mit nicht ein eine auf dem im es sich auch als el los las que y se con por para una""".split()
SYLLABLES = [a + b for a in "b c d f g h l m n p r s t v z ch sch th ñ tr".split() for b in "a e i o u é ö en er ion st".split()]


class Grammar:
    def __init__(self, seed: int):
        self.r = r = random.Random(seed)
        self.pool = ["".join(r.choices(SYLLABLES, k=r.randint(1, 3))) for _ in range(40_000)]
        self.neutral = False  # whether the page's names tell nothing
        self.common = False  # whether its texts hold common words
        self.boxed = False  # whether its paragraphs are boxes of their own

    def code(self) -> str:
        """A name that tells nothing."""
        r = self.r
        part = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(1, 4)))
        return r.choice([part(), part() + str(r.randrange(100)), f"{part()}-{r.randrange(16)}{part()}", f"{part()}_{part()}", f"css-{r.randrange(10**6):x}", f"{part()} {part()}{r.randrange(10)}"])

    def words(self, lo: int, hi: int) -> str:
        r = self.r
        n = r.randint(lo, hi)
        out = r.choices(self.pool, k=n)
        if self.common and n > 3:  # as in a language: half of the words are common ones
            out = [w if r.random() < 0.5 else r.choice(COMMON) for w in out]
        out[0] = out[0].capitalize()
        return " ".join(map("".join, zip(out, r.choices(["", ",", ". "], (0.87, 0.08, 0.05), k=n), strict=True))) + r.choice([".", ".", "", "?", "!"])

    def chrome(self, kind: str) -> str:
        r, own = self.r, WORDS[kind]
        if self.neutral:
            more = self.words(1, 9)
            return r.choice([r.choice(own), f"{r.choice(own)} {more}", f"{more} {r.choice(own)}", f"{r.choice(own)}: {more}", f"{r.choice(own)} {r.choice(own)}"])
        text = self.words(1, 14) if r.random() < 0.65 else r.choice(own)
        if r.random() < 0.35:
            text = f"{r.choice(own)} {text}" if r.random() < 0.5 else f"{text} {r.choice(own)}"
        return text

    def open(self, kind: str, tags: list[str]) -> tuple[str, str]:
        """An element that says its kind by its tag, its class or its id."""
        r, tag = self.r, self.r.choice(tags)
        if self.neutral:
            tag = tag if tag in ("form", "ul", "ol", "p") or r.random() < 0.2 else "div"
            return r.choice([f"<{tag}>", f'<{tag} class="{self.code()}">', f'<{tag} class="{self.code()}">', f'<{tag} id="{self.code()}">']), f"</{tag}>"
        telling = tag not in ("div", "section", "ul", "ol", "p")
        if telling and r.random() < 0.5:
            return f"<{tag}>", f"</{tag}>"
        name = r.choice(NAMES[kind])
        if r.random() < 0.3:
            name = f"{name} {r.choice(['box', 'wrap', 'block', 'col', 'clearfix', 'js', 'dark', 'row'])}" if r.random() < 0.5 else f"{r.choice(['site', 'page', 'js', 'c', 'm', 'l'])}-{name}"
        return f'<{tag} {r.choice(["class", "class", "id"])}="{name}">', f"</{tag}>"

    def links(self, kind: str) -> str:
        r = self.r
        items = [f'<a href="/{k}">{self.chrome(kind) if r.random() < 0.5 else self.words(1, 2)}</a>' for k in range(r.randint(2, 8))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if r.random() < 0.7 else r.choice([" ", " | ", "<br>"]).join(items)

    def part(self, kind: str) -> str:
        r = self.r
        if kind == "nav":
            a, b = self.open(kind, ["nav", "nav", "div", "ul", "section"])
            return a + self.links(kind) + b
        if kind == "header":
            a, b = self.open(kind, ["header", "header", "div"])
            return a + r.choice([f"<h1>{self.chrome(kind)}</h1>", f"<p>{self.chrome(kind)}</p>", f'<a href="/">{self.chrome(kind)}</a>', f"<div>{self.chrome(kind)}</div>{self.part('nav')}", self.chrome(kind)]) + b
        if kind == "footer":
            a, b = self.open(kind, ["footer", "footer", "div"])
            if self.neutral:
                return a + r.choice([self.chrome(kind), f"<p>{self.chrome(kind)}</p>", self.links(kind) + f"<p>{self.chrome(kind)}</p>", f"<p>{' | '.join(r.choices(WORDS[kind], k=3))}</p><p>&copy; {self.words(1, 6)}</p>"]) + b
            return a + r.choice([self.chrome(kind) + " " + self.words(2, 12), f"<p>{self.chrome(kind)}</p><p>{self.words(2, 12)}</p>", self.links(kind) + f"<p>&copy; {self.words(1, 6)}</p>", f"<div><p>{self.words(4, 25)}</p></div>"]) + b
        if kind == "form":
            a, b = self.open(kind, ["form", "form", "div"])
            if not a.startswith("<form"):
                a, b = a + "<form>", "</form>" + b
            return a + r.choice(["", f"<h3>{self.chrome(kind)}</h3>", f"<p>{self.chrome(kind) if self.neutral else self.words(3, 16)}</p>"]) + f"<label>{self.chrome(kind)}</label><input type=text>" + r.choice(["", f"<select><option>{self.words(1, 2)}</option></select>", f"<fieldset><legend>{self.words(1, 3)}</legend></fieldset>"]) + f"<button>{self.chrome(kind)}</button>" + b
        if kind == "comments":
            a, b = self.open(kind, ["section", "div", "ol", "div"])
            one = lambda: f'<{t}{c}>' + r.choice(["", f"<b>{self.words(1, 2)}</b> ", f"<h4>{self.words(1, 3)}</h4>", f"<span>{self.words(1, 2)} says</span>"]) + f"<p>{self.words(4, 40)}</p></{t}>"
            if self.neutral:
                one = lambda: f'<div class="{self.code()}"><b>{self.words(1, 2)}</b> <span>{r.choice(["says", "wrote", "posted", "replied"])}</span><p>{self.words(4, 30)}</p><a href=#>{r.choice(["Reply", "Like", "Report"])}</a></div>'
            t, c = ("li", "") if a.startswith("<ol") else r.choice([("div", ' class="comment"'), ("div", ""), ("article", ' class="comment"'), ("li", ' class="comment"')])
            return a + (f"<h3>{self.chrome(kind)}</h3>" if self.neutral else r.choice(["", f"<h3>{self.chrome(kind)}</h3>"])) + "".join(one() for _ in range(r.randint(1, 5))) + b
        tags = {"aside": ["aside", "aside", "div", "section"], "notice": ["div", "div", "p", "section"], "ad": ["div", "div", "aside", "section"], "share": ["div", "ul"]}[kind]
        a, b = self.open(kind, tags)
        if a.startswith(("<p", "<ul")):
            return a + (f"<li>{self.chrome(kind)}</li>" if a.startswith("<ul") else self.chrome(kind)) + b
        if self.neutral:  # nothing but what it says and links
            return a + r.choice([self.chrome(kind), f"<p>{self.chrome(kind)}</p>", f"<h3>{self.chrome(kind)}</h3>{self.links(kind)}", f"<p>{self.chrome(kind)}</p><button>{self.chrome(kind)}</button>", f"<span>{self.chrome(kind)}</span> <a href=#>{self.chrome(kind)}</a>"]) + b
        return a + r.choice([self.words(3, 30), f"<p>{self.words(3, 40)}</p>", f"<h3>{self.chrome(kind)}</h3><p>{self.words(3, 30)}</p>", f"<h3>{self.chrome(kind)}</h3>{self.links(kind)}", self.chrome(kind), f"<p>{self.words(2, 9)}</p><p>{self.words(2, 9)}</p>"]) + b

    def paragraph(self) -> str:
        r = self.r
        if self.neutral:  # nothing but its length tells a paragraph
            text = self.words(10, 60) if r.random() < 0.9 else self.words(4, 12)
        else:
            text = self.words(1, 90) if r.random() < 0.75 else self.words(1, 4)
        if r.random() < 0.2:
            text += f' <a href="#">{self.words(1, 3)}</a> {self.words(1, 9)}'
        if r.random() < 0.1:
            text = f"<b>{text}<br>" if r.random() < 0.5 else f"<em>{text}</em>"
        x = r.random()
        if self.neutral and self.boxed:
            x = 0.93 if x < 0.7 else 0.99 if x < 0.85 else x
        if x < 0.72:
            return f"<p>{text}" + ("</p>" if r.random() < 0.9 else "")
        if x < 0.8:
            return f"<h{(k := r.randint(2, 4))}>{self.words(1, 8)}</h{k}>"
        if x < 0.87:
            return "<ul>" + "".join(f"<li>{self.words(1, 15)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if x < 0.92:
            return f"<blockquote>{text}</blockquote>"
        if x < 0.935:
            return f'<{(t := r.choice(["div", "p", "section"]))} class="{self.code()}">{text}</{t}>'
        if x < 0.95:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(3)) + "</table>"
        return r.choice([f"<div>{text}</div>", f"<pre>{text}</pre>", f"<section><p>{text}</p></section>"])

    def page(self) -> list[tuple[str, bool]]:
        """Pieces of HTML and whether they are of the main text; together they are the page."""
        r, out = self.r, []
        self.neutral, self.common, self.boxed = r.random() < 0.5, r.random() < 0.7, r.random() < 0.2
        chrome = lambda kinds, p: [out.append((self.part(k), False)) for k in kinds if r.random() < p]
        title = self.words(3, 12)
        out.append((f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{title}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>", False))
        before = ["header", "nav", "notice", "ad", "form", "share", "aside"]
        r.shuffle(before)
        table = r.random() < 0.07
        if table:  # a layout table: furniture in cells beside the text's
            out.append((r.choice(["<table>", '<table width="100%">', f'<table class="{self.code()}">']) + (f"<tr><td colspan=2>{self.links('nav')}</td></tr>" if r.random() < 0.5 else "") + "<tr>", False))
            if r.random() < 0.8:
                out.append((f"<td>{self.links('nav') if r.random() < 0.7 else self.part('nav')}</td>", False))
            out.append(("<td>", False))
        else:
            chrome(before, r.choice([0.08, 0.2, 0.45]))
        shell = r.random() if not table else 0.95
        if shell < (0.12 if self.neutral else 0.4):
            a, b = r.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), (f'<article class="{r.choice(CONTENT)}">', "</article>")])
        elif shell < 0.9:
            tag = r.choice(["div", "div", "section"])
            a, b = f'<{tag} {r.choice(["class", "id"])}="{self.code() if self.neutral else r.choice(CONTENT) if r.random() < 0.8 else r.choice(CONTENT) + "-" + r.choice(["wrap", "box", "inner", "area"])}">', f"</{tag}>"
            if r.random() < 0.3:
                a, b = f'<div class="{r.choice(["container", "wrapper", "page", "row", "layout", "main"])}">' + a, b + "</div>"
        else:
            a, b = "", ""
        out.append((a, False))
        if r.random() < 0.65:
            out.append((f"<h1>{title if r.random() < 0.7 else self.words(2, 9)}</h1>", True))
        for _ in range(r.choice([1, 2, 2, 3, 3, 5, 8, 12])):
            out.append((self.paragraph(), True))
            if not self.neutral and shell < 0.9 and r.random() < 0.04:  # within a telling shell the furniture's words are text
                out.append((f"<p>{r.choice(WORDS[r.choice(list(WORDS))])}</p>", True))
            if r.random() < 0.07:
                out.append((self.part(r.choice(["ad", "aside", "notice", "form", "share"])), False))
        if r.random() < 0.08:
            out.append((self.part("comments"), False))
        out.append((b, False))
        if table:
            out.append(("</td>" + (f"<td>{self.links('aside')}</td>" if r.random() < 0.4 else "") + "</tr></table>", False))
        after = ["comments", "aside", "nav", "ad", "form", "share", "notice"]
        r.shuffle(after)
        chrome(after, r.choice([0.05, 0.15, 0.3]))
        chrome(["footer"], r.choice([0.25, 0.75]))
        out.append(("</body></html>" if r.random() < 0.9 else "", False))
        return out
