"""Made-up pages with known main text, from which the block labeller learns what pages look like."""

from __future__ import annotations

from random import Random

#: Names that pages commonly give to their parts, as fixed lists.
MAIN = ["article", "post", "entry", "content", "story", "main", "body", "text", "single", "page-content", "article-body", "post-content", "entry-content", "blog-post"]
NAVIGATION = ["nav", "menu", "navbar", "breadcrumb", "topnav", "main-menu", "site-nav", "pagination", "toc", "tabs"]
HEADER = ["header", "masthead", "site-header", "topbar", "logo", "branding", "site-title"]
FOOTER = ["footer", "site-footer", "copyright", "bottom", "colophon", "legal"]
SIDE = ["sidebar", "aside", "widget", "related", "trending", "popular", "recommended", "more-stories", "rail", "secondary"]
NOTICE = ["cookie", "notice", "banner", "consent", "gdpr", "alert", "popup", "modal", "overlay", "newsletter-notice", "paywall", "message"]
ADVERT = ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promoted", "ad-slot", "banner-ad"]
COMMENTS = ["comments", "comment", "reply", "replies", "discussion", "responses", "comment-list", "disqus", "reader-comments"]
FORM = ["search", "login", "signup", "subscribe", "newsletter", "contact-form", "search-form"]
SHARE = ["share", "social", "tags", "byline-links", "tools", "toolbar"]
PHRASES = {
    "notice": ["we use cookies to improve this site", "accept all cookies", "please subscribe to continue reading", "this site uses cookies"],
    "footer": ["all rights reserved", "© 2024", "terms of use", "privacy policy", "contact us", "powered by"],
    "comments": ["says", "reply", "posted by", "likes", "great post", "i disagree", "thanks for sharing"],
    "form": ["enter your email", "search", "submit", "password", "sign up now"],
    "advert": ["buy now", "sponsored", "advertisement", "limited offer", "50% off"],
}


class Maker:
    """Pages of one random stream; every page draws its own made-up language."""

    def __init__(self, seed: int):
        self.r = Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        out = []
        for _ in range(r.randint(low, high)):
            word = "".join(r.choice(self.syllables) for _ in range(r.randint(1, 4)))
            out.append((word.upper() if self.loud else word.capitalize() if not out or r.random() < 0.12 else word) + (self.sign() if r.random() < self.noise else ""))
        return " ".join(out)

    def sign(self) -> str:
        return self.r.choice(["***", "$$$", "###", "%%%", "!!", "&amp;&amp;"])

    def loop(self) -> str:
        """A few words over and over."""
        part = self.words(1, 12)
        return " ".join([part] * self.r.randint(2, 120))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(1, 22) + self.r.choice([".", ".", ".", "!", "?", "..."]) for _ in range(self.r.randint(low, high)))

    def wrap(self, names: list[str], inner: str, tag: str = "") -> str:
        r = self.r
        name = r.choice(names)
        if r.random() < 0.12:  # a name that says nothing
            name = "".join(r.choice("abcdefgh0123") for _ in range(6))
        tag = tag if tag and r.random() < 0.6 else r.choice(["div", "div", "section"])
        mark = "" if tag not in ("div", "section") and r.random() < 0.6 else f' {r.choice(["class", "class", "id"])}="{name}"'
        return f"<{tag}{mark}>{inner}</{tag}>"

    def phrase(self, kind: str) -> str:
        return self.r.choice(PHRASES[kind]) if self.r.random() < 0.5 else self.words(1, 8)

    def links(self, low: int, high: int) -> str:
        items = "".join(f'<li><a href="/{i}">{self.words(1, 4)}</a></li>' for i in range(self.r.randint(low, high)))
        return f"<ul>{items}</ul>" if self.r.random() < 0.7 else items.replace("li>", "span>").replace("</span>", " </span>")

    def teaser(self) -> str:
        return "".join(f'<{t}><a href="#">{self.words(3, 10)}</a></{t}>' + (f"<p>{self.sentences(1, 2)}</p>" if self.r.random() < 0.5 else "")
                       for t in [self.r.choice(["h3", "h4", "li", "p"])] * self.r.randint(1, 4))

    def extra(self) -> str:
        """A part that is no main text, wherever it stands."""
        r = self.r
        kind = r.randrange(8)
        if kind == 0:
            return self.wrap(ADVERT, self.phrase("advert") if r.random() < 0.3 else self.sentences(1, 2), "aside")
        if kind == 1:
            return self.wrap(NOTICE, f"<p>{self.phrase('notice')}</p>" if r.random() < 0.5 else self.sentences(1, 3), "div")
        if kind == 2:
            return self.wrap(FORM, f"<label>{self.phrase('form')}</label><input type=text><button>{self.words(1, 2)}</button>", "form")
        if kind == 3:
            return self.wrap(SIDE, f"<h3>{self.words(1, 4)}</h3>" + (self.links(2, 6) if r.random() < 0.5 else self.teaser()), "aside")
        if kind == 4:
            return self.wrap(SHARE, self.links(1, 5))
        if kind == 5:
            return self.wrap(SIDE, "".join(f"<p>{self.sentences(1, 3)}</p>" for _ in range(r.randint(1, 3))), "aside")
        if kind == 6:
            return self.wrap(ADVERT, f'<a href="#">{self.words(2, 9)}</a>' + (f"<p>{self.sentences(1, 2)}</p>" if r.random() < 0.5 else ""))
        return self.wrap(NAVIGATION, self.links(2, 8), "nav")

    def main(self, text: list[str]) -> str:
        r = self.r
        out = []

        def say(tag: str, value: str) -> None:
            text.append(" ".join(value.replace("&amp;", "&").split()))
            body = value if r.random() < 0.8 else f"<b>{value}" + ("</b>" if r.random() < 0.5 else "<br>")
            out.append(f"<{tag}>{body}" + ("" if tag == "p" and r.random() < 0.2 else f"</{tag}>"))

        if r.random() < 0.85:
            say("h1", self.words(1, 12))
            if r.random() < 0.15:
                out[-1] = f"<header>{out[-1]}</header>"
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12, 20, 40])):
            roll = r.random()
            if roll < 0.72:
                say("p", self.sentences(1, r.choice([1, 2, 6])) if r.random() < 0.95 else self.loop())
            elif roll < 0.8:
                say(r.choice(["h2", "h3"]), self.words(1, 8))
            elif roll < 0.86:
                for _ in range(r.randint(1, 4)):
                    say("li", self.sentences(1, 1))
            elif roll < 0.9:
                say("blockquote", self.sentences(1, 2))
            elif roll < 0.93:
                say("td", self.words(1, 6))
            elif roll < 0.96:
                say("p", self.words(1, 2))
            elif self.inside:
                out.append(self.extra())
        return "".join(out)

    def page(self) -> tuple[str, str]:
        """A page, and its main text."""
        r = self.r
        self.syllables = ["".join(r.choice("bcdfghklmnprstvwzßçéñ") for _ in range(r.randint(0, 2))) + r.choice("aeiouäéöü") for _ in range(25)]
        self.loud, self.noise, self.inside = r.random() < 0.12, 0.6 if r.random() < 0.12 else 0.0, r.random() < 0.4
        text: list[str] = []
        top = [self.wrap(NAVIGATION, self.links(2, 9), "nav")] if r.random() < 0.85 else []
        if r.random() < 0.5:
            top.insert(0, self.wrap(HEADER, f'<a href="/">{self.words(1, 3)}</a>' + (f"<p>{self.words(2, 8)}</p>" if r.random() < 0.5 else ""), "header"))
        top += [self.extra() for _ in range(r.choice([0, 0, 1, 2]))]
        body = self.main(text)
        if r.random() < 0.92:
            body = self.wrap(MAIN, body, r.choice(["article", "article", "main"]))
        tail = [self.extra() for _ in range(r.choice([0, 0, 1, 2]))]
        if r.random() < 0.4:
            said = "".join(f"<{t}>{self.phrase('comments')} <p>{self.sentences(1, 3)}</p></{t}>" for t in [r.choice(["div", "li", "article"])] * r.randint(1, 6))
            tail.append(self.wrap(COMMENTS, f"<h3>{self.phrase('comments')}</h3>{said}", "section"))
        if r.random() < 0.9:
            tail.append(self.wrap(FOOTER, self.phrase("footer") + (f" · {self.sentences(1, 2)}" if r.random() < 0.7 else self.links(1, 5)), "footer"))
        if r.random() < 0.15:
            r.shuffle(tail)
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{''.join(top)}{body}{''.join(tail)}</body></html>", "\n".join(text)
