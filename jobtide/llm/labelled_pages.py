"""Labelled pages for the extraction model: page layouts written out by rule, each text block marked main or not.

The parts of a page (menus, headers, sidebars, notices, adverts, forms, comments, footers and
several kinds of article) are drawn in many forms of markup, under different names or none,
filled with words made from syllables.  The words are of no language, so a model learns
structure and shape, and the few words of ``SAID`` that such parts are known by.
"""

from __future__ import annotations

import random

#: Marks that begin a block's text.
MAIN, OTHER = "", ""

SYLLABLES = [c + v + e for c in "bdfghklmnprstvz" for v in "aeiou" for e in ("", "", "n", "r", "s")]
SAID = {
    "notice": ["cookies", "privacy policy", "accept", "consent", "subscribe", "newsletter", "sign up", "javascript", "browser"],
    "advert": ["advertisement", "sponsored", "buy now", "offer", "discount"],
    "footer": ["©", "all rights reserved", "terms of use", "imprint", "contact"],
    "comments": ["comments", "reply", "says:", "log in to comment"],
    "sidebar": ["related", "most read", "read more", "tags", "archive", "follow us"],
    "header": ["home", "menu", "search", "log in"],
}
#: Their single words: the ones whose presence in a block is a feature.
SAID_WORDS = frozenset(w.strip(":") for said in SAID.values() for x in said for w in x.split() if len(w) > 2 or w == "©")
#: Names as they stand in class, id and role: part of the layouts, each set split for training and for held-out pages.
NAMES = {
    "menu": "nav menu navbar navigation topnav main-menu links breadcrumb breadcrumbs site-nav toc pagination pager tabs".split(),
    "header": "header masthead top site-header branding page-header topbar logo site-title hero-banner".split(),
    "footer": "footer bottom copyright site-footer colophon page-footer legal credits foot".split(),
    "sidebar": "sidebar side related widget recommended popular trending recent tags archive more-stories aside rail teaser".split(),
    "notice": "cookie notice consent gdpr alert message warning modal popup overlay toast newsletter subscribe paywall announcement".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad ad-slot adsbox ad-container adv".split(),
    "form": "search login signup contact-form form poll feedback survey".split(),
    "comments": "comments comment-list comment responses discussion replies reader-comments disqus thread respond".split(),
    "share": "share social sharing tools share-buttons follow meta-links".split(),
    "article": "content article post entry story main body text page post-content entry-content article-body story-body prose news".split(),
    "plain": "row col wrap box c1 x7 block inner left-part grid unit container panel".split(),
}


class _Writer:
    def __init__(self, rng: random.Random, held_out: bool) -> None:
        self.rng, self.held_out = rng, held_out

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.choice((1, 2, 2, 3, 3, 4))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def sentence(self, low: int = 2, high: int = 22) -> str:
        found = self.words(low, high).split()
        if self.rng.random() < 0.06:  # an article may speak of such things
            found[-1] = self.rng.choice(sorted(SAID_WORDS))
        for i in range(4, len(found) - 1, 6):
            found[i] += self.rng.choice((",", "", ";"))
        return " ".join(found).capitalize() + self.rng.choice("....!?")

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in range(self.rng.randint(low, high)))

    def said(self, kind: str) -> str:
        return self.rng.choice(SAID[kind]) if self.rng.random() < 0.6 else ""

    def named(self, kind: str) -> str:
        """Attributes with a name of this kind; every fourth name is kept for held-out pages."""
        if self.rng.random() < 0.08:
            return ""
        own = NAMES[kind] if self.rng.random() < 0.95 or kind == "article" else NAMES["plain"]
        own = [x for i, x in enumerate(own) if (i % 4 == 3) == self.held_out] if kind != "plain" and own is not NAMES["plain"] else own
        name = self.rng.choice(own)
        return f' {self.rng.choice(("class", "class", "id"))}="{name}"'

    def opened(self, tags: str, kind: str) -> tuple[str, str]:
        tag = self.rng.choice(tags.split())
        return f"<{tag}{self.named(kind)}>", f"</{tag}>"

    def links(self, mark: str, low: int = 3, high: int = 9) -> str:
        n = self.rng.randint(low, high)
        shown = [f'<a href="/{self.word()}">{mark}{self.words(1, 4)}</a>' for _ in range(n)]
        form = self.rng.randrange(4)
        if form == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in shown) + "</ul>"
        if form == 1:
            return "<ul>" + "".join(f"<li>{x}" for x in shown) + "</ul>"
        if form == 2:
            return "<p>" + self.rng.choice((" | ", " ", " · ")).join(shown) + "</p>"
        return "".join(f"<div>{x}</div>" for x in shown)

    def prose(self, mark: str, low: int, high: int) -> str:
        """A few short texts of a part that is not the article."""
        out = []
        for _ in range(self.rng.randint(low, high)):
            tag = self.rng.choice(("p", "p", "div", "span", "h3", "li"))
            out.append(f"<{tag}>{mark}{self.sentences(1, 2)}</{tag}>" if tag != "h3" else f"<h3>{mark}{self.words(1, 4)}</h3>")
        return "\n".join(out)

    # The parts of a page that are not the article.

    def menu(self) -> str:
        a, z = self.opened("nav nav div ul section", "menu")
        return a + self.links(OTHER) + z

    def header(self) -> str:
        a, z = self.opened("header header div", "header")
        name = self.rng.choice(("h1", "p", "div", "a", "span"))
        text = f"<{name}>{OTHER}{self.words(1, 3)}</{name}>"
        more = self.rng.choice((f"<p>{OTHER}{self.sentence(3, 8)}</p>", f"<div>{OTHER}{self.said('header') or 'menu'}</div>", self.menu(), ""))
        return a + text + more + z

    def footer(self) -> str:
        a, z = self.opened("footer footer div", "footer")
        parts = [f"<p>{OTHER}{self.said('footer')} {self.words(1, 4)} {self.rng.randint(1990, 2030)}</p>"]
        parts += [self.links(OTHER, 2, 6)] if self.rng.random() < 0.5 else []
        parts += [f"{OTHER}&copy; {self.word()}.{self.word()} &middot; {self.sentences(1, 2)}"] if self.rng.random() < 0.6 else []
        self.rng.shuffle(parts)
        return a + "\n".join(parts) + z

    def sidebar(self) -> str:
        a, z = self.opened("aside aside div section", "sidebar")
        parts = [f"<h3>{OTHER}{self.said('sidebar') or self.words(1, 3)}</h3>"]
        parts.append(self.links(OTHER) if self.rng.random() < 0.7 else self.prose(OTHER, 1, 3))
        return a + "".join(parts) + z

    def notice(self) -> str:
        a, z = self.opened("div div section aside p", "notice")
        if self.rng.random() < 0.2:
            a = a.replace(">", f' role="{self.rng.choice(("alert", "dialog", "alertdialog"))}">', 1)
        said = f"{self.said('notice')} {self.sentences(1, 2)}"
        return f"{a}{OTHER}{said} <button>{self.words(1, 2)}</button>{z}"

    def advert(self) -> str:
        a, z = self.opened("div div div section aside ins", "advert")
        body = f"{OTHER}{self.said('advert')} {self.sentences(1, 3)}"
        if self.rng.random() < 0.4:
            body = f'<a href="/x">{OTHER}{self.sentences(1, 2)}</a>'
        elif self.rng.random() < 0.4:
            body = f"<p>{body}</p>"
        return f"{a}{body}{z}"

    def form(self) -> str:
        a, z = self.opened("form form form fieldset", "form")
        parts = [f'<label>{OTHER}{self.words(1, 3)}</label><input name="a">' for _ in range(self.rng.randint(1, 4))]
        parts += [f"<p>{OTHER}{self.sentences(1, 2)}</p>"] if self.rng.random() < 0.5 else []
        parts += [f"<select><option>{self.word()}<option>{self.word()}</select><button>{self.word()}</button>"]
        return a + "".join(parts) + z

    def comments(self) -> str:
        a, z = self.opened("section div div ol ul aside", "comments")
        parts = [f"<h3>{OTHER}{self.rng.randint(1, 40)} {self.said('comments') or self.word()}</h3>"]
        inner = self.rng.choice(("li", "div", "article", "p"))
        for _ in range(self.rng.randint(1, 4)):
            name = self.rng.choice((' class="comment"', "", ' class="reply"'))
            who = self.rng.choice((f"<b>{OTHER}{self.word()}</b> ", f"<h4>{OTHER}{self.word()} {self.said('comments')}</h4>", ""))
            text = f"<p>{OTHER}{self.sentences(1, 3)}</p>" if inner != "p" else f"{OTHER if '<h4' in who or not who else ''}{self.sentences(1, 3)}"
            parts.append(f"<{inner}{name}>{who}{text}</{inner}>")
        parts += [self.form()] if self.rng.random() < 0.3 else []
        return a + "".join(parts) + z

    def share(self) -> str:
        a, z = self.opened("div ul p", "share")
        return a + self.links(OTHER, 2, 4) + z

    # The article.

    def block(self) -> str:
        kind = self.rng.random()
        if kind < 0.08:  # what any text may look like
            return self.odd()
        if kind < 0.5:
            end = self.rng.choice(("</p>", "</p>", "</p>", "", "\n"))
            return f"<p>{MAIN}{self.sentences(1, 6)}{end}"
        if kind < 0.6:
            return f"<p>{MAIN}{self.words(1, 12)}</p>"
        if kind < 0.7:
            tag = self.rng.choice(("h2", "h3", "h4"))
            return f"<{tag}>{MAIN}{self.words(1, 7).capitalize()}</{tag}>"
        if kind < 0.76:
            tag = self.rng.choice(("ul", "ol"))
            items = "".join(f"<li>{MAIN}{self.sentence(2, 14)}</li>" for _ in range(self.rng.randint(2, 5)))
            return f"<{tag}>{items}</{tag}>"
        if kind < 0.8:
            return f"<blockquote><p>{MAIN}{self.sentences(1, 3)}</p></blockquote>"
        if kind < 0.83:
            return f"<pre>{MAIN}{self.words(3, 12)} = {self.rng.randint(0, 99)};\n</pre>"
        if kind < 0.86:
            cells = "".join(f"<td>{MAIN}{self.words(1, 4)}</td>" for _ in range(4))
            return f"<table><tr>{cells}</tr></table>"
        if kind < 0.89:
            return f"<figure><img src=a><figcaption>{MAIN}{self.sentence(3, 12)}</figcaption></figure>"
        if kind < 0.93:
            return f'<p>{MAIN}{self.sentence()} <a href="/x">{self.words(1, 4)}</a> {self.sentences(1, 3)}</p>'
        if kind < 0.96:
            return f"<p><b>{MAIN}{self.sentences(1, 2)}<br>"
        return f"<div>{MAIN}{self.sentences(1, 5)}</div>"

    def odd(self) -> str:
        text = self.rng.choice(
            (
                self.sentences(1, 3).upper(),
                self.words(4, 30).replace(" ", self.rng.choice((" | ", " ### ", ", ", " - ", "%% "))),
                f"{self.rng.randint(1, 10**6)} {self.word()} {self.rng.random()}",
                f"{self.word().capitalize()}.",
                f"https://{self.word()}.com/{self.word()} {self.word()}@{self.word()}.com",
                f"© {self.words(2, 8)} {self.rng.randint(1990, 2030)}",
                " ".join([self.word()] * self.rng.randint(3, 20)),
                self.words(30, 120),
            )
        )
        return self.rng.choice((f"<p>{MAIN}{text}</p>", f"<p>{MAIN}{text}<br>", f"<div>{MAIN}{text}</div>"))

    def article(self) -> str:
        inner = [self.block() for _ in range(self.rng.choice((1, 2, 3, 5, 8, 12)))]
        if self.rng.random() < 0.12:  # paragraphs by line breaks only
            inner = [f"{MAIN}{self.sentences(1, 5)}<br><br>" for _ in inner]
        for part, share in ((self.advert, 0.25), (self.share, 0.15), (self.sidebar, 0.12), (self.notice, 0.1), (self.menu, 0.08)):
            if self.rng.random() < share:
                inner.insert(self.rng.randint(0, len(inner)), part())
        if self.rng.random() < 0.2:
            inner.append(self.comments())
        title = f"<h1>{MAIN}{self.words(1, 9).capitalize()}{self.rng.choice(('', '.', ''))}</h1>"
        if self.rng.random() < 0.25:
            title = f"<header>{title}</header>"
        inner = [title, *inner] if self.rng.random() < 0.85 else inner
        out = "\n".join(inner)
        a, z = self.opened("article article main div div section td", "article")
        if a.startswith("<td"):
            a, z = f"<table><tr>{a}", f"{z}</tr></table>"
        out = f"{a}{out}{z}"
        return f"<main>{out}</main>" if self.rng.random() < 0.2 and not a.startswith("<main") else out

    def page(self) -> str:
        before = [self.menu, self.header, self.notice, self.advert, self.form, self.sidebar]
        after = [self.sidebar, self.comments, self.advert, self.share, self.notice, self.form, self.menu]
        self.rng.shuffle(before)
        self.rng.shuffle(after)
        parts = [p() for p in before[: self.rng.randint(0, 4)]]
        if self.rng.random() < 0.95:
            parts.append(self.article())
        parts += [p() for p in after[: self.rng.randint(0, 4)]]
        if self.rng.random() < 0.8:
            parts.append(self.footer())
        if self.rng.random() < 0.3:
            a, z = self.opened("div", "plain")
            parts = [a, *parts, z]
        head = f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title><style>p{{}}</style></head><body>"
        return head + "\n".join(parts) + "<script>var t = '</p>';</script></body></html>"


def labelled_pages(n: int = 900, seed: int = 1, held_out: bool = False) -> list[str]:
    """``n`` pages whose blocks begin with ``MAIN`` or ``OTHER``; held-out pages use names that the others never do."""
    rng = random.Random(f"pages {seed} {held_out}")
    return [_Writer(rng, held_out).page() for _ in range(n)]
