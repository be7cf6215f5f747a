"""Pages with known main text, for training and testing the labeller of operator 13.

Texts are put into layouts drawn at random: the article in semantic, classed or bare containers, around and inside it menus,
headers, footers, sidebars, notices, adverts, forms and reader comments. Boilerplate takes its words from the same texts as
articles, so that only markup, shape and neighbourhood tell them apart. A mark in front of every article text says, after
the page was read, which leaves are the article's.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from html import escape

from tesserae.llm.html_leaves import Leaf, leaves

MARK = ""
#: Names that pages give to containers, by what they hold.
ARTICLE = "content post entry article story body main text single page-content post-content entry-content article-body story-body blog-post hentry article-text markdown-body prose copy detail post-body".split()
NEUTRAL = "wrapper inner box block container section area top left right col row grid page site outer layout clearfix panel unit group holder list item lg md js new".split()
OTHER = {
    "menu": (("nav", "div", "ul", "nav", "header"), "nav navbar menu main-menu navigation topnav breadcrumb breadcrumbs toolbar links pagination pager tabs skip-link submenu mobile-menu".split()),
    "header": (("header", "div", "header"), "header site-header masthead topbar branding logo tagline site-title head".split()),
    "footer": (("footer", "div", "footer"), "footer site-footer bottom colophon copyright legal credits imprint foot".split()),
    "side": (("aside", "div", "section", "aside"), "sidebar widget side rail secondary aside recent-posts archives tags categories toc widget-area author-box bio".split()),
    "notice": (("div", "section", "aside", "p"), "cookie cookie-banner consent gdpr notice alert popup modal overlay banner warning message paywall disclaimer privacy announcement".split()),
    "advert": (("div", "aside", "ins", "section", "p"), "ad ads advert advertisement adsbygoogle sponsor sponsored promo promotion banner-ad adslot ad-slot commercial dfp partner".split()),
    "form": (("form", "form", "div"), "form search search-form login signup newsletter subscribe contact-form register feedback survey".split()),
    "comments": (("section", "div", "ol", "ul", "aside"), "comments comment-list comment responses discussion disqus replies reader-comments respond comment-thread user-comments thread".split()),
    "share": (("div", "ul"), "share social sharing follow likes social-links share-buttons".split()),
    "related": (("div", "section", "aside"), "related recommended more read-next popular trending also-like related-posts you-may-like teaser".split()),
}
ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "side": "complementary", "form": "search", "notice": "alert"}


def _class(r: random.Random, word: str) -> str:
    extra, glue = r.choice(NEUTRAL), r.choice(["-", "_", " "])
    return r.choice([word, word, f"{word}{glue}{extra}", f"{extra}{glue}{word}", word.title().replace("-", "")])


def _attributes(r: random.Random, name: str) -> str:
    quote = r.choice(['"', '"', "'"])
    return f" {r.choice(['class', 'class', 'id'])}={quote}{name}{quote}"


class Layout:
    """One page; texts are drawn from `paragraphs` (whole ones and parts of them)."""

    def __init__(self, r: random.Random, paragraphs: Sequence[str]):
        self.r, self.paragraphs = r, paragraphs

    def text(self, most: int | None = None) -> str:
        words = self.r.choice(self.paragraphs).split() or ["text"]
        if most:
            lo = self.r.randrange(len(words))
            words = words[lo : lo + self.r.randint(1, most)]
        return escape(" ".join(words), quote=self.r.random() < 0.5)

    def some(self, low: int, high: int, make) -> str:
        return "".join(make() for _ in range(self.r.randint(low, high)))

    def link(self, most: int = 3) -> str:
        return f'<a href="/{self.r.randrange(9999)}">{self.text(most)}</a>'

    def inline(self, text: str) -> str:
        """Some words of a text in inline tags, which may stay open."""
        words = text.split(" ")
        for _ in range(self.r.choice([0, 0, 1, 2])):
            i, tag = self.r.randrange(len(words)), self.r.choice(["b", "i", "em", "strong", "span", "code", 'a href="#"'])
            words[i] = f"<{tag}>{words[i]}" + ("" if self.r.random() < 0.1 else f"</{tag.split(' ')[0]}>")
        return self.r.choice([" ", " ", "\n  "]).join(words)

    def piece(self) -> str:
        """A part of an article."""
        r, say = self.r, lambda most=None: MARK + self.inline(self.text(most))
        kind = r.choices(["p", "open", "head", "list", "quote", "pre", "table", "figure", "div", "dl"], [50, 8, 9, 6, 4, 2, 4, 3, 5, 2])[0]
        if kind == "p":
            return f"<p>{say(r.choice([None, None, None, 12, 3]))}</p>\n"
        if kind == "open":
            return f"<p>{say()}<br>"
        if kind == "head":
            n = r.choice("223345")
            return f"<h{n}>{say(8)}</h{n}>"
        if kind == "list":
            tag = r.choice(["ul", "ol"])
            return f"<{tag}>{self.some(2, 6, lambda: f'<li>{say(15)}</li>')}</{tag}>"
        if kind == "quote":
            return f"<blockquote><p>{say()}</p></blockquote>"
        if kind == "pre":
            return f"<pre>{say(20)}</pre>"
        if kind == "table":
            return f"<table>{self.some(1, 4, lambda: f'<tr><td>{say(4)}<td>{say(4)}</tr>')}</table>"
        if kind == "figure":
            return f"<figure><img src=x.png><figcaption>{say(15)}</figcaption></figure>"
        if kind == "dl":
            return f"<dl>{self.some(1, 4, lambda: f'<dt>{say(3)}<dd>{say(15)}')}</dl>"
        return f"<div>{say()}</div>"

    def other(self, kind: str) -> str:
        r = self.r
        tags, names = OTHER[kind]
        tag = r.choice(tags)
        named = tag in ("div", "ul", "ol", "p", "section", "ins") or r.random() < 0.6
        attributes = _attributes(r, _class(r, r.choice(names))) if named else ""
        if kind in ROLES and r.random() < 0.1:
            attributes += f' role="{ROLES[kind]}"'
        if tag in ("ul", "ol") and kind != "comments":
            return f"<{tag}{attributes}>{self.some(2, 9, lambda: f'<li>{self.link()}</li>')}</{tag}>"
        links = lambda: r.choice([lambda: "<ul>" + self.some(2, 9, lambda: f"<li>{self.link()}</li>") + "</ul>", lambda: self.some(2, 6, lambda: self.link() + r.choice([" ", " | ", " &middot; "]))])()
        said = lambda most=30: r.choice([lambda: f"<p>{self.inline(self.text(most))}</p>", lambda: self.inline(self.text(most))])()
        if kind in ("menu", "share"):
            inner = links()
        elif kind == "header":
            inner = r.choice([f"<h1>{self.text(4)}</h1>", self.link(4), f"<span>{self.text(4)}</span>"]) + r.choice(["", f"<p>{self.text(8)}</p>", links()])
        elif kind == "footer":
            inner = r.choice(["&copy; ", "&#169; 2024 ", ""]) + self.text(12) + r.choice(["", links(), said()])
        elif kind == "side":
            inner = r.choice(["", f"<h3>{self.text(4)}</h3>"]) + r.choice([links, said, lambda: said(None) + said(), lambda: links() + said()])()
        elif kind in ("notice", "advert"):
            inner = said(r.choice([6, 15, 40])) + r.choice(["", "", f"<button>{self.text(2)}</button>", self.link()])
        elif kind == "form":
            inner = r.choice(["", said(12)]) + self.some(1, 4, lambda: f"<label>{self.text(2)}</label><input name=a>") + r.choice(["", f"<button>{self.text(2)}</button>", f"<p>{self.text(15)}</p>"])
        elif kind == "comments":
            each = lambda: r.choice([f"<div{_attributes(r, 'comment')}>%s</div>", "<article>%s</article>", "%s", "<div>%s</div>"]) % (r.choice(["", f"<b>{self.text(2)}</b> ", f"<h4>{self.text(2)}</h4>"]) + f"<p>{self.inline(self.text(r.choice([None, 12, 40])))}</p>")
            inner = r.choice(["", f"<h3>{self.text(3)}</h3>"]) + (self.some(1, 6, lambda: f"<li>{each()}</li>") if tag in ("ul", "ol") else self.some(1, 6, each))
        else:
            inner = f"<h3>{self.text(3)}</h3>" + self.some(2, 5, lambda: r.choice([f"<p>{self.link(8)}</p>", f"<div><h4>{self.link(8)}</h4><p>{self.text(15)}</p></div>", f"<li>{self.link(8)}</li>"]))
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def html(self) -> str:
        r = self.r
        within = ["advert", "advert", "notice", "share", "related", "form", "side"]
        parts = [f"<h1>{MARK}{self.text(10)}</h1>" if r.random() < 0.8 else ""] + [self.piece() for _ in range(r.choice([1, 2, 4, 6, 9, 14, 25]))]
        if parts[0] and r.random() < 0.15:
            parts[0] = f"<header>{parts[0]}</header>"
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            parts.insert(r.randint(1, len(parts)), self.other(r.choice(within)))
        if r.random() < 0.25:
            parts.append(self.other("comments"))
        body = "".join(parts)
        shape = r.choice(["article", "article", "article", "main", "both", "class", "class", "class", "section", "bare", "cell"])
        name = _attributes(r, _class(r, r.choice(ARTICLE)))
        if shape in ("article", "main"):
            body = f"<{shape}{r.choice(['', name])}>{body}</{shape}>"
        elif shape == "both":
            body = f"<main><article{r.choice(['', name])}>{body}</article></main>"
        elif shape in ("class", "section"):
            tag = "div" if shape == "class" else "section"
            body = f"<{tag}{name}>{body}</{tag}>"
        elif shape == "bare":
            body = f"<div>{''.join(self.piece() for _ in range(3))}{body}</div>"
        else:
            body = f"<table><tr><td>{self.other('menu')}</td><td{name}>{body}</td></tr></table>"
        before = [self.other(k) for k in ("header", "menu", "notice", "advert", "form", "side", "share") if r.random() < 0.4]
        after = [self.other(k) for k in ("comments", "related", "share", "side", "advert", "form", "notice") if r.random() < 0.35]
        r.shuffle(before)
        r.shuffle(after)
        inner = "".join(before) + body + "".join(after) + (self.other("footer") if r.random() < 0.8 else "")
        for _ in range(r.choice([0, 0, 1, 2])):
            inner = f"<div{_attributes(r, r.choice(NEUTRAL))}>{inner}</div>"
        head = f"<title>{self.text(6)}</title><style>p{{margin:0}}</style><script>var t='<p>x</p>';</script>"
        return f"<!DOCTYPE html><html><head>{head}</head><body>{inner}<!-- end -->" + r.choice(["</body></html>", ""])


def marked(html: str) -> tuple[list[Leaf], list[bool]]:
    """The leaves of a page made here without their marks, and which are the article's."""
    found = leaves(html)
    truth = [MARK in x.text for x in found]
    for x in found:
        x.text = " ".join(x.text.replace(MARK, "").split())
    kept = [(x, t) for x, t in zip(found, truth, strict=True) if x.text]
    return [x for x, _ in kept], [t for _, t in kept]
