"""Labelled pages for the extractor: page plans filled with seeded pseudo-text.

``data-main`` marks main text (1) or not (0) for everything inside an element.  The parser's
features never see that attribute.
"""

from __future__ import annotations

import random

MENU = "nav menu navbar navigation topnav breadcrumb breadcrumbs toc pagination tabs".split()
ADVERT = "ad ads advert advertisement adsense banner sponsored sponsor promo promotion".split()
SIDE = "sidebar side aside widget related recommended popular trending rail".split()
NOTICE = "notice cookie cookies consent gdpr alert popup modal newsletter subscribe disclaimer".split()
COMMENTS = "comments comment discussion replies reader responses disqus".split()
FOOT = "footer foot bottom copyright legal colophon".split()
HEAD = "header masthead top branding logo".split()
SHARE = "share social sharing tags meta byline".split()
BODY = "content post entry article story main text body page prose".split()


class Filler:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        r = self.r
        return "".join(r.choice("aeioubcdfglmnprstvéüñ") for _ in range(r.randrange(1, 10))) + r.choice(["", "", "", "", ",", "###", "%%%"])

    def sentence(self, low: int, high: int) -> str:
        words = " ".join(self.word() for _ in range(self.r.randrange(low, high)))
        return words.capitalize() + self.r.choice([".", ".", ".", "!", "?", ""])

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.sentence(1, 18) for _ in range(self.r.randrange(low, high)))

    def links(self, low: int, high: int) -> str:
        items = "".join(f'<li><a href="/{self.word()}">{self.sentence(1, 3)}</a></li>' for _ in range(self.r.randrange(low, high)))
        return f"<ul>{items}</ul>"

    def attr(self, words: list[str]) -> str:
        w = self.r.choice(words)
        w = self.r.choice([w, w, f"{w}-{self.r.choice(['box', 'wrap', 'inner', 'area', 'list'])}", f"site-{w}"])
        return f' {self.r.choice(["class", "class", "id"])}="{w}"'


def _outside(f: Filler, kind: str) -> str:
    r, tag = f.r, None
    off = ' data-main="0"'
    if kind == "menu":
        tag, attr = r.choice([("nav", ""), ("nav", f.attr(MENU)), ("div", f.attr(MENU)), ("ul", f.attr(MENU))])
        return f"<{tag}{attr}{off}>{f.links(2, 9)}</{tag}>"
    if kind == "advert":
        tag, attr = r.choice([("div", f.attr(ADVERT)), ("aside", f.attr(ADVERT)), ("p", f.attr(ADVERT)), ("section", f.attr(ADVERT))])
        return f"<{tag}{attr}{off}>{f.prose(1, 4)}</{tag}>"
    if kind == "side":
        tag, attr = r.choice([("aside", ""), ("aside", f.attr(SIDE)), ("div", f.attr(SIDE))])
        head = r.choice(["", f"<h3>{f.sentence(1, 4)}</h3>"])
        return f"<{tag}{attr}{off}>{head}{r.choice([f.links(2, 7), f'<p>{f.prose(1, 4)}</p>'])}</{tag}>"
    if kind == "notice":
        tag = r.choice(["div", "section", "p"])
        inside = f.prose(1, 4) if tag == "p" else f"<p>{f.prose(1, 4)}</p><button>{f.sentence(1, 3)}</button>"
        return f"<{tag}{f.attr(NOTICE)}{off}>{inside}</{tag}>"
    if kind == "form":
        return f'<form action="/s"{off}><label>{f.sentence(1, 4)}</label><input name="q"><p>{f.prose(1, 2)}</p><select><option>{f.word()}<option>{f.word()}</select><textarea>{f.prose(1, 2)}</textarea><button>{f.word()}</button></form>'
    if kind == "comments":
        tag = r.choice(["section", "div", "ol"])
        each = "".join(f"<{'li' if tag == 'ol' else 'div'}{f.attr(COMMENTS)}><b>{f.word()}</b><p>{f.prose(1, 5)}</p></{'li' if tag == 'ol' else 'div'}>" for _ in range(r.randrange(1, 6)))
        head = r.choice(["", f"<h3>{f.sentence(1, 3)}</h3>"])
        each = r.choice([each, each, "".join(f"<p>{f.prose(1, 5)}</p>" for _ in range(r.randrange(1, 5)))])
        return f"<{tag}{f.attr(COMMENTS)}{off}>{head}{each}</{tag}>"
    if kind == "footer":
        tag, attr = r.choice([("footer", ""), ("footer", ""), ("footer", f.attr(FOOT)), ("div", f.attr(FOOT))])
        return f"<{tag}{attr}{off}>{r.choice(['&copy; ', '', '&copy; 2020 '])}{f.word()}.example &middot; {f.prose(1, 3)}{r.choice(['', f.links(1, 5)])}</{tag}>"
    if kind == "header":
        tag, attr = r.choice([("header", ""), ("header", f.attr(HEAD)), ("div", f.attr(HEAD))])
        return f"<{tag}{attr}{off}>{r.choice(['', f'<h1>{f.sentence(1, 4)}</h1>'])}<p>{f.sentence(1, 8)}</p></{tag}>"
    return f"<div{f.attr(SHARE)}{off}>{f.sentence(1, 5)} <a href='#'>{f.word()}</a> <a href='#'>{f.word()}</a></div>"


def _article(f: Filler) -> str:
    r = f.r
    tag, attr = r.choice([("article", ""), ("article", ""), ("article", f.attr(BODY)), ("main", ""), ("div", f.attr(BODY)), ("section", f.attr(BODY)), ("div", "")])
    title = f.sentence(2, 12)
    parts = [r.choice([f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f"<h2>{title}</h2>", ""])]
    for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 13])):
        parts.append(
            r.choice(
                [f"<p>{f.prose(1, 9)}</p>"] * 8
                + [f"<p><b>{f.sentence(1, 9)}<br>", f"<p>{f.sentence(1, 3)}</p>", f"<h2>{f.sentence(1, 6)}</h2><p>{f.prose(1, 5)}</p>", f"<ul><li>{f.prose(1, 2)}</li><li>{f.prose(1, 2)}</li></ul>", f"<blockquote><p>{f.prose(1, 3)}</p></blockquote>", f"<pre>{f.prose(1, 3)}</pre>", f"<p>{f.prose(1, 3)} <a href='/x'>{f.word()}</a> {f.prose(1, 2)}</p>", f"<table><tr><td>{f.word()}<td>{f.sentence(1, 4)}</table>", f"<div>{f.prose(1, 6)}</div>"]
            )
        )
        if r.random() < 0.06:
            parts.append(_outside(f, r.choice(["advert", "share", "side", "form", "menu"])))
    return f'<{tag}{attr} data-main="1">{"".join(parts)}</{tag}>'


def labelled_pages(n: int, seed: int = 11) -> list[str]:
    """n pages with every kind of block around (and sometimes in) an article."""
    f = Filler(seed)
    out = []
    for _ in range(n):
        r = f.r
        before = [k for k in ("header", "menu", "notice", "advert", "side", "form") if r.random() < 0.45]
        after = [k for k in ("share", "side", "advert", "comments", "form", "menu", "notice") if r.random() < 0.35] + ["footer"] * (r.random() < 0.85)
        r.shuffle(before)
        inside = "".join(_outside(f, k) for k in before) + _article(f) + "".join(_outside(f, k) for k in after)
        if r.random() < 0.3:
            inside = f'<div class="{r.choice(["wrapper", "container", "layout", "page"])}">{inside}</div>'
        out.append(f"<!DOCTYPE html><html><head><title>{f.sentence(1, 5)}</title></head><body>{inside}</body></html>")
    return out
