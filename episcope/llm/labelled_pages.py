"""Labelled training pages: layouts with ``data-y`` on what is main text (1) or not (0).

Pages are drawn from lists of the ways in which sites mark up each part, so
the tagger sees every part under several tags and names.
"""

from __future__ import annotations

import random

WORDS = ("the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were "
         "all her she there would their we him been has when who will no more if out so up said what its about than into them can only "
         "other time new some could these two may first then do any like my now over such our man me even most made after also well").split()

CONTAINERS = ["<article{y}>{x}</article>", "<main{y}>{x}</main>", '<div class="content"{y}>{x}</div>', '<div id="main"{y}>{x}</div>',
              '<section class="post body"{y}>{x}</section>', '<div class="entry-content article-text"{y}>{x}</div>', '<div role="main"{y}>{x}</div>',
              "<main><article{y}>{x}</article></main>", '<div class="wrap"><div class="story"{y}>{x}</div></div>', "<div{y}>{x}</div>",
              "<table><tr><td{y}>{x}</td></tr></table>"]
MENUS = ["<nav><ul>{l}</ul></nav>", '<div class="menu"><ul>{l}</ul></div>', '<ul class="nav navbar">{l}</ul>', '<div id="navigation">{a}</div>',
         '<div class="breadcrumb">{a}</div>', '<div role="navigation">{a}</div>', "<ul>{l}</ul>", '<div class="toc"><ol>{l}</ol></div>']
HEADERS = ["<header><h2>{s}</h2><p>{s}</p></header>", '<div class="header"><span>{s}</span></div>', '<div id="masthead"><a href="/">{s}</a></div>',
           '<div class="topbar">{s}</div>', '<div role="banner"><p>{s}</p></div>', '<div class="site-title"><h2>{s}</h2></div>']
FOOTERS = ["<footer>&copy; {s} &middot; {p}</footer>", '<div class="footer"><p>&copy; {s}</p>{a}</div>', '<div id="footer">{a}<br>All rights reserved. {p}</div>',
           '<div role="contentinfo"><p>{p}</p></div>', "<footer><ul>{l}</ul><p>{p}</p></footer>", '<div class="copyright">&copy; {s}</div>']
SIDEBARS = ["<aside><h3>{s}</h3><p>{p}</p></aside>", '<div class="sidebar"><h4>{s}</h4><ul>{l}</ul></div>', '<div class="related"><h3>Related</h3><ul>{l}</ul></div>',
            '<div id="secondary" class="widget"><p>{p}</p></div>', '<div class="sidebar"><p>{p}</p><p>{p}</p></div>', '<div class="recommended">{a}</div>',
            '<div class="tags">{a}</div>', '<div class="author-bio"><p>{p}</p></div>', '<div class="share social">{a}</div>']
NOTICES = ['<div class="cookie-notice"><p>{p}</p></div>', '<div id="consent">{p}</div>', '<div class="alert"><p>{p}</p></div>', '<div class="banner">{s}</div>',
           '<div class="notice">{p}</div>', '<div class="popup modal"><h3>{s}</h3><p>{p}</p></div>', '<div role="alert"><p>{p}</p></div>', '<div class="cookies">{p}</div>',
           '<div class="disclaimer">{p}</div>', '<div class="paywall subscribe"><p>{p}</p></div>', '<div class="gdpr">{p}</div>', '<div role="dialog"><p>{p}</p></div>']
ADVERTS = ['<div class="ad">{s}</div>', '<div class="ads"><p>{p}</p></div>', '<div class="advert">{p}</div>', '<div class="promo"><a href="/x">{s}</a></div>',
           '<div id="ad-top" class="sponsored">{p}</div>', '<aside class="advertisement"><p>{p}</p></aside>', '<div class="ad-slot"><p>{s}</p></div>',
           '<div class="sponsor">{p}</div>', '<section class="promotion"><p>{p}</p></section>']
FORMS = ['<form action="/s"><label>{s}</label><input name="q"><button>Go</button></form>', '<form class="newsletter"><p>{p}</p><input></form>',
         '<div class="search"><form><p>{s}</p><input></form></div>', '<div class="newsletter signup"><p>{p}</p></div>', '<form id="login"><fieldset><legend>{s}</legend><p>{p}</p></fieldset></form>']
COMMENTS = ['<div class="comments"><h3>Comments</h3>{c}</div>', '<section id="comments">{c}</section>', '<ol class="comment-list">{d}</ol>',
            '<div class="discussion reader-comments">{c}</div>', '<div class="comment"><b>{s}</b><p>{p}</p></div>', '<section class="replies">{c}</section>',
            '<div class="responses"><p>{p}</p></div>', '<ul class="reviews">{d}</ul>']


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def sentence(self, low: int = 6, high: int = 18) -> str:
        words = self.r.choices(WORDS, k=self.r.randint(low, high))
        return (" ".join(words)).capitalize() + self.r.choice("....?!")

    def paragraph(self) -> str:
        return " ".join(self.sentence() for _ in range(self.r.choice([1, 1, 2, 3, 4, 6])))

    def links(self, pattern: str) -> str:
        return "".join(pattern.format(" ".join(self.r.choices(WORDS, k=self.r.randint(1, 3)))) for _ in range(self.r.randint(3, 8)))

    def part(self, patterns: list[str]) -> str:
        fill = {"s": self.sentence(1, 6).rstrip("."), "p": self.paragraph(), "a": self.links('<a href="/">{}</a> '), "l": self.links('<li><a href="/">{}</a></li>'),
                "c": "".join(f'<div class="comment"><b>{self.sentence(1, 2)}</b><p>{self.paragraph()}</p></div>' for _ in range(self.r.randint(1, 4))),
                "d": "".join(f"<li><p>{self.paragraph()}</p></li>" for _ in range(self.r.randint(1, 4)))}
        return '<div data-y="0">' + self.r.choice(patterns).format(**fill) + "</div>"

    def body(self) -> str:
        r, out = self.r, [f"<h1>{self.sentence(3, 9)}</h1>"] if self.r.random() < 0.8 else []
        for _ in range(r.choice([1, 2, 4, 6, 9, 14])):
            kind = r.random()
            if kind < 0.62:
                out.append(f"<p>{self.paragraph()}</p>")
            elif kind < 0.70:
                out.append(f"<p><b>{self.sentence(1, 12)}<br>")
            elif kind < 0.78:
                out.append(f"<p>{self.sentence(1, 3)}</p>")
            elif kind < 0.84:
                out.append(f"<h2>{self.sentence(2, 6)}</h2><p>{self.paragraph()} <a href='/'>{self.sentence(1, 3)}</a> {self.sentence()}</p>")
            elif kind < 0.90:
                out.append("<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.94:
                out.append(f"<blockquote><p>{self.paragraph()}</p></blockquote>")
            else:
                out.append(f"<p>{self.paragraph()}</p>" + self.part(r.choice([ADVERTS, SIDEBARS, NOTICES, FORMS])))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        some = lambda *lists: "".join(self.part(p) for p in r.sample(lists, k=r.randint(0, len(lists))))
        main = r.choice(CONTAINERS).format(y=' data-y="1"', x=self.body())
        return (f"<html><head><title>{self.sentence()}</title></head><body data-y=\"0\">" + some(HEADERS, MENUS, NOTICES, ADVERTS) + some(SIDEBARS, FORMS)
                + main + some(COMMENTS, SIDEBARS, ADVERTS, FORMS) + some(MENUS, NOTICES, FOOTERS) + "</body></html>")


def labelled_pages(count: int = 400, seed: int = 7) -> list[str]:
    return [_Writer(seed * 100_000 + k).page() for k in range(count)]
