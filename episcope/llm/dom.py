"""Leaf blocks of web pages: the text runs between block-level tags, with their ancestors.

A tolerant reader for real pages: unclosed paragraphs, list items and inline
tags end where the next block begins; scripts, styles, comments and form
controls hold no text.

Scripts, styles, text areas and titles end at their end tag, or with the page.
The other elements without text (``HIDDEN``) hide all they hold if their own end
tag comes before their parent's; if not, they hide their own direct text alone,
and the blocks that follow are read on.

Reading takes time and memory in proportion to the page, however deep it is:
elements know their parent, and blocks know their element.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

# Fixed values of HTML: tags that do not end a text run, tags without an end, and tags whose content is no text:
# read on to their end tag, or elements like others.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr "
                   "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
HIDDEN = frozenset("template noscript iframe svg select button object canvas audio video option optgroup annotation".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = frozenset("table ul ol dl article section main aside nav div body html form blockquote header footer td th".split()) | HIDDEN

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+|[^>]*)>""", re.S)
OPENING = re.compile(r"<!--|<!\[CDATA\[")
ATTRIBUTE = re.compile(r"""(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PARTS = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")


@dataclass(slots=True, eq=False)
class Element:
    """An open element: its own tag and the words of its class, id and role; the rest is its parent's."""

    tag: str
    names: frozenset[str] = frozenset()
    parent: Element | None = None
    label: int | None = None  # of labelled pages: the nearest data-y
    block: Element | None = None  # the nearest element, itself included, that is not inline
    hidden: Element | None = None  # the nearest element, itself included, of HIDDEN
    ended: bool = False  # an element of HIDDEN: by its own end tag, or inside one that is

    def chain(self) -> Iterator[Element]:
        """The element and its ancestors, innermost first."""
        at: Element | None = self
        while at is not None:
            yield at
            at = at.parent


@dataclass(slots=True)
class Block:
    text: str
    element: Element | None
    linked: int  # characters inside links

    @property
    def label(self) -> int | None:
        return self.element.label if self.element else None

    @property
    def tags(self) -> tuple[str, ...]:
        """Of the ancestors, outermost first."""
        return tuple(e.tag for e in self.element.chain())[::-1] if self.element else ()

    @property
    def names(self) -> frozenset[str]:
        """Words of the ancestors' class, id and role."""
        return frozenset().union(*(e.names for e in self.element.chain())) if self.element else frozenset()


@dataclass(slots=True)
class _Run:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    found: bool = False
    element: Element | None = None


_END_OF = {tag: re.compile(rf"</{tag}(?:\s[^>]*|/)?>", re.I) for tag in RAW}


def blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page in page order; texts have character references decoded and white space folded."""
    out: list[Block] = []
    stack: list[Element] = []
    hidden: list[Element] = []  # all elements of HIDDEN, in page order
    opened: Counter[str] = Counter()  # open elements by tag
    run = _Run()
    html = html or ""

    def text(raw: str) -> None:
        if not raw:
            return
        run.parts.append(raw)
        if not raw.isspace():
            if not run.found:
                run.found, run.element = True, stack[-1] if stack else None
            if any(e.tag == "a" for e in stack[-4:]):
                run.linked += len(raw)

    def flush() -> None:
        nonlocal run
        if run.found:
            folded = SPACES.sub(" ", unescape("".join(run.parts))).strip()
            if folded:
                out.append(Block(folded, run.element, min(run.linked, len(folded))))
        if run.parts:
            run = _Run()

    def cut(k: int) -> None:
        for e in stack[k:]:
            opened[e.tag] -= 1
        del stack[k:]

    def close(which: frozenset[str] | set[str], barrier: frozenset[str], own: bool = False) -> None:
        if not any(opened[t] for t in which):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag in which:
                stack[k].ended = own
                cut(k)
                return
            if stack[k].tag in barrier:
                return

    at, end = 0, len(html)
    last = html.rfind(">") + 1  # no tag ends beyond
    while at < end:
        found = TAG.search(html, at, last) if at < last else None
        if not found:
            opening = OPENING.search(html, at)  # a comment, or literal text, without an end
            text(html[at:opening.start()] if opening else html[at:])
            if opening and opening[0] != "<!--":
                text(html[opening.end():].replace("&", "&amp;"))
            break
        text(html[at:found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            mark = found[0]
            if mark.startswith("<![CDATA["):
                ended = mark.endswith("]]>")
                text((mark[9:-3] if ended else mark[9:] + html[at:]).replace("&", "&amp;"))
                at = at if ended else end
            elif mark.startswith("<!--") and not mark.endswith("-->"):
                break
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        elif tag == "br":
            text(" ")
            continue
        if found[1]:
            close({tag}, frozenset() if tag not in INLINE else BARRIER, own=True)
            continue
        attributes = found[3]
        if tag in RAW and not attributes.endswith("/"):
            stop = _END_OF[tag].search(html, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID or attributes.endswith("/") and (tag not in BARRIER or tag in HIDDEN) and tag != "p":
            continue
        if tag not in INLINE:
            if tag not in HIDDEN:
                close({"p"}, BARRIER)
            if tag in ENDS:
                close(ENDS[tag], BARRIER - ENDS[tag])
        above = stack[-1] if stack else None
        label = above.label if above else None
        names = frozenset()
        if attributes:
            words: set[str] = set()
            for key, *values in ATTRIBUTE.findall(attributes):
                value = next(filter(None, values), "")
                if key.lower() == "data-y":
                    label = int(value == "1")
                else:
                    words.update(NAME_PARTS.findall(value.lower()))
            names = frozenset(words)
        new = Element(tag, names, above, label, above.block if above else None, above.hidden if above else None)
        if tag not in INLINE:
            new.block = new
        if tag in HIDDEN:
            hidden.append(new)
            new.hidden = new
        stack.append(new)
        opened[tag] += 1
    flush()
    for e in hidden:  # outer elements come first
        e.ended = e.ended or e.parent is not None and e.parent.hidden is not None and e.parent.hidden.ended
    return [b for b in out if b.element is None or b.element.hidden is None or not (b.element.hidden.ended or b.element.block is b.element.hidden)]
