"""HTML extraction: a linear-chain CRF over the leaf blocks of a page.

Blocks (``dom.blocks``) are tagged main text or not.  Features are the
ancestors' tags, the words of their classes, ids and roles, and the block's
text (length, share inside links, punctuation, digits, place in the page);
neighbouring labels interact through learned transitions.  Training maximises
the conditional likelihood (forward-backward, AdaGrad) on labelled pages:
those of ``labelled_pages`` and at most ``max_pages`` pages of the table itself
(the least by hash of id; none larger than ``max_chars`` characters, which None
lifts, or deeper than 250 elements) that mark their article: blocks inside ``article`` or ``main``, but in no nested menu, aside, form, header or
footer, are main text there.  Decoding is by Viterbi.

Every page is read whole.  Defined cases: a null or empty page, or one without
main text, gives an empty text; repeated rows and null ids are extracted row by
row; an empty table gives an empty result (and trains on the labelled pages
alone); other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table
from .dom import Block, Element, blocks
from .labelled_pages import labelled_pages

MAX_PAGES, MAX_CHARS, MAX_DEPTH = 200, 200_000, 250
APART = frozenset("nav aside form header footer".split())


def text_features(k: int, n: int, b: Block) -> list[str]:
    """The active features of block k of n but those of its ancestors."""
    t = b.text
    words = t.count(" ") + 1
    linked = b.linked / len(t)
    return ["bias", f"tag={b.element.tag if b.element else ''}",
            f"words={min(words.bit_length(), 8)}", f"linked={int(linked * 4)}", f"end={t[-1] if t[-1] in '.!?:,;' else ''}",
            f"commas={min(t.count(','), 3)}", f"mark={any(c in t for c in '©|»')}", f"place={4 * k // n}", f"edge={k == 0 or k == n - 1}"]


def element_features(e: Element) -> list[str]:
    return [f"in={e.tag}", *(f"name={w}" for w in e.names)]


def features(page: list[Block]) -> list[list[str]]:
    """The active features of each block, those of its ancestors included."""
    above: dict[Element, list[str]] = {}
    out = []
    for k, b in enumerate(page):
        if b.element and b.element not in above:
            above[b.element] = sorted({x for e in b.element.chain() for x in element_features(e)})
        out.append(text_features(k, len(page), b) + (above[b.element] if b.element else []))
    return out


@dataclass
class Tagger:
    """Feature index, weights (features x 2) and transitions (2 x 2, from row to column)."""

    index: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    def potentials(self, page: list[Block]) -> np.ndarray:
        """Sums of the weights of each block's features.  An element adds its own to its parent's, so that deep pages
        take no longer than flat ones."""
        out = np.zeros((len(page), 2))
        get = self.index.get
        known: dict[Element | None, tuple[frozenset[int], np.ndarray]] = {None: (frozenset(), np.zeros(2))}
        for k, b in enumerate(page):
            new, e = [], b.element
            while e not in known:
                new.append(e)
                e = e.parent
            for e in reversed(new):
                seen, total = known[e.parent]
                more = {i for i in map(get, element_features(e)) if i is not None} - seen
                known[e] = (seen | more, total + self.weights[sorted(more)].sum(axis=0)) if more else (seen, total)
            ids = [i for i in map(get, text_features(k, len(page), b)) if i is not None]
            out[k] = known[b.element][1] + self.weights[ids].sum(axis=0)
        return out

    def tag(self, page: list[Block]) -> list[int]:
        """The most probable labels (Viterbi)."""
        if not page:
            return []
        p = self.potentials(page).tolist()
        (t00, t01), (t10, t11) = self.transitions.tolist()
        a, b = p[0]
        back = []
        for x, y in p[1:]:
            back.append((a + t00 < b + t10, a + t01 < b + t11))
            a, b = max(a + t00, b + t10) + x, max(a + t01, b + t11) + y
        last = int(b > a)
        out = [last]
        for step in reversed(back):
            last = int(step[last])
            out.append(last)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = 12, rate: float = 0.3, ridge: float = 2e-4, least: int = 3) -> Tagger:
    """A CRF for pages of (blocks, labels)."""
    coded = [(features(page), np.array(labels)) for page, labels in pages if page]
    counts: dict[str, int] = {}
    for rows, _ in coded:
        for name in {x for row in rows for x in row}:
            counts[name] = counts.get(name, 0) + 1
    index = {name: k for k, name in enumerate(sorted(x for x, c in counts.items() if c >= least))}
    w, t = np.zeros((len(index), 2)), np.zeros((2, 2))
    sw, st = np.full_like(w, 1e-3), np.full_like(t, 1e-3)
    data = []
    for rows, y in coded:
        ids = [[index[x] for x in row if x in index] for row in rows]
        data.append((np.concatenate([np.array(i, dtype=int) for i in ids]), np.repeat(np.arange(len(ids)), [len(i) for i in ids]), y))
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for k in order.permutation(len(data)):
            ids, at, y = data[k]
            n = len(y)
            p = np.zeros((n, 2))
            np.add.at(p, at, w[ids])
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = p[0]
            for i in range(1, n):
                ahead[i] = p[i] + _log_sum(ahead[i - 1][:, None] + t, 0)
            for i in range(n - 2, -1, -1):
                behind[i] = _log_sum(t + p[i + 1] + behind[i + 1], 1)
            z = _log_sum(ahead[-1], 0)
            g = -np.exp(ahead + behind - z)
            g[np.arange(n), y] += 1
            gw = np.zeros_like(w)
            np.add.at(gw, ids, g[at])
            gt = np.zeros_like(t)
            for i in range(1, n):
                gt -= np.exp(ahead[i - 1][:, None] + t + p[i] + behind[i] - z)
                gt[y[i - 1], y[i]] += 1
            gw -= ridge * w
            sw += gw ** 2
            st += gt ** 2
            w += rate * gw / np.sqrt(sw)
            t += rate * gt / np.sqrt(st)
    return Tagger(index, w, t)


def marked(page: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article, or None."""
    labels = []
    for b in page:
        tags = b.tags
        inside = max((k for k, t in enumerate(tags) if t in ("article", "main")), default=None)
        labels.append(int(inside is not None and not APART.intersection(tags[inside + 1:])))
    share = sum(len(b.text) for b, y in zip(page, labels) if y) / max(1, sum(len(b.text) for b in page))
    return labels if 0.3 <= share < 1 else None


def learn(pages: DataFrame, max_pages: int = MAX_PAGES, max_chars: int | None = MAX_CHARS) -> Tagger:
    data = [(p, [b.label or 0 for b in p]) for p in map(blocks, labelled_pages())]
    fits = F.lit(True) if max_chars is None else F.length("html") <= max_chars
    some = (pages.where(F.col("page_id").isNotNull() & F.col("html").isNotNull() & fits).select("page_id", "html")
            .orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages))
    for row in some.collect():
        page = blocks(row.html)
        deep = any(sum(1 for _ in islice(b.element.chain(), MAX_DEPTH + 1)) > MAX_DEPTH for b in page if b.element)
        labels = None if deep else marked(page)
        if labels:
            data.append((page, labels))
    return train(data)


def main_text(pages: DataFrame, tagger: Tagger, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``: the blocks tagged main text, joined by line ends."""
    source = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() != "text"])

    def one(batches):
        for batch in batches:
            html = batch.column(html_col).to_pylist()
            out = []
            for h in html:
                page = blocks(h)
                out.append("\n".join(b.text for b, y in zip(page, tagger.tag(page)) if y))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "text"])

    return source.mapInArrow(one, T.StructType([*source.schema.fields, T.StructField("text", T.StringType())]))


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages, learn(pages)).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
