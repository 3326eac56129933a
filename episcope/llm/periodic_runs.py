"""Periodic runs of words: maximal pairs of the LCP-interval tree whose distance is their period.

A *run* is a stretch of words of smallest period q (words q apart are equal),
at least ``min_length`` words and ``min_exponent`` periods long, that no
neighbouring word extends.  A run of period q and length L that starts at i is
the maximal pair (i, i + q): both suffixes share L - q words, the words before
them differ, and so do the words after.  Every maximal pair of distance
q <= common / (min_exponent - 1) is a run or a run read with a multiple of its
period; its start and end are at hand, nothing is extended.

**Per document**

1. Words become numbers that differ between documents; ranks of the first 1, 2,
   4, 8, ... words (prefix doubling, only what is still tied is sorted again)
   give the suffix order and, read from the longest ranks down, the common
   prefixes of neighbours.
2. Neighbours that share at least ``min_common`` words form the forest of LCP
   intervals worth a look; a tree whose closest two positions are further apart
   than its longest common prefix allows holds no run and is left out.
3. A tree is walked bottom up.  Each interval has the ordered list of its
   positions and their left-word class: one word, or mixed.  When a child joins
   its interval, the smaller list's positions look up their neighbours in the
   larger.  Neighbours are enough: a run's partner i + q is the next occurrence
   of the shared words after i, as one in between would be a shorter period.
   Lists of one and the same left word join without a look; neighbours of equal
   left words are no maximal pair.
4. Of pairs with the same start and end the smallest distance stays.

Memory is that of ``chunk_chars`` of text, or of one document.  No step is
proportional to pairs of occurrences: a position moves between lists at most
log2(n) times.

Defined cases: null and empty texts have no words and no runs; ids are not read
and rows are handled one by one (repeated rows alike); other columns stay,
those named like a result (in any case) are replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, without

CHUNK_CHARS = 1 << 20
_MIXED = -2
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_RUN = pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")])


# ---------------------------------------------------------------- suffix order

def _ranks(units: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... units; the last ranks are all different.

    A rank is the number of smaller suffixes, so that ranks of ties are equal.  One more entry, -1, stands for the end.
    """
    n = len(units)
    order = np.argsort(units, kind="stable")
    line = units[order]
    heads = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    sizes = np.diff(np.append(heads, n))
    rank = np.full(n + 1, -1, dtype=np.int64)
    rank[order] = np.repeat(heads, sizes)
    out, step = [rank], 1
    tied = order[np.repeat(sizes > 1, sizes)]
    while len(tied):
        rank = rank.copy()
        first, second = out[-1][tied], out[-1][np.minimum(tied + step, n)]
        order = np.argsort(first * (n + 1) + second + 1, kind="stable")
        tied, first, second = tied[order], first[order], second[order]
        group = np.concatenate([[True], first[1:] != first[:-1]])
        new = group | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(tied))
        base = np.maximum.accumulate(np.where(group, at, 0))
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank[tied] = first + head - base
        sizes = np.diff(np.append(np.flatnonzero(new), len(tied)))
        tied = tied[np.repeat(sizes > 1, sizes)]
        out.append(rank)
        step *= 2
    return out


def _suffixes(units: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that share ``least`` units or more with a neighbour in suffix order, in that order, and each one's
    common prefix with the one before (0 where a new tree begins)."""
    ranks = _ranks(units)
    n = len(units)
    level = min(least.bit_length() - 1, len(ranks) - 1)
    tied = ranks[level][:n]
    some = np.flatnonzero(np.bincount(tied, minlength=n)[tied] > 1)
    order = some[np.argsort(ranks[-1][some])]
    a, b = order[:-1], order[1:]
    common = np.zeros(len(b), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = np.minimum(a + common, n), np.minimum(b + common, n)
        common += (1 << k) * ((ranks[k][x] == ranks[k][y]) & (x < n) & (y < n))
    common[common < least] = 0
    return order, np.concatenate([[0], common]) if len(order) else common


# ---------------------------------------------------------------- the tree

def _join(one: tuple, other: tuple, common: int, left: list[int], found: list, least: int, times: int) -> tuple:
    """The lists of two children of an interval of depth ``common``; their maximal pairs of neighbours go to ``found``."""
    if len(one[0]) < len(other[0]):
        one, other = other, one
    (many, kind), (few, kind_) = one, other
    if kind != kind_ or kind == _MIXED:
        far = common // times
        for x in few:
            k = bisect_left(many, x)
            for y in many[k - 1:k + 1] if k else many[:1]:
                a, b = (x, y) if x < y else (y, x)
                if b - a <= far and b - a + common >= least and left[a] != left[b]:
                    found.append((a, b - a + common, b - a))
    if len(few) == 1:
        insort(many, few[0])
    else:
        many.extend(few)
        many.sort()
    return many, kind if kind == kind_ else _MIXED


def _tree(positions: list[int], common: list[int], left: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, distance) of the maximal pairs of one tree, bottom up over its LCP intervals."""
    found: list[tuple[int, int, int]] = []
    stack: list[list] = []  # open intervals: depth, list so far
    now = ([positions[0]], left[positions[0]])
    for k in range(1, len(positions) + 1):
        depth = common[k] if k < len(positions) else 0
        while stack and stack[-1][0] > depth:
            above, held = stack.pop()
            now = _join(held, now, above, left, found, least, times)
        if k == len(positions):
            return found
        if stack and stack[-1][0] == depth:
            stack[-1][1] = _join(stack[-1][1], now, depth, left, found, least, times)
        else:
            stack.append([depth, now])
        now = ([positions[k]], left[positions[k]])
    return found


def runs_of(units: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbers >= 0, by start, then period."""
    times = min_exponent - 1
    if min_exponent < 2 or len(units) < min_exponent:
        if min_exponent < 2:
            raise ValueError("runs repeat at least twice")
        return []
    least = min(max(min_length - q, times * q) for q in range(1, max(min_length, 2)))
    order, common = _suffixes(units, least)
    if not len(order):
        return []
    heads = np.flatnonzero(common == 0)
    tree = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    deepest = np.maximum.reduceat(common, heads)
    by_place = np.lexsort((order, tree))
    gaps = np.full(len(order), len(units), dtype=np.int64)
    gaps[1:] = np.where(tree[1:] == tree[:-1], np.diff(order[by_place]), len(units))
    left = [-1, *units[:-1].tolist()]
    found: list[tuple[int, int, int]] = []
    for k in np.flatnonzero(np.minimum.reduceat(gaps, heads) * times <= deepest):
        a, b = heads[k], heads[k + 1] if k + 1 < len(heads) else len(order)
        found += _tree(order[a:b].tolist(), common[a:b].tolist(), left, min_length, times)
    best: dict[tuple[int, int], int] = {}
    for start, length, period in found:
        best[start, length] = min(period, best.get((start, length), period))
    return sorted((start, length, period) for (start, length), period in best.items())


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those that a run holds after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    return [w for w, x in zip(words, gone.tolist()) if not x]


def _chunks(texts: list[str | None], chars: int) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in runs of texts of about ``chars`` characters."""
    part, size = [], 0
    for t in texts:
        part.append((t or "").encode().split())  # bytes split on exactly \x20 and \x09-\x0D
        size += len(t or "")
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def _runs_of_texts(split: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """Each text's runs, all texts in one pass: words of different texts get different numbers."""
    sizes = np.array([len(s) for s in split])
    at = np.concatenate([[0], np.cumsum(sizes)])
    seen: dict[bytes, int] = {}
    flat = np.fromiter((seen.setdefault(w, len(seen)) for s in split for w in s), dtype=np.int64, count=int(at[-1]))
    flat += np.repeat(np.arange(len(split)), sizes) * len(seen)
    out: list[list[tuple[int, int, int]]] = [[] for _ in split]
    runs = runs_of(flat, min_length, min_exponent)
    owner = np.searchsorted(at, [r[0] for r in runs], side="right") - 1
    for k, (start, length, period) in zip(owner.tolist(), runs):
        out[k].append((start - int(at[k]), length, period))
    return out


# ---------------------------------------------------------------- Spark

def periodic_runs(docs: DataFrame, text_col: str = "text", min_length: int = 6, min_exponent: int = 4,
                  chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The rows of ``docs``, less the text, with n_words, runs (by start, then period), the run of greatest
    length / period as ``best`` (ties: smallest start, then period; null without runs), and ``collapsed``: the words
    that no run holds after its first period, joined by one space."""
    results = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("best", RUN),
               T.StructField("collapsed", T.StringType())]
    kept = without(docs, [text_col, *(f.name for f in results)])
    # The columns that stay travel as one struct: mapInArrow can't name columns with dots.
    rest = F.struct(*[F.col(f"`{c}`") for c in kept.columns]) if kept.columns else F.lit(None).cast("struct<x:int>")
    source = docs.select(rest.alias("__row"), F.col(f"`{text_col}`").alias("__text"))

    def find(batches):
        for batch in batches:
            at = 0
            for split in _chunks(batch.column(1).to_pylist(), chunk_chars):
                runs = _runs_of_texts(split, min_length, min_exponent)
                best = [max(r, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if r else None for r in runs]
                named = [None if x is None else dict(zip(RUN.names, x)) for x in best]
                columns = [pa.array([len(s) for s in split], pa.int64()),
                           pa.array([[dict(zip(RUN.names, x)) for x in r] for r in runs], pa.list_(pa.field("element", _RUN, False))),
                           pa.array(named, _RUN),
                           pa.array([b" ".join(collapse(s, r)) for s, r in zip(split, runs)], pa.binary()).cast(pa.string())]
                row = batch.column(0).slice(at, len(split))
                at += len(split)
                yield pa.RecordBatch.from_arrays([row, *columns], names=["__row", *(f.name for f in results)])

    found = source.mapInArrow(find, T.StructType([source.schema["__row"], *results]))
    return found.select(*(["__row.*"] if kept.columns else []), *(f.name for f in results))


def with_planted_tail(doc_id: Column, text: Column) -> Column:
    """The contract's text: where crc32(doc_id) ends in 0, the words from a on repeat with period p."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    packed = F.struct(words.alias("w"), F.size(words).alias("n"), g.alias("g"))
    # A one-element array binds the words once, for use in all parts of the expression.
    planted = F.transform(F.array(packed), lambda x: F.struct(
        x["w"].alias("w"), x["n"].alias("n"), (x["g"] % x["n"]).cast("int").alias("a"), x["g"].alias("g")))
    planted = F.transform(planted, lambda x: F.struct(
        x["w"].alias("w"), x["n"].alias("n"), x["a"].alias("a"), (1 + F.floor((x["n"] - x["a"]) / (3 + x["g"] % 8))).cast("int").alias("p")))
    tail = F.transform(planted, lambda x: F.array_join(F.transform(
        F.sequence(F.lit(0), x["n"] - 1),
        lambda i: F.get(x["w"], F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]))), " "))
    return F.when((h % 10 == 0) & doc_id.isNotNull() & text.rlike(r"[^\x20\x09-\x0D]"), F.get(tail, F.lit(0))).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", with_planted_tail(F.col("doc_id"), F.col("text")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return periodic_runs(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
