"""Spelling variant grouping: dense prefix-suffix tiling over padded code-point matrices.

**Words** are counted where the texts are read: whole texts are cut into runs of
letters, counts are combined in tasks (at most ``HELD`` words at a time) and
summed by Spark.

**Near words** differ by exactly one inserted, deleted or replaced code point.
For two different words of lengths s <= m with m - s <= 1 that is so exactly if
their common prefix and common suffix together reach m - 1 code points.  A tile
compares a block of words with another: both are code-point matrices, padded
with numbers that match nothing, once aligned at the left and once at the
right; column by column, all pairs of the two blocks at a time, prefix and
suffix lengths grow while the columns agree.

**Which tiles.**  The agreeing m - 1 code points lie on two sides, so one side has
at least half of them: near words share their first or their last ``s // 2``
code points.  A word of length m goes to the four groups (s, first half), (s,
last half) of s = m and s = m - 1, and only meets the words of its groups; a
pair belongs to the group of its shorter length, and to the group of last
halves only if the first halves differ, so every pair is found once.
Groups are dealt out by key and met in order, many small ones in one tile.  A
group of more than ``GROUP`` words is dealt as pairs of blocks (by the words'
hashes), each pair in a place of its own: no task holds more than two blocks of
one group.  Only near pairs leave a tile, and a word of length m has at most
2 * m + 1 places times the letters of them.

**Forms.**  A word's form is its near word of largest count (ties: the smallest
in code-point order) where that is at least ``ratio`` times its own; roots
follow forms to the last by doubling the steps, as often as the logarithm of
the longest possible chain asks for (counts grow ``ratio``-fold a step).

Defined cases: null and empty texts have no runs; a null id's planted edits use
the empty text as id; repeated rows count again; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_table, shuffle_partitions

LETTERS = r"[A-Za-zÀ-ÿ]"
HELD, BATCH_CHARS = 200_000, 1 << 20
GROUP, ROWS, TILE = 4096, 16_384, 256


# ---------------------------------------------------------------- counting

def planted_edit(doc_id: str, run: str) -> str:
    """The contract's text: the run, less one code point where crc32 of ``doc_id:run`` is a multiple of 199."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % 199:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = LETTERS, min_length: int = 6,
                min_count: int = 5, edit: Callable[[str, str], str] | None = None) -> DataFrame:
    """(word, n): maximal runs of ``letters``, A-Z lower-cased, that have ``min_length`` code points or more (after
    ``edit``, which gets the row's id and the run, and may drop one) and occur ``min_count`` times or more."""

    def count(batches):
        run = re.compile(f"{letters}{{{min_length},}}")
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Counter(run.findall((text or "").encode().lower().decode()))  # bytes lower A-Z only
                if edit is None:
                    held.update(found)
                else:
                    name = "" if i is None else i
                    for w, n in found.items():
                        w = edit(name, w)
                        if len(w) >= min_length:
                            held[w] += n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    source = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return (source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# ---------------------------------------------------------------- tiles

def _matrix(words: list[str], width: int, right: bool, pad: int) -> np.ndarray:
    """Code points of the words, one row each, aligned at the left or right, the rest ``pad``."""
    filled = "".join(w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words)
    codes = np.frombuffer(filled.encode("utf-32-le"), dtype=np.uint32).reshape(len(words), width)
    out = codes.astype(np.int32)
    out[codes == 0] = pad
    return out.T.copy()  # one row a column of text: tiles read columns


def _shared(a: np.ndarray, b: np.ndarray, columns: range) -> np.ndarray:
    """For all pairs the number of leading agreeing columns."""
    same = np.ones((a.shape[1], b.shape[1]), dtype=bool)
    total = np.zeros(same.shape, dtype=np.int16)
    for c in columns:
        same &= a[c][:, None] == b[c][None, :]
        if not same.any():
            break
        total += same
    return total


class _Words:
    """The words of some groups, in order of group, as matrices."""

    def __init__(self, words: list[str], group: np.ndarray, short: np.ndarray, last: np.ndarray, side: np.ndarray):
        self.group, self.short, self.last, self.side = group, short, last, side
        self.size = np.array([len(w) for w in words])
        width = int(self.size.max())
        # Pads differ on the two sides of a comparison, so that they never match.
        self.heads = [_matrix(words, width, False, pad) for pad in (-1, -2)]
        self.tails = [_matrix(words, width, True, pad) for pad in (-1, -2)]
        self.width = width

    def near(self, a: slice, b: slice) -> tuple[np.ndarray, np.ndarray]:
        """The near pairs of block a and block b (places, the first before the second)."""
        size_a, size_b = self.size[a][:, None], self.size[b][None, :]
        fit = (self.group[a][:, None] == self.group[b][None, :]) & (np.abs(size_a - size_b) <= 1)
        fit &= (np.minimum(size_a, size_b) == self.short[a][:, None]) & ((self.side[a][:, None] != self.side[b][None, :]) | (self.side[a] == 0)[:, None])
        if a == b:
            fit &= np.triu(np.ones(fit.shape, dtype=bool), 1)
        if not fit.any():
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        prefix = _shared(self.heads[0][:, a], self.heads[1][:, b], range(self.width))
        suffix = _shared(self.tails[0][:, a], self.tails[1][:, b], range(self.width - 1, -1, -1))
        fit &= prefix + suffix >= np.maximum(size_a, size_b) - 1
        fit &= (self.last[a] == 0)[:, None] | (prefix < (self.short[a] // 2)[:, None])  # else the first halves' group has it
        i, j = np.nonzero(fit)
        return i + a.start, j + b.start


def _near_pairs(words: list[str], group: np.ndarray, short: np.ndarray, last: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The near pairs inside the groups; words come in order of group."""
    held = _Words(words, group, short, last, side)
    n, left, right = len(words), [], []
    blocks = [slice(k, min(k + TILE, n)) for k in range(0, n, TILE)]
    for x, a in enumerate(blocks):
        for b in blocks[x:]:
            if group[a.stop - 1] != group[b.start] and a != b:
                break  # the last group of a ends before b, and so do all others
            i, j = held.near(a, b)
            left.append(i)
            right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _gather(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows in order, in tables of whole groups (column ``key``) of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table["key"]
        ends = np.flatnonzero(keys[1:].to_numpy(zero_copy_only=False) != keys[:-1].to_numpy(zero_copy_only=False)) if size > 1 else []
        cut = int(ends[-1]) + 1 if len(ends) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        size -= cut
    if size:
        yield pa.Table.from_batches(held)


def near_words(words: DataFrame, group_words: int = GROUP) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of near words of (word, n), once.  Words are distinct."""
    spark = words.sparkSession
    size = F.char_length("word")
    half = lambda s: F.floor(s / 2).cast("int")
    places = []
    for s in (size, size - 1):
        places += [F.struct(s.alias("short"), F.lit(0).alias("last"), F.substring("word", F.lit(1), half(s)).alias("part")),
                   F.struct(s.alias("short"), F.lit(1).alias("last"), F.substring("word", size - half(s) + 1, half(s)).alias("part"))]
    rows = words.select("word", "n", F.explode(F.array(*places)).alias("g")).select("word", "n", "g.*").where("short > 0")
    keys = ["short", "last", "part"]
    # Groups too large for one task, with the number of blocks each is cut into.
    hot = (rows.groupBy(*keys).count().where(F.col("count") > group_words)
           .select(*keys, F.ceil(F.col("count") / (group_words // 2)).cast("int").alias("cuts")))
    rows = rows.join(materialize(hot, "large_groups"), keys, "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")
    # A word meets block k in the place (smaller block, larger block); ``side`` keeps pairs of one block to that block's own place.
    rows = (rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
            .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
            .withColumn("side", F.when(F.col("low") == F.col("high"), 0).when(F.col("own") == F.col("low"), 1).otherwise(2))
            .withColumn("key", F.concat_ws("/", *keys, "low", "high")))

    def compare(batches):
        for table in _gather(batches, ROWS):
            found = table["word"].to_pylist()
            key = table["key"].combine_chunks()
            group = np.cumsum(np.concatenate([[False], key[1:].to_numpy(zero_copy_only=False) != key[:-1].to_numpy(zero_copy_only=False)]))
            i, j = _near_pairs(found, group, table["short"].to_numpy(), table["last"].to_numpy(), table["side"].to_numpy())
            one, other = np.concatenate([i, j]), np.concatenate([j, i])
            for k in range(0, len(one), 100_000):
                x, y = pa.array(one[k:k + 100_000]), pa.array(other[k:k + 100_000])
                a, b = table.select(["word", "n"]).take(x).combine_chunks(), table.select(["word", "n"]).take(y).combine_chunks()
                for batch in pa.table({"word": a["word"], "n": a["n"], "near": b["word"], "near_n": b["n"]}).to_batches():
                    yield batch

    return (rows.select("key", "word", "n", "short", "last", "side").repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")
            .mapInArrow(compare, "word string, n long, near string, near_n long"))


# ---------------------------------------------------------------- forms

def variants(words: DataFrame, ratio: int = 5, group_words: int = GROUP) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the distinct words and counts (word, n)."""
    words = materialize(words.select("word", "n"), "words")
    top = words.agg(F.max("n").alias("n")).first().n or 1
    best = (near_words(words, group_words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    known = words.join(best, "word", "left").withColumn("leads", -F.col("best.less") >= F.col("n") * ratio)
    known = materialize(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("leads"), F.col("best.near")).alias("form"),
                                     F.when(F.col("leads"), -F.col("best.less")).alias("form_n")), "forms")
    steps = max(1, math.ceil(math.log(top, ratio))) if ratio > 1 else 64
    roots = known.where("form is not null").select("word", F.col("form").alias("root"))
    for k in range(max(1, steps.bit_length())):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"roots{k}")
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = variants(word_counts(docs, edit=planted_edit))
    return found.select("word", "form", "root", "n", F.col("n_near").cast("long").alias("n_near"), "form_n")
