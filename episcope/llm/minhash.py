"""MinHash near-dedup by fast similarity sketching.

**Sketch** (``sketches``).  A document's set is its distinct word shingles
(words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document with fewer
words than a shingle has is one shingle).  A sketch has ``size`` coordinates,
filled in rounds: in round i < size every shingle is placed in a hashed bin
with the value i + hash; in round size + j every shingle goes to bin j.  A bin
keeps its least value, so bins filled in an early round keep it, rounds stop
once all bins are filled, and after 2 * size rounds none is empty.  The share
of equal coordinates estimates the Jaccard similarity with the concentration
of independent hashing, in time n + size log size.

**Bands.**  ``rows`` coordinates make a band.  A pair at the threshold is
missed by all 40 bands of 5 rows with probability (1 - 0.8**5)**40 = 1e-7.

**Equal sets** form classes first; only the class's smallest id goes on.

**Links.**  Bands with two or more classes are buckets.  In the first round
each class of a bucket is compared only with the bucket's centre, the class
that has most company over all its buckets, and components are drawn from the
confirmed links.  In the second round the buckets that still hold different
components are compared in chunks: their classes are dealt, by the centre they
know, into chunks of at most ``CHUNK_ROWS`` rows or about ``CHUNK_BYTES`` of
text, those already tied to the centre apart from the rest, and a task compares
two chunks that meet in a bucket by the intersections of all their sets.  So a group of copies costs one
comparison per copy; chunks of one component are never compared with each
other (a link inside a component changes nothing); no pairs of documents are
made, only pairs of chunks; and no link is lost.  What is left after the first
round (near copies of a family that fall below the threshold to its centre)
costs the product of their number and the family's.  Every comparison
intersects the full shingle sets of both texts.

Nulls, empty texts: no shingle, linked with nothing, a component of their own.
Rows that repeat an id count as one document with the greatest text of that
id (one row per id comes back from ``near_duplicates``); rows with a null id
come back with a null component and are kept: each by itself with
``null_rows``, as in the query, else as one row.  An empty table gives an empty
result.  Extra input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_table
from .graph import components
from .hashing import column_bytes, mix, word_hashes, word_spans

BANDS, ROWS = 40, 5
_U = np.uint64


def shingle_sets(column, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text its sorted distinct shingle hashes, concatenated, and n+1 offsets."""
    raw, offsets = column_bytes(column)
    starts, ends, at = word_spans(raw, offsets)
    w = word_hashes(raw, starts, ends, lower=True)
    full = np.zeros(len(w), dtype=np.uint64)
    for k in range(min(words, len(w))):
        full[:len(w) - k] += w[k:] * _U((0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64))
    full = mix(full)
    sets = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= words:
            sets.append(np.unique(full[a:b - words + 1]))
        elif b > a:  # the whole sequence, with its length, as one
            h = (w[a:b] * (_U(2) * np.arange(b - a, dtype=np.uint64) + _U(3))).sum(dtype=np.uint64) + _U(b - a)
            sets.append(mix(np.array([h], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    sizes = np.cumsum([0, *(len(s) for s in sets)])
    return (np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)), sizes


def fill(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The sketches of the sets ``values[at[k]:at[k+1]]`` (none empty), one row each."""
    n = len(at) - 1
    out = np.full(n * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    todo = np.arange(n)
    counts = np.diff(at)
    elems, owner = values, np.repeat(np.arange(n), counts)
    for i in range(2 * size):
        h = mix(elems + _U((0xD6E8FEB86659FD93 * (i + 1)) % (1 << 64)))
        bins = ((h >> _U(40)) * _U(size)) >> _U(24) if i < size else np.full(len(h), i - size, dtype=np.uint64)
        value = (_U(i) << _U(40)) | (h & _U((1 << 40) - 1))  # an earlier round is always less
        slot = owner * size + bins.astype(np.int64)
        np.minimum.at(out, slot, value)
        open_ = (out.reshape(n, size)[todo] == np.iinfo(np.uint64).max).any(axis=1)
        if not open_.any():
            break
        if not open_.all():
            todo = todo[open_]
            left = np.zeros(n, dtype=bool)
            left[todo] = True
            keep = left[owner]
            elems, owner = elems[keep], owner[keep]
    return out.reshape(n, size)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketch[:, :bands * rows].reshape(len(sketch), bands, rows)
    k = np.zeros(parts.shape[:2], dtype=np.uint64)
    for r in range(rows):
        k = mix(k + parts[:, :, r] * _U(0x9E3779B97F4A7C15) + _U(r + 1))
    return mix(k + np.arange(1, bands + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F))


def sketches(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text",
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b: a 128-bit name of the set, keys: its band keys)."""

    def one(batches):
        for batch in batches:
            for part in _slices(batch, text_col):
                values, at = shingle_sets(part.column(text_col), words)
                n = np.diff(at)
                full = np.flatnonzero(n)
                keys = band_keys(fill(values, np.append(at[full], at[-1]), bands * rows), bands, rows)
                sums = [np.concatenate([[_U(0)], np.cumsum(mix(values + _U(c)), dtype=np.uint64)]) for c in (11, 23)]
                name = [(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums]
                ends = np.zeros(len(n) + 1, dtype=np.int32)
                ends[1:] = np.cumsum(np.where(n > 0, bands, 0))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(id_col).cast(pa.int64()), "n_shingles": pa.array(n, pa.int64()),
                    "set_a": pa.array(name[0]), "set_b": pa.array(name[1]),
                    "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel()))})

    return (docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
            .mapInArrow(one, "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>"))


def _slices(batch: pa.RecordBatch, text_col: str, most: int = 2 << 20):
    """The batch in slices of about ``most`` bytes of text."""
    offsets = column_bytes(batch.column(text_col))[1]
    part = offsets[1:] // most
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))

    def verify(batches):
        for whole in batches:
            for batch in _slices(whole, "text_a"):
                va, ia = shingle_sets(batch.column("text_a"), words)
                vb, ib = shingle_sets(batch.column("text_b"), words)
                ok = np.zeros(batch.num_rows, dtype=bool)
                for k in range(batch.num_rows):
                    x, y = va[ia[k]:ia[k + 1]], vb[ib[k]:ib[k + 1]]
                    both_ = len(x) + len(y)
                    same = both_ - len(np.unique(np.concatenate([x, y])))
                    ok[k] = both_ > 0 and 100 * same >= percent * (both_ - same)
                keep = pa.array(ok)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


CHUNK_ROWS, CHUNK_BYTES = 256, 1 << 20


def chunk_links(tied: DataFrame, comp: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between different components that meet in a bucket; per chunk pair only those that join something new."""
    placed = (tied.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .withColumn("comp", F.coalesce("comp", "doc_id")))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("key")
    apart = materialize(placed.join(mixed, "key").select("key", "doc_id", "comp", "centre"), "apart")
    # Each class goes to the least centre it knows; with it the classes of the centre's component are dealt apart.
    home = apart.groupBy("doc_id", "comp").agg(F.min("centre").alias("centre"))
    own = comp.select(F.col("node").alias("centre"), F.col("comp").alias("of_centre"))
    inside = F.col("comp") == F.coalesce("of_centre", "centre")
    rows = (home.join(own, "centre", "left")
            .select("doc_id", "comp", "centre", inside.alias("inside"), F.when(inside, F.col("comp")).otherwise(0).alias("main"))
            .join(texts.select(F.col("id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), "doc_id"))
    group = ["centre", "inside", "main"]
    parts = rows.groupBy(*group).agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / CHUNK_ROWS, F.sum(F.octet_length("text")) / CHUNK_BYTES, F.lit(1))).alias("parts"))
    chunks = materialize(
        rows.join(parts, group).groupBy(*group, F.pmod(F.xxhash64("doc_id"), "parts").alias("part"))
        .agg(F.min("doc_id").alias("chunk"), F.collect_list("doc_id").alias("ids"), F.collect_list("comp").alias("comps"),
             F.collect_list("text").alias("texts"))
        .select("chunk", F.when(F.col("inside"), F.col("main")).alias("main"), "ids", "comps", "texts"), "chunks")
    where = chunks.select("chunk", "main", F.explode("ids").alias("doc_id"))
    meets = apart.select("key", "doc_id").join(where, "doc_id").select("key", "chunk", "main").distinct()
    x = meets.select("key", F.col("chunk").alias("x"), F.col("main").alias("main_x"))
    y = meets.select("key", F.col("chunk").alias("y"), F.col("main").alias("main_y"))
    pairs = (x.join(y, "key").where("x <= y and not coalesce(main_x = main_y, false)").select("x", "y").distinct())
    side = lambda s: chunks.select(F.col("chunk").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "comps", "texts")])

    def compare(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                a, b = _chunk_pair(row, words, percent)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return pairs.join(side("x"), "x").join(side("y"), "y").drop("x", "y").mapInArrow(compare, "a long, b long")


def _chunk_pair(row: dict, words: int, percent: int) -> tuple[list[int], list[int]]:
    ids, comps, sets = {}, {}, {}
    for s in "xy":
        ids[s], comps[s] = (np.array(row[f"{c}_{s}"].as_py(), dtype=np.int64) for c in ("ids", "comps"))
        sets[s] = shingle_sets(row[f"texts_{s}"].values, words)
    same = intersections(*sets["x"], *sets["y"])
    nx, ny = np.diff(sets["x"][1]), np.diff(sets["y"][1])
    linked = (100 * same >= percent * (nx[:, None] + ny[None, :] - same)) & (same > 0) & (comps["x"][:, None] != comps["y"][None, :])
    a, b, seen = [], [], {}

    def find(c):
        while seen.setdefault(c, c) != c:
            c = seen[c]
        return c

    for i, j in zip(*np.nonzero(linked)):  # links that join components not yet joined in this pair of chunks
        p, q = find(comps["x"][i]), find(comps["y"][j])
        if p != q:
            seen[max(p, q)] = min(p, q)
            a.append(int(ids["x"][i]))
            b.append(int(ids["y"][j]))
    return a, b


def intersections(va: np.ndarray, ia: np.ndarray, vb: np.ndarray, ib: np.ndarray, width: int = 1 << 13) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of another, by blocks of shared values."""
    common = np.intersect1d(va, vb)
    out = np.zeros((len(ia) - 1, len(ib) - 1), dtype=np.float32)
    sides = []
    for v, i in ((va, ia), (vb, ib)):
        at = np.searchsorted(common, v)
        hit = (at < len(common)) & (common[np.minimum(at, len(common) - 1)] == v) if len(common) else np.zeros(len(v), dtype=bool)
        owner = np.repeat(np.arange(len(i) - 1), np.diff(i))[hit]
        order = np.argsort(at[hit], kind="stable")
        sides.append((at[hit][order], owner[order], len(i) - 1))
    for low in range(0, len(common), width):
        dense = []
        for at, owner, n in sides:
            s, e = np.searchsorted(at, (low, low + width))
            m = np.zeros((n, min(width, len(common) - low)), dtype=np.float32)
            m[owner[s:e], at[s:e] - low] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return np.rint(out).astype(np.int64)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", bands: int = BANDS, rows: int = ROWS, null_rows: bool = False) -> DataFrame:
    """One row per id: doc_id, n_shingles, component_id (smallest id reachable), kept.

    With ``null_rows`` every row without an id is a document of its own; else they fold into one row.
    """
    every = materialize(sketches(docs, words, id_col, text_col, bands, rows), "sketches")
    solid = F.col("n_shingles") > 0
    same = ["n_shingles", "set_a", "set_b"]
    classes = every.where(solid & F.col("doc_id").isNotNull()).groupBy(*same).agg(F.min("doc_id").alias("rep"))
    keyed = (every.where(solid).join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
             .select("doc_id", "n_shingles", F.explode("keys").alias("key")))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n_in")).where("n_in > 1")
    buckets = materialize(keyed.join(shared, "key"), "buckets")  # key, doc_id, n_shingles, n_in
    company = buckets.groupBy("doc_id").agg(F.sum("n_in").alias("company"))
    centres = (buckets.join(company, "doc_id").groupBy("key")
               .agg(F.max(F.struct("company", (-F.col("doc_id")).alias("id"), "n_shingles")).alias("top"))
               .select("key", (-F.col("top.id")).alias("centre"), F.col("top.n_shingles").alias("n_centre")))
    tied = materialize(buckets.drop("n_in").join(centres, "key"), "tied")

    fits = 100 * F.least("n_shingles", "n_centre") >= percent * F.greatest("n_shingles", "n_centre")
    stars = (tied.where("doc_id != centre").where(fits)
             .select(F.least("centre", "doc_id").alias("a"), F.greatest("centre", "doc_id").alias("b")).distinct())
    texts = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
                        .join(tied.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi"), "texts")
    links = materialize(confirmed(stars, texts, words, percent), "links")
    comp = materialize(components(links), "components")
    more = materialize(chunk_links(tied, comp, texts, words, percent), "links")
    final = materialize(components(links.unionByName(more)), "components")

    rep = classes.join(final, classes["rep"] == final["node"], "left").select(*same, F.coalesce("comp", "rep").alias("comp"))
    named = every.where(F.col("doc_id").isNotNull()) if null_rows else every
    one = named.groupBy("doc_id").agg(F.max(F.struct(*same)).alias("s")).select("doc_id", "s.*")
    out = one.join(rep, same, "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")))
    out = out.select("doc_id", "n_shingles", "component_id",
                     F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    if not null_rows:
        return out
    nameless = every.where(F.col("doc_id").isNull())
    return out.unionByName(nameless.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=80, null_rows=True)
