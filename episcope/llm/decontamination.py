"""Benchmark decontamination: a prefix-filtered set join of shingles, verified on whole windows.  DataFrame functions only.

A *window* is ``window`` consecutive words of a benchmark item (an item of
fewer words, but not none, is one window).  A document word inside any
occurrence of a window is hit.  Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
after lower-casing A-Z.

A window occurs only where all its shingles of ``shingle`` words do (containment
of 1), so one *necessary prefix token* a window is enough: its rarest shingle.

1. **Rarity.**  One pass counts how often each shingle of the benchmark occurs
   in all documents (map-side combined).  A window with a shingle that occurs
   nowhere can't occur and leaves; of the others the rarest shingle is the anchor.
2. **Join.**  A second pass joins the documents' shingles with the anchors.  The
   anchor's place in the window gives the window's start; it and the window's
   length must lie inside the document (positional and length bounds).
3. **Verify.**  The words under the window are compared with the window, whole.
   All this happens where the document is read; only occurrences, and one base
   row a document, are shuffled.
4. Occurrences become maximal spans and, over the windows' items, item lists.

The benchmark's shingles and anchors are broadcast in slices of at most
``slice_rows`` rows, counted before; a larger benchmark takes more slices (one
more pass over the documents each) and no more memory.  A passage that a third
of all documents share costs its occurrences, spread with the documents.

Defined cases: null and empty texts have no words, and such items no windows;
a null item id is never listed (its windows hit); item ids that repeat are one
item; rows that repeat a document id, or have none, are handled one by one;
other columns are not read; empty tables on either side leave every document
clean, or no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_table

WINDOW, SHINGLE, SLICE_ROWS = 10, 4, 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = 0  # the hash of every document's base row; a shingle of that hash fails the check of positions


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does it where no other letter has a lower case."""
    cased = r"[^\x00-\xBF\xD7\xDF-\xFF\u2000-\u20CF\u3040-\u9FFF\uAC00-\uD7A3]"
    return F.when(text.rlike(cased), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """The words of a text (null: none)."""
    found = F.array_remove(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _shingles(w: Column, n: Column, k: int) -> Column:
    """The hashes of the runs of ``k`` words at positions 0 to n - 1 (null where none fits)."""
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.when(i + k <= n, F.xxhash64(F.lit(k), *(w[i + j] for j in range(k)))))


def _item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (item, window, length), a window as its words joined by spaces."""
    split = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), words(F.col(f"`{text}`")).alias("w")).withColumn("n", F.size("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.col("n") - window + 1, F.lit(1)))
    each = F.transform(starts, lambda s: F.array_join(F.slice("w", s, F.lit(window)), " "))
    return (split.where("n > 0").select("item", F.least("n", F.lit(window)).alias("length"), F.explode(each).alias("window"))
            .distinct())


def _slices(rows: DataFrame, slice_rows: int) -> list[DataFrame]:
    """``rows`` (with a hash ``h``) in slices small enough to be broadcast."""
    n = max(1, -(-rows.count() // slice_rows))
    return [rows.where(F.pmod("h", F.lit(n)) == s) for s in range(n)]


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_hit (words), spans (maximal hit runs as start, stop) and
    items (ids, as sorted strings, of the items with an occurring window)."""
    members = materialize(_item_windows(items, item_id, item_text, window), "item_windows")
    distinct = members.select("window", "length").distinct()
    sizes = [r.k for r in distinct.select(F.least("length", F.lit(shingle)).alias("k")).distinct().orderBy("k").collect()]

    def read(w: Column) -> Column:
        """A document's words, their number and one list of hashes: the base row's, then n for each size of shingle."""
        n = F.size(w)
        return F.struct(w.alias("w"), n.alias("n"), F.concat(F.array(F.lit(_BASE).cast("long")), *[_shingles(w, n, k) for k in sizes]).alias("hashes"))

    # Exploding one struct a document splits its text once; the explode of the hashes, the join and the check of a window are
    # generated code over that row.
    split = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.transform(F.array(words(F.col(f"`{text_col}`"))), read)).alias("doc"))
    split = split.select(F.monotonically_increasing_id().alias("rid"), "id", "doc.*")

    own = F.when(F.lit(False), F.array().cast("array<long>"))
    for k in sizes:
        own = own.when(F.least("length", F.lit(shingle)) == k, _shingles(F.split("window", " "), F.col("length"), k))
    parts = materialize(distinct.select("window", "length", F.posexplode(own).alias("offset", "h")).where("h is not null"), "window_shingles")

    # 1. how often each shingle of the benchmark occurs
    scan = split.select(F.explode("hashes").alias("h"))
    counts = [scan.join(F.broadcast(s), "h").groupBy("h").count() for s in _slices(parts.select("h").distinct(), slice_rows)]
    rarity = reduce(DataFrame.unionByName, counts)
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "h", "offset")).alias("rarest")
    anchors = (parts.join(rarity, "h", "left").groupBy("window", "length").agg(rarest).where("rarest.count > 0")
               .select("window", "length", "rarest.h", "rarest.offset"))
    anchors = materialize(anchors, "window_anchors")

    # 2., 3. occurrences, and one base row a document
    base = anchors.sparkSession.createDataFrame([(None, 0, _BASE, 0)], anchors.schema)
    scan = split.select("rid", "id", "n", "w", F.posexplode("hashes").alias("place", "h"))
    start = F.when(F.col("place") > 0, (F.col("place") - 1) % F.when(F.col("n") > 0, F.col("n"))) - F.col("offset")
    whole = F.array_join(F.slice("w", F.col("start") + 1, F.col("length")), " ") == F.col("window")
    found = []
    for k, part in enumerate(_slices(anchors, slice_rows)):
        # The first slice also answers with the base rows.
        found.append(scan.join(F.broadcast(part.unionByName(base) if k == 0 else part), "h").withColumn("start", start)
                     .where(F.when(F.col("window").isNull(), F.col("place") == 0)
                            .otherwise((F.col("place") > 0) & (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n")) & whole))
                     .select("rid", "id", "n", "window", F.when(F.col("window").isNotNull(), F.col("start")).alias("start"),
                             F.when(F.col("window").isNotNull(), F.col("start") + F.col("length")).alias("stop")))
    hits = materialize(reduce(DataFrame.unionByName, found), "window_hits")

    # 4. maximal spans, items
    line = Window.partitionBy("rid").orderBy("start", "stop")
    reach = F.max("stop").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("start").isNotNull() & (reach.isNull() | (F.col("start") > reach))
    spans = (hits.withColumn("opens", opens.cast("int")).withColumn("span", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("rid", "span").agg(F.max("id").alias("id"), F.max("n").alias("n"), F.min("start").alias("start"), F.max("stop").alias("stop"))
             .groupBy("rid").agg(F.max("id").alias("id"), F.max("n").alias("n"), F.sum(F.col("stop") - F.col("start")).alias("n_hit"),
                                 F.array_sort(F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", "stop")))).alias("spans")))
    named = members.where("item is not null").select("window", "item")
    if named.count() <= slice_rows:
        named = F.broadcast(named)
    listed = (hits.where("window is not null").select("rid", "window").distinct().join(named, "window")
              .groupBy("rid").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return spans.join(listed, "rid", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "spans",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP12_SQL = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
i as (select distinct item_id, least(len(w), {WINDOW}) as size,
             array_to_string(w[unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)):][:{WINDOW}], ' ') as win
      from b where len(w) > 0),
s as (select distinct size from i),
p as (select rid, size, unnest(range(1, len(w) - size + 2)) as pos,
             unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as win
      from d, s),
o as (select distinct p.rid, p.pos, p.size, i.item_id from p join i on i.size = p.size and i.win = p.win),
h as (select rid, count(distinct place) as n_hit from (select rid, unnest(range(pos, pos + size)) as place from o) group by rid),
n as (select rid, count(*) as n_items, string_agg(name, ',' order by name) as names
      from (select distinct rid, cast(item_id as varchar) as name from o where item_id is not null) group by rid)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n.n_items, 0) as bigint) as n_items, sha256(coalesce(n.names, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from d left join h using (rid) left join n using (rid)
"""
