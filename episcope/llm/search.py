"""Exact top-k search: an inverted index per shard, pruned by block maxima, with global BM25 statistics.

Documents are packed into shards (about ``shard_bytes`` of text).  A task turns
a shard into an inverted index of term frequencies; its documents are ordered
by their commonest terms, so that a block of 32 neighbours is of one kind, and
each common term keeps its greatest weight in every block.  Queries are packed
in chunks, once, in the same kind of order, and meet a shard in batches.  The
postings of rare terms are added up; with them, the maxima of the common terms give
an upper bound per block, and blocks whose bound is below the k-th score held are left
out (block-max WAND with blocks as pivots).  Queries that keep the same blocks
are scored together in these blocks alone: terms that many of them ask for as a
matrix product, the others posting by posting, in single precision.  Documents
whose sum, with its greatest error, may reach the k-th score are scored again in
whole numbers, and only these scores count.

The k-th scores pass from shard to shard of a lane.  A few lanes are searched
first; the k-th score that a query has there is where the other lanes start.
All lanes' lists are merged by score.

Document frequencies, the number of documents and their mean length come from
all documents, so every shard scores as one index would.  A term's weight is
``round(idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean)) * 10**6)``
with ``idf = ln(1 + (N - df + 0.5) / (df + 0.5))``; scores are sums of these whole
numbers, so they don't depend on the order of summation.  Terms are words
``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; each distinct word of a query counts once.

Every query meets every shard once, on a grid: shards are dealt into lanes of
about ``lane_bytes``, chunks of queries (about ``chunk_bytes`` of terms) into parts of about
``query_bytes``, both as packed, and a task has one lane and one part at a time, whatever the
number of either.  What is shuffled is every lane's shards once a part and every chunk once a lane.

Defined cases: null and empty texts match nothing and count as documents of
length 0; ties go to the smaller id (null ids last); rows that repeat an id are
ranked one by one, and queries that repeat an id are answered once, by all
their words; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import give_back, read_table
from .hashing import column_bytes, word_hashes, word_spans
from .repeats import _pack, _unpack, blocks

K1, B, SCALE, BLOCK = 1.2, 0.75, 1_000_000, 32
#: Terms of a shard that have a column in its matrix: so many at most, each in more than one of RARE documents; and the most cells of the matrix.
COMMON, RARE, CELLS = 2048, 32, 1 << 22
#: Scores and query terms of a batch of queries, queries of a product, and postings added at a time.
SCORES, BATCH, GROUP, POSTINGS = 1 << 21, 1 << 19, 128, 1 << 18
#: Cells of a product that cost as much as one posting.
DENSE = 256
#: Documents whose words are found at a time.
SLICE = 256
#: Terms of documents that are counted together before they are moved.
TERMS = 1 << 21
#: The least score above none.
TINY = np.float32(1e-30)


def _words(column):
    raw, offsets = column_bytes(column)
    starts, ends, at = word_spans(raw, offsets)
    return word_hashes(raw, starts, ends, lower=True).view(np.int64), at


def _distinct(column) -> tuple[np.ndarray, np.ndarray, int]:
    """Per text its distinct words (concatenated), and the text of each; the number of all words."""
    words, at = _words(column)
    parts = [np.unique(words[a:b]) for a, b in zip(at, at[1:])]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else words), owner, len(words)


def term_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df, words): document frequencies; the null term has the numbers of documents and of words."""

    def summed(pieces, texts: int, size: int) -> pa.RecordBatch:
        terms, df = np.unique(np.concatenate(pieces), return_counts=True)
        return pa.RecordBatch.from_pydict({
            "term": pa.concat_arrays([pa.array(terms), pa.array([None], pa.int64())]),
            "df": pa.array(np.append(df, texts), pa.int64()),
            "words": pa.array(np.append(np.zeros(len(terms), dtype=np.int64), size), pa.int64())})

    def count(batches):
        pieces, texts, size = [], 0, 0
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                column = batch.column(text_col).slice(a, 500)
                found, _, number = _distinct(column)
                pieces, texts, size = [*pieces, found], texts + len(column), size + number
                if sum(map(len, pieces)) >= TERMS:
                    yield summed(pieces, texts, size)
                    pieces, texts, size = [], 0, 0
        if texts:
            yield summed(pieces, texts, size)

    return (docs.select(F.col(f"`{text_col}`")).mapInArrow(count, "term long, df long, words long")
            .groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words")))


class Asked:
    """Some queries: ``sizes`` terms each, which are numbers of the ``known`` terms (ascending)."""

    def __init__(self, ids, sizes: np.ndarray, known: np.ndarray, idf: np.ndarray, term: np.ndarray):
        self.ids, self.sizes, self.known, self.idf, self.term = ids, sizes, known, idf, term
        self.query = np.repeat(np.arange(len(sizes)), sizes)

    @staticmethod
    def pack(queries: pa.Table) -> bytes:
        """(query_id, terms, dfs) as stored; neighbours have their commonest terms in common."""
        lists, df = queries["terms"].combine_chunks(), queries["dfs"].combine_chunks().flatten().to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        known, heads, term = np.unique(lists.flatten().to_numpy(), return_index=True, return_inverse=True)
        df, n = df[heads], len(sizes)
        ends = np.cumsum(sizes)
        order = np.lexsort(_kinds(np.repeat(np.arange(n), sizes), term, df, sizes))
        own, _ = _ranges((ends - sizes)[order], ends[order], order)
        return _pack(pa.table({"known": pa.array([known], pa.list_(pa.int64())), "df": pa.array([df], pa.list_(pa.int64())),
                               "term": pa.array([term[own].astype(np.int32)], pa.list_(pa.int32())),
                               "size": pa.array([sizes[order].astype(np.int32)], pa.list_(pa.int32())),
                               "query_id": pa.array([queries["query_id"].combine_chunks().take(pa.array(order))], pa.list_(pa.int64()))}))

    @classmethod
    def unpack(cls, payload, n: int) -> Asked:
        table = _unpack(payload)
        known, df, term, size = (table[c].chunk(0).flatten().to_numpy() for c in ("known", "df", "term", "size"))
        return cls(table["query_id"].chunk(0).flatten(), size, known, np.log(1 + (n - df + 0.5) / (df + 0.5)), term)


class Index:
    """The inverted index of one shard."""

    def __init__(self, payload, id_col: str, text_col: str, mean: float):
        self._invert(_unpack(payload), id_col, text_col, mean)
        self._matrix()
        self._forward()

    def _invert(self, table: pa.Table, id_col: str, text_col: str, mean: float) -> None:
        # In slices: what finding the words takes is many times their text.
        pieces = [_words(table[text_col].slice(a, SLICE)) for a in range(0, table.num_rows, SLICE)]
        words = np.concatenate([w for w, _ in pieces]) if pieces else np.zeros(0, dtype=np.int64)
        sizes = np.concatenate([np.diff(at) for _, at in pieces]) if pieces else np.zeros(0, dtype=np.int64)
        n, pieces = len(sizes), None
        order = _order(words)
        ordered, words = words[order], None
        new = np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)]
        self.terms, ordered = ordered[new], None
        term, d, order = np.cumsum(new, dtype=np.int32), np.repeat(np.arange(n, dtype=np.int32), sizes)[order], None
        new[1:] |= d[1:] != d[:-1]
        heads = np.flatnonzero(new)
        term, d, tf = term[heads].astype(np.int64) - 1, d[heads].astype(np.int64), np.diff(np.append(heads, len(new)))
        by_kind = np.lexsort(_kinds(d, term, np.bincount(term), np.bincount(d, minlength=n)))
        place = np.empty(n, dtype=np.int64)
        place[by_kind] = np.arange(n)
        bits = int(tf.max(initial=0)).bit_length()
        packed = np.sort((term * max(n, 1) + place[d]) << bits | tf)
        tf = (packed & (1 << bits) - 1).astype(float)
        term, self.doc = np.divmod(packed >> bits, max(n, 1))
        self.gain = tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[by_kind][self.doc] / mean))
        self.ids = table[id_col].cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()[by_kind]
        self.blocks = (n + BLOCK - 1) // BLOCK
        self.first = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.term = term

    def _matrix(self) -> None:
        """The commonest terms' weights by document, and their greatest by block."""
        slots, counts = self.blocks * BLOCK, np.diff(self.first)
        common = np.argsort(-counts, kind="stable")[:min(COMMON, CELLS // max(slots, 1))]
        common = common[counts[common] * RARE > slots]
        self.counts = counts[common]
        self.column = np.full(len(self.terms), -1)
        self.column[common] = np.arange(len(common))
        rows, column = _ranges(self.first[common], self.first[common + 1], np.arange(len(common)))
        matrix = np.zeros((len(common), slots), dtype=np.float32)
        matrix[column, self.doc[rows]] = self.gain[rows]
        self.matrix = matrix.reshape(len(common), self.blocks, BLOCK)
        self.matrix_most = self.matrix.max(axis=2)

    def _forward(self) -> None:
        """The terms and weights of each document."""
        self.postings = self.doc.astype(np.int32), self.gain.astype(np.float32)
        order = _order(self.doc)
        self.own_terms, self.own_gains = self.term[order].astype(np.int32), self.gain[order]
        self.own = np.searchsorted(self.doc[order], np.arange(self.blocks * BLOCK + 1))
        self.number = np.zeros(len(self.terms), dtype=np.int32)
        del self.doc, self.gain, self.term

    def top(self, terms: np.ndarray, idf: np.ndarray, sizes: np.ndarray, k: int, least: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, scores) of the k best documents among those that score ``least`` or more.  A query has ``sizes`` of the terms."""
        known, heads, term = np.unique(terms, return_index=True, return_inverse=True)
        query, ids, scores = _best(*self.hits(Asked(None, sizes, known, idf[heads], term), k, least), k)
        cuts = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else []
        return [(int(query[a]), ids[a:b], scores[a:b]) for a, b in zip(cuts, [*cuts[1:], len(query)])]

    def hits(self, asked: Asked, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of all documents that may be among the k best of a query and score ``least`` or more."""
        if not len(self.terms) or not len(asked.known):
            return (np.zeros(0, dtype=np.int64),) * 3
        at = np.minimum(np.searchsorted(self.terms, asked.known), len(self.terms) - 1)
        at = np.where(self.terms[at] == asked.known, at, -1)[asked.term]
        here = np.flatnonzero(at >= 0)
        at, idf, query = at[here], asked.idf[asked.term[here]], asked.query[here]
        n, slots = len(asked.sizes), self.blocks * BLOCK
        owns = np.searchsorted(query, np.arange(n + 1))
        found, a, most = [], 0, max(1, SCORES // max(slots, 1024))
        while a < n:
            b = max(a + 1, min(a + most, int(np.searchsorted(owns, owns[a] + BATCH, side="right")) - 1))
            cut = slice(owns[a], owns[b])
            found += [(q + a, doc) for q, doc in self._batch(at[cut], idf[cut], query[cut] - a, asked.sizes[a:b], k, least[a:b])]
            a = b
        if not found:
            return (np.zeros(0, dtype=np.int64),) * 3
        asks, docs = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(asks, kind="stable")
        asks, docs = asks[order], docs[order]
        scores = self._exact(asks, docs, at, idf, owns)
        kept = scores >= np.maximum(least, 1)[asks]
        return asks[kept], self.ids[docs[kept]], scores[kept]

    def _scatter(self, scores: np.ndarray, query: np.ndarray, at: np.ndarray, idf: np.ndarray) -> None:
        """Adds the postings of each (query, term) to the queries' scores."""
        flat, (doc, gain) = scores.reshape(-1), self.postings
        size, low, row, idf = self.first[at + 1] - self.first[at], self.first[at], query * scores.shape[1], idf.astype(np.float32)
        ends, a = np.cumsum(size), 0
        shift = low - (ends - size)
        while a < len(size):
            start = ends[a] - size[a]
            b = max(a + 1, int(np.searchsorted(ends, start + POSTINGS, side="right")))
            rows = np.arange(start, ends[b - 1])
            rows += np.repeat(shift[a:b], size[a:b])
            cell = np.repeat(row[a:b], size[a:b])
            cell += doc.take(rows)
            weight = np.repeat(idf[a:b], size[a:b])
            weight *= gain.take(rows)
            np.add.at(flat, cell, weight)
            a = b

    def _batch(self, at: np.ndarray, idf: np.ndarray, query: np.ndarray, sizes: np.ndarray, k: int, least: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(query, document) of all that may be among the k best and score ``least``, by sums in single precision."""
        n, slots, column = len(sizes), self.blocks * BLOCK, self.column[at]
        # All weights are positive, so a sum differs by a share of itself (a rounding a term); whole numbers differ by half a unit a term.
        share, units = ((sizes + 16) * 2.0 ** -22)[:, None], ((sizes + 1) / SCALE)[:, None]
        floor = np.maximum(least[:, None] / SCALE * (1 - share) - units, TINY).astype(np.float32)
        common, rare = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
        scores = np.zeros((n, slots), dtype=np.float32)
        self._scatter(scores, query[rare], at[rare], idf[rare])
        used = np.flatnonzero(np.bincount(column[common], minlength=len(self.matrix)))
        number = np.empty(len(self.matrix), dtype=np.int64)
        number[used] = np.arange(len(used))
        place, asker = number[column[common]], query[common]
        weights = np.zeros((n, len(used)), dtype=np.float32)
        weights[asker, place] = idf[common]
        bound = np.maximum.reduceat(scores.reshape(-1), np.arange(0, n * slots, BLOCK)).reshape(n, self.blocks)
        bound += weights @ self.matrix_most[used]
        kept = bound >= floor * (1 - share)
        # Queries that keep the same blocks (with the same best one) are scored together, in those blocks alone.
        order = np.argsort(bound.argmax(axis=1), kind="stable")
        order = order[kept.any(axis=1)[order]]
        groups = [order[a:a + GROUP] for a in range(0, len(order), GROUP)]
        blocks = [np.flatnonzero(kept[group].any(axis=0)) for group in groups]
        # A column in a product costs as much as so many postings.
        dense = np.ones((len(groups) + 1, len(used)), dtype=bool)
        turn = np.full(n, len(groups))
        for i, (group, some) in enumerate(zip(groups, blocks)):
            turn[group] = i
            dense[i] = np.count_nonzero(weights[group], axis=0) * self.counts[used] * DENSE >= len(group) * len(some) * BLOCK
        some = np.flatnonzero(~dense[turn[asker], place])
        self._scatter(scores, asker[some], at[common[some]], idf[common[some]])
        found = []
        for i, (group, some) in enumerate(zip(groups, blocks)):
            columns = np.flatnonzero(dense[i])
            sums = weights[group[:, None], columns] @ self.matrix[used[columns, None], some].reshape(len(columns), len(some) * BLOCK)
            sums += scores.reshape(n, self.blocks, BLOCK)[group[:, None], some].reshape(len(group), -1)
            least_sum, free = floor[group], np.flatnonzero(least[group] <= 0)
            if len(free) and sums.shape[1] >= k:
                kth = np.partition(sums[free], sums.shape[1] - k, axis=1)[:, sums.shape[1] - k, None]
                least_sum[free] = np.maximum(kth * (1 - 2 * share[group[free]]) - 2 * units[group[free]], TINY)
            asked, doc = np.divmod(np.flatnonzero(sums >= least_sum), sums.shape[1])
            found.append((group[asked], some[doc // BLOCK] * BLOCK + doc % BLOCK))
        return found

    def _exact(self, asks: np.ndarray, docs: np.ndarray, at: np.ndarray, idf: np.ndarray, owns: np.ndarray) -> np.ndarray:
        """The scores, in whole numbers, of documents ``docs`` for queries ``asks`` (ascending)."""
        scores = np.zeros(len(asks), dtype=np.int64)
        turn = np.cumsum(np.append(0, asks[1:] != asks[:-1]))
        rows = np.cumsum(self.own[docs + 1] - self.own[docs])
        a = 0
        while a < len(asks):
            # So many queries, and a bounded number of postings.
            b = min(int(np.searchsorted(turn, turn[a] + GROUP)), max(a + 1, int(np.searchsorted(rows, (rows[a - 1] if a else 0) + POSTINGS, side="right"))))
            queries, turns = asks[a:b][np.append(True, asks[a + 1:b] != asks[a:b - 1])], turn[a:b] - turn[a]
            own, slot = _ranges(owns[queries], owns[queries + 1], np.arange(len(queries)))
            # The queries' terms are numbered; the others have 0, and no weight.
            self.number[at[own]] = 1
            terms = np.flatnonzero(self.number)
            self.number[terms] = np.arange(1, len(terms) + 1)
            weights = np.zeros((len(queries), len(terms) + 1))
            weights[slot, self.number[at[own]]] = idf[own]
            row, place = _ranges(self.own[docs[a:b]], self.own[docs[a:b] + 1], np.arange(b - a))
            number = self.number.take(self.own_terms.take(row))
            some = np.flatnonzero(number)
            place = place[some]
            gains = weights[turns[place], number[some]] * self.own_gains.take(row[some]) * SCALE
            scores[a:b] = np.bincount(place, np.rint(gains), minlength=b - a).astype(np.int64)
            self.number[terms] = 0
            a = b
        return scores


def _order(values: np.ndarray) -> np.ndarray:
    """The stable order of ``values``.  They are sorted together with their places, which take their last bits (and mostly don't matter there)."""
    bits = len(values).bit_length()
    small = len(values) and values.min() >= 0 and int(values.max()).bit_length() + bits < 64
    places = np.sort(values << bits | np.arange(len(values)) if small else values >> bits << bits | np.arange(len(values))) & (1 << bits) - 1
    ordered = values[places]
    return places if np.all(ordered[1:] >= ordered[:-1]) else np.argsort(values, kind="stable")


def _kinds(text: np.ndarray, term: np.ndarray, df: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Of each text (``sizes`` terms) its commonest terms by ``df``, the commonest last: keys of an order by kind."""
    rank = np.empty(len(df), dtype=np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    ranks = np.sort(text * len(df) + rank[term]) if len(text) else np.zeros(1, dtype=np.int64)
    low = np.cumsum(sizes) - sizes
    return [np.where(sizes > i, ranks[np.minimum(low + i, len(ranks) - 1)] % max(len(df), 1), -1) for i in (3, 2, 1, 0)]


def _ranges(low: np.ndarray, high: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [low, high), and for each the value of its range."""
    size = high - low
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size), np.repeat(values, size)


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, best first."""
    order = np.lexsort((ids, -scores, query))
    asked = query[order]
    order = order[np.arange(len(asked)) - np.searchsorted(asked, asked) < k]
    return query[order], ids[order], scores[order]


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
          shard_bytes: int = 8 << 20, lane_bytes: int = 16 << 20, query_bytes: int = 64 << 20, chunk_bytes: int = 8 << 20) -> DataFrame:
    """(query_id, rank, doc_id, score) of the k best documents of each query row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    stats = materialize(term_statistics(docs), "terms")
    total = stats.where("term is null").first()
    n, mean = (total.df, max(total.words / total.df, 1e-9)) if total and total.df else (0, 1.0)

    def terms(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                found, owner, _ = _distinct(batch.column("text").slice(a, 500))
                yield pa.RecordBatch.from_arrays([batch.column("query_id").slice(a, 500).take(pa.array(owner)), pa.array(found)], names=["query_id", "term"])

    def pack(queries: pa.Table) -> pa.Table:
        return pa.table({"chunk": queries["chunk"].slice(0, 1), "questions": pa.array([Asked.pack(queries)], pa.binary())})

    asked = (queries.select(F.col(f"`{id_col}`").cast("long").alias("query_id"), F.col(f"`{text_col}`").alias("text"))
             .mapInArrow(terms, "query_id long, term long").distinct())
    asked = materialize(asked.join(stats.select("term", "df"), "term").groupBy("query_id")
                        .agg(F.array_sort(F.collect_list(F.struct("term", "df"))).alias("t"))
                        .select("query_id", F.col("t.term").alias("terms"), F.col("t.df").alias("dfs")), "queries")
    chunks = -(-16 * (asked.agg(F.sum(F.size("terms"))).first()[0] or 1) // chunk_bytes)
    packed = materialize(asked.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
                         .groupBy("chunk").applyInArrow(pack, "chunk int, questions binary"), "questions")
    shards = materialize(blocks(docs, "doc_id", "text", shard_bytes), "shards")
    # The grid: lanes of shards by parts of queries, both of bounded size.  A cell's rows come to one task once each.
    lanes = -(-(shards.agg(F.sum(F.length("payload"))).first()[0] or 1) // lane_bytes)
    parts = -(-(packed.agg(F.sum(F.length("questions"))).first()[0] or 1) // query_bytes)
    shards = shards.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        states = []
        for questions, places, least in zip(right["questions"], right["places"], right["least"]):
            size = len(Asked.unpack(questions.as_buffer(), n).sizes)
            floor = np.zeros(size, dtype=np.int64)
            if places.is_valid:
                floor[places.values.to_numpy()] = least.values.to_numpy()
            states.append([floor, *[np.zeros(0, dtype=np.int64)] * 3])
        for payload in left["payload"] if states else ():
            index = None  # before the next is built
            index = Index(payload.as_buffer(), "doc_id", "text", mean)
            for questions, state in zip(right["questions"], states):
                found = index.hits(Asked.unpack(questions.as_buffer(), n), k, state[0])
                if len(found[0]):
                    state[1:] = _best(*(np.concatenate(x) for x in zip(state[1:], found)), k)
                    full = np.flatnonzero(np.bincount(state[1]) == k)
                    last = np.searchsorted(state[1], full, side="right") - 1
                    state[0][full] = np.maximum(state[0][full], state[3][last])
            give_back()
        out = []
        for chunk, questions, (_, query, ids, scores) in zip(right["chunk"], right["questions"], states):
            out.append(pa.table({"chunk": pa.array(np.full(len(query), chunk.as_py()), pa.int32()), "place": pa.array(query, pa.int32()),
                                 "query_id": Asked.unpack(questions.as_buffer(), n).ids.take(pa.array(query)),
                                 "doc_id": pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).max), "score": pa.array(scores, pa.int64())}))
        return pa.concat_tables(out) if out else pa.schema([(c, pa.int32()) for c in ("chunk", "place")] + [(c, pa.int64()) for c in ("query_id", "doc_id", "score")]).empty_table()

    def searched(lane: Column, questions: DataFrame) -> DataFrame:
        """What the lanes of shards hold for every query: (chunk, place, query_id, doc_id, score), at least k of a query if they have so many."""
        every = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high - 1)))
        left = shards.where(lane).withColumn("part", every(0, parts))
        right = questions.withColumn("part", F.pmod("chunk", F.lit(parts)).cast("int")).withColumn("lane", every(0, lanes)).where(lane)
        return (left.groupBy("lane", "part").cogroup(right.groupBy("lane", "part"))
                .applyInArrow(search, "chunk int, place int, query_id long, doc_id long, score long"))

    best = Window.partitionBy("chunk", "place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    first, unknown = math.isqrt(lanes) // 2, [F.lit(None).cast("array<int>").alias("places"), F.lit(None).cast("array<long>").alias("least")]
    if first:
        # A few lanes give every query the k-th score that it has there; the rest look for what reaches it.
        pilot = materialize(ranked(searched(F.col("lane") < first, packed.select("*", *unknown))).drop("rank"), "pilot")
        least = (pilot.groupBy("chunk", "place").agg(F.count("score").alias("n"), F.min("score").alias("score")).where(F.col("n") == k)
                 .groupBy("chunk").agg(F.collect_list("place").alias("places"), F.collect_list("score").alias("least")))
        found = searched(F.col("lane") >= first, packed.join(least, "chunk", "left")).unionByName(pilot)
    else:
        found = searched(F.lit(True), packed.select("*", *unknown))
    return ranked(found).select("query_id", "rank", "doc_id", "score")


def op6_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return top_k(docs, docs.where("doc_id % 100 = 0"), k=10)


OP6_SQL = """
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x20\\x09-\\x0D]+') as w from documents),
t as (select doc_id, word, count(*) as tf from (select doc_id, unnest(w) as word from d) group by all),
f as (select word, count(*) as df from t group by word),
s as (select count(*) as n, sum(len(w)) / count(*) as mean from d),
m as (select q.doc_id as query_id, t.doc_id,
             cast(sum(cast(round(ln(1 + (s.n - f.df + 0.5) / (f.df + 0.5)) *
                      (t.tf * 2.2 / (t.tf + 1.2 * (1 - 0.75 + 0.75 * len(d.w) / s.mean))) * 1000000) as bigint)) as bigint) as score
      from t q join f on q.word = f.word join t on t.word = q.word join d on d.doc_id = t.doc_id, s
      where q.doc_id % 100 = 0 group by all),
r as (select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from m)
select query_id, cast(rank as integer) as rank, doc_id, score from r where rank <= 10
"""
