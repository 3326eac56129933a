"""Repeated passages across documents, found from difference-cover positions.

A passage is a window of ``length`` units (bytes or words).  A window that
also starts earlier (smaller id, or same document and earlier start) is a
repeat; every unit under a repeat is removed.

**Cover.**  ``residues`` is a difference cover modulo ``period``: for any two
positions p, q some shift s < period puts both p+s and q+s on the cover.  Two
equal windows therefore share an equal *anchor*: a run of
``length - period + 1`` units at a cover position of either document.

**Plan** (one lazy Spark plan, no driver work):

1. Documents are packed into blocks (compressed Arrow record batches of about
   ``block_bytes`` of text), dealt out by block number.  Texts equal to an
   earlier document's are found by digests (blake2b); they are repeats as a whole and
   leave the search.
2. Every block names its cover anchors (hashes) and sends the distinct names,
   4 bytes each, to name buckets.  A bucket sorts its names and returns one
   bit per name: does it occur elsewhere?
3. Only windows that hold a repeated anchor can be repeats.  (With ``refine``,
   the same is then asked of longer runs around the repeated anchors, so that
   short common lines are not candidates.)  Each block names those windows
   (64 bits mixed from two independent sums, in buckets dealt by the second),
   keeps its first of each, and sends them with their document ids.  A bucket
   finds the first of all and returns one bit for each that is not.
4. Each block joins the bits back and cuts its texts.

A block sends a name once however often it holds it, so a passage that a third
of all rows share costs one entry per block.  Nothing is proportional to pairs
of occurrences.  A task holds one block, or one bucket's names.  With large
inputs set ``block_bytes`` (64 MB on larger executors) and
``spark.sql.shuffle.partitions`` in proportion, as for any shuffle.

Defined cases: a null or empty text has no units; a null id comes after every
other id; rows that repeat an id are ordered by their block and position; an
empty table gives an empty result; input columns whose names clash with result
columns are replaced by the result's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions, without
from .hashing import BYTE_UNITS, Runs, column_bytes, digest, mix, window_names, word_hashes, word_spans

BLOCK_BYTES = 2 << 20
_LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Cover:
    """``unit`` is ``bytes`` or ``words``; ``residues`` cover all differences modulo ``period``.

    ``refine`` > 0 adds a step that compares longer runs around the anchors
    that occur again, ``refine - 1`` units shorter than the window.
    """

    unit: str
    length: int
    period: int
    residues: tuple[int, ...]
    refine: int = 0

    def __post_init__(self):
        seen = {(a - b) % self.period for a in self.residues for b in self.residues}
        if len(seen) < self.period or self.length < self.period:
            raise ValueError("residues are no difference cover, or the period is longer than the window")

    @property
    def anchor(self) -> int:
        return self.length - self.period + 1


# ---------------------------------------------------------------- blocks

def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _order(table: pa.Table, id_col: str) -> pa.Table:
    ids = table[id_col].cast(pa.int64()).fill_null(_LAST).to_numpy()
    return table if np.all(ids[1:] >= ids[:-1]) else table.take(pa.array(np.argsort(ids, kind="stable")))


def blocks(df: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(block, payload): the rows of ``df`` in order of id, about ``block_bytes`` of text each."""

    def cut(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            table = _order(pa.Table.from_batches([batch]), id_col)
            offsets = column_bytes(table[text_col])[1]
            part = offsets[1:] // block_bytes
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)]
            for a, b in zip(cuts, cuts[1:]):
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block], pa.int64()), "payload": pa.array([_pack(table.slice(a, b - a))], pa.binary())})
                block += 1

    return df.mapInArrow(cut, "block long, payload binary")


class _Block:
    """One unpacked block: its units, its anchors and, given the marks, its candidate windows."""

    def __init__(self, payload: bytes, text_col: str, cover: Cover, right: pa.Table | None = None, buckets: int = 1):
        self.cover, self.table, self.buckets = cover, _unpack(payload), buckets
        self.raw, self.offsets = column_bytes(self.table[text_col])
        if cover.unit == "bytes":
            self.at, units = self.offsets, BYTE_UNITS[self.raw]
        else:
            self.starts, self.ends, self.at = word_spans(self.raw, self.offsets)
            units = word_hashes(self.raw, self.starts, self.ends)
        self.units, self.n = units, len(units)
        self.bits = {kind: _bits(right, kind) for kind in (COPIES, MARKS, LONGER, LATER)} if right is not None else {}
        self.copies = self._copies() if right is not None else np.zeros(len(self.at) - 1, dtype=bool)
        self.runs = Runs(units)
        self.anchors = self._anchors()
        self.names, self.inverse, self.counts = np.unique(
            self.runs.windows(self.anchors, cover.anchor), return_inverse=True, return_counts=True)

    def _anchors(self) -> np.ndarray:
        cover, longest = self.cover, int(np.max(np.diff(self.at), initial=0))
        on = np.zeros(cover.period, dtype=bool)
        on[list(cover.residues)] = True
        every = np.flatnonzero(np.resize(on, max(longest, 1)))
        room = np.diff(self.at) - cover.anchor + 1
        upto = np.where(self.copies, 0, np.searchsorted(every, room))
        parts = [every[:k] + a for k, a in zip(upto, self.at[:-1]) if k > 0]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)

    def digests(self):
        """Of the texts that hold a window: names, bucket edges, and the first texts of each name in bucket order."""
        docs = np.flatnonzero(np.diff(self.at) >= self.cover.length)
        view = memoryview(self.raw)
        made = b"".join(digest(view[a:b]) for a, b in zip(self.offsets[docs].tolist(), self.offsets[docs + 1].tolist()))
        both = np.frombuffer(made, dtype="<u8").reshape(len(docs), 2)
        return docs, *_firsts(both[:, 0], both[:, 1], self.buckets)

    def _copies(self) -> np.ndarray:
        docs, _, edges, first = self.digests()
        out = np.zeros(len(self.at) - 1, dtype=bool)
        out[docs] = _not_first(len(docs), edges, first, self.bits[COPIES])
        return out

    def _again(self, names: np.ndarray, counts: np.ndarray, kind: int) -> np.ndarray:
        """Which of the distinct names occur again, here or (by the answered bits) elsewhere."""
        again, edges = counts > 1, _edges(names, self.buckets)
        for bucket, bits in self.bits[kind].items():
            a, b = edges[bucket], edges[bucket + 1]
            again[a:b] |= np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=b - a).astype(bool)
        return again

    def longer(self):
        """The runs around the anchors that occur again, by how far ahead of the anchor a window starts.

        Every window that starts ``near`` to ``far`` units ahead of an anchor
        holds the run from ``near`` ahead of it on, ``far - near`` units
        shorter than the window.  Returns (runs' starts, near, far, names of
        the runs, ...as of np.unique).
        """
        hit = self.anchors[self._again(self.names, self.counts, MARKS)[self.inverse]]
        doc = np.searchsorted(self.at, hit, side="right") - 1
        step = self.cover.refine or self.cover.period
        starts, nears, fars, names = [], [], [], []
        for near in range(0, self.cover.period, step):
            far = min(near + step, self.cover.period) - 1
            size = self.cover.length - (far - near)
            start = hit - near
            fits = (start >= self.at[doc]) & (start + size <= self.at[doc + 1])
            starts.append(start[fits])
            nears.append(np.full(len(starts[-1]), near))
            fars.append(np.full(len(starts[-1]), far))
            names.append(mix(self.runs.at(starts[-1], starts[-1] + size) + np.uint64(near + 1)))
        starts, nears, fars, names = (np.concatenate(x) for x in (starts, nears, fars, names))
        return starts, nears, fars, *np.unique(names, return_inverse=True, return_counts=True)

    def candidates(self) -> np.ndarray:
        """Starts of the windows that hold an anchor, and a longer run around it, which occur elsewhere."""
        starts, nears, fars, names, inverse, counts = self.longer()
        if self.cover.refine:
            again = self._again(names, counts, LONGER)[inverse]
            starts, nears, fars = starts[again], nears[again], fars[again]
        doc = np.searchsorted(self.at, starts, side="right") - 1
        low = np.maximum(starts + nears - fars, self.at[doc])
        high = np.minimum(starts, self.at[doc + 1] - self.cover.length)
        return np.flatnonzero(_covered(low[low <= high], high[low <= high] + 1, self.n))

    def windows(self, starts: np.ndarray):
        """Of the windows at ``starts``: names, bucket edges, and the first of each name in bucket order."""
        return _firsts(*window_names(self.units, self.runs, starts, self.cover.length), self.buckets)

    def ids(self, id_col: str) -> np.ndarray:
        return self.table[id_col].cast(pa.int64()).fill_null(_LAST).to_numpy()


def _firsts(names: np.ndarray, second: np.ndarray, buckets: int):
    """The distinct names in order of bucket (dealt by the second names) and place: (names, edges, places)."""
    names, first = np.unique(names, return_index=True)
    bucket = _bucket(second[first], buckets)
    order = np.lexsort((first, bucket))
    return names[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), first[order]


def _not_first(n: int, edges: np.ndarray, first: np.ndarray, bits: dict[int, bytes]) -> np.ndarray:
    """Which of n entries aren't the first of their name, here or (by the answered bits) elsewhere."""
    own = np.zeros(len(first), dtype=bool)
    for bucket, x in bits.items():
        a, z = edges[bucket], edges[bucket + 1]
        own[a:z] = np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=z - a).astype(bool)
    out = np.ones(n, dtype=bool)
    out[first] = own
    return out


def _bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    return (((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _edges(names: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(_bucket(names, buckets), np.arange(buckets + 1))


def _covered(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    steps = np.bincount(low, minlength=n + 1)[:n + 1] - np.bincount(high, minlength=n + 1)[:n + 1]
    return np.cumsum(steps[:n]) > 0


def _bits(right: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: bits for k, b, bits in zip(right["kind"].to_pylist(), right["bucket"].to_pylist(), right["bits"].to_pylist()) if k == kind}


# ---------------------------------------------------------------- the plan

COPIES, MARKS, LONGER, LATER = range(4)
_BITS = "block long, kind int, bucket int, bits binary"
_SENT = "bucket int, block long, names binary, docs binary, runs binary"
_NAMED = {"bucket": pa.int32(), "block": pa.int64(), "names": pa.binary(), "docs": pa.binary(), "runs": pa.binary()}


def _answers(table: pa.Table, flags: np.ndarray, ends: np.ndarray, kind: int) -> pa.Table:
    """One row of bits for each sender that has a bit set."""
    rows = [(blk, kind, bkt, np.packbits(flags[a:b]).tobytes())
            for blk, bkt, a, b in zip(table["block"].to_pylist(), table["bucket"].to_pylist(), [0, *ends[:-1]], ends) if flags[a:b].any()]
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table({"block": pa.array(cols[0], pa.int64()), "kind": pa.array(cols[1], pa.int32()),
                     "bucket": pa.array(cols[2], pa.int32()), "bits": pa.array(cols[3], pa.binary())})


def _repeated(table: pa.Table, kind: int) -> pa.Table:
    """Sorts one bucket's names; a bit for each name that another sender also has."""
    raw = [np.frombuffer(x, dtype="<u4") for x in table["names"].to_pylist()]
    ends, names = np.cumsum([len(x) for x in raw]), np.concatenate(raw)
    line = np.sort(names)
    twice = np.unique(line[1:][line[1:] == line[:-1]])
    at = np.searchsorted(twice, names)
    flags = np.zeros(len(names), dtype=bool)
    if len(twice):
        flags = twice[np.minimum(at, len(twice) - 1)] == names
    return _answers(table, flags, ends, kind)


def _later(table: pa.Table, kind: int) -> pa.Table:
    """Sorts one bucket's names; a bit for each that isn't the first of its name by (id, block)."""
    raw = [np.frombuffer(x, dtype="<u8") for x in table["names"].to_pylist()]
    size = np.array([len(x) for x in raw])
    names = np.concatenate(raw)
    docs = np.concatenate([np.repeat(np.frombuffer(d, dtype="<i8"), np.frombuffer(r, dtype="<u4"))
                           for d, r in zip(table["docs"].to_pylist(), table["runs"].to_pylist())])
    block = np.repeat(table["block"].to_numpy(), size)
    order = np.argsort(names)
    line = names[order]
    new = np.concatenate([[True], line[1:] != line[:-1]])
    heads, group = np.flatnonzero(new), np.cumsum(new) - 1
    first_doc = docs[order] == np.minimum.reduceat(docs[order], heads)[group]
    key = np.where(first_doc, block[order], _LAST)
    flags = np.zeros(len(names), dtype=bool)
    flags[order] = key != np.minimum.reduceat(key, heads)[group]
    return _answers(table, flags, np.cumsum(size), kind)


def remove_repeats(df: DataFrame, cover: Cover, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES, keep_text: bool = False, digest: bool = True) -> DataFrame:
    """The rows of ``df`` with n_units, n_removed, n_spans (maximal removed runs), and

    * ``digest``: ``kept_sha256`` of the kept bytes (words: kept words joined by one space),
    * ``keep_text``: ``kept`` (binary), those bytes themselves.
    """
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    buckets = 2 * parts
    results = ["n_units", "n_removed", "n_spans"] + ["kept_sha256"] * digest + ["kept"] * keep_text
    source = without(df, results)
    dealt = blocks(source, id_col, text_col, block_bytes).repartition(parts, "block")

    def rows_of(b: _Block, blk: int, names, edges, docs, out: dict) -> None:
        """Appends one row per bucket: the names and, run-length coded, the ids of their documents."""
        ids = b.ids(id_col)
        for k in np.flatnonzero(np.diff(edges)):
            x = docs[edges[k]:edges[k + 1]]
            head = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            values = (int(k), blk, names[edges[k]:edges[k + 1]].astype("<u8").tobytes(), ids[x[head]].astype("<i8").tobytes(),
                      np.diff([*head, len(x)]).astype("<u4").tobytes())
            for c, v in zip(_NAMED, values):
                out[c].append(v)

    def send_digests(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in _NAMED}
            for blk, payload in zip(batch["block"].to_pylist(), batch["payload"]):
                b = _Block(payload.as_buffer(), text_col, cover, buckets=buckets)
                docs, names, edges, first = b.digests()
                rows_of(b, blk, names, edges, docs[first], out)
            yield pa.RecordBatch.from_pydict({c: pa.array(out[c], t) for c, t in _NAMED.items()})

    def send_names(kind: int):
        def send(left: pa.Table, right: pa.Table) -> pa.Table:
            out: dict[str, list] = {"bucket": [], "block": [], "names": []}
            for blk, payload in zip(left["block"].to_pylist(), left["payload"].combine_chunks()):
                b = _Block(payload.as_buffer(), text_col, cover, right, buckets)
                names = b.names if kind == MARKS else b.longer()[3]
                edges = _edges(names, buckets)
                low = (names & np.uint64(0xFFFFFFFF)).astype("<u4")
                some = np.flatnonzero(np.diff(edges))
                out["bucket"] += some.tolist()
                out["block"] += [blk] * len(some)
                out["names"] += [low[edges[k]:edges[k + 1]].tobytes() for k in some]
            return pa.table({c: pa.array(out[c], _NAMED[c]) for c in out})

        return send

    def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in _NAMED}
        for blk, payload in zip(left["block"].to_pylist(), left["payload"].combine_chunks()):
            b = _Block(payload.as_buffer(), text_col, cover, right, buckets)
            starts = b.candidates()
            names, edges, first = b.windows(starts)
            rows_of(b, blk, names, edges, np.searchsorted(b.at, starts[first], side="right") - 1, out)
        return pa.table({c: pa.array(out[c], t) for c, t in _NAMED.items()})

    def answered(sent: DataFrame, answer: Callable, kind: int) -> DataFrame:
        return sent.groupBy("bucket").applyInArrow(lambda table: answer(table, kind), _BITS).repartition(parts, "block")

    by_block = dealt.groupBy("block")
    copies = answered(dealt.mapInArrow(send_digests, _SENT), _later, COPIES)
    marks = copies
    for kind in (MARKS, LONGER) if cover.refine else (MARKS,):
        sent = by_block.cogroup(marks.groupBy("block")).applyInArrow(send_names(kind), "bucket int, block long, names binary")
        marks = marks.unionByName(answered(sent, _repeated, kind))
    bits = marks.unionByName(answered(
        by_block.cogroup(marks.groupBy("block")).applyInArrow(send_windows, _SENT), _later, LATER))

    fields = list(source.schema.fields) + [T.StructField(c, T.LongType()) for c in results[:3]]
    fields += [T.StructField("kept_sha256", T.StringType())] * digest + [T.StructField("kept", T.BinaryType())] * keep_text

    def cut_texts(left: pa.Table, right: pa.Table) -> pa.Table:
        done = [_cut(_Block(p.as_buffer(), text_col, cover, right, buckets), digest, keep_text)
                for p in left["payload"].combine_chunks()]
        return pa.concat_tables(done)

    return by_block.cogroup(bits.groupBy("block")).applyInArrow(cut_texts, T.StructType(fields))


def _cut(b: _Block, digest: bool, keep_text: bool) -> pa.Table:
    starts = b.candidates()
    _, edges, first = b.windows(starts)
    repeat = starts[_not_first(len(starts), edges, first, b.bits[LATER])]
    gone = _covered(repeat, repeat + b.cover.length, b.n) | np.repeat(b.copies, np.diff(b.at))
    head = gone.copy()
    inner = np.ones(b.n + 1, dtype=bool)
    inner[b.at] = False
    head[1:] &= ~(gone[:-1] & inner[1:-1])
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[b.at])
    out = b.table.append_column("n_units", pa.array(np.diff(b.at), pa.int64()))
    out = out.append_column("n_removed", pa.array(total(gone), pa.int64()))
    out = out.append_column("n_spans", pa.array(total(head), pa.int64()))
    kept = _kept_bytes(b, gone) if b.cover.unit == "bytes" else _kept_words(b, gone)
    if digest:
        out = out.append_column("kept_sha256", pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))
    if keep_text:
        out = out.append_column("kept", pa.array([bytes(x) for x in kept], pa.binary()))
    return out


def _kept_bytes(b: _Block, gone: np.ndarray) -> list[memoryview]:
    at = np.concatenate([[0], np.cumsum(~gone)])[b.offsets]
    view = memoryview(b.raw[~gone])
    return [view[x:y] for x, y in zip(at, at[1:])]


def _kept_words(b: _Block, gone: np.ndarray) -> list[memoryview]:
    """Kept words; the byte after each, white space of the same text, becomes the one space."""
    size = len(b.raw)
    ends, starts = b.ends[~gone], b.starts[~gone]
    keep = _covered(starts, ends, size)
    doc_end = np.zeros(size + 1, dtype=bool)
    doc_end[b.offsets] = True
    space = ends[~doc_end[ends]]
    keep[space] = True
    raw = b.raw.copy()
    raw[space] = 32
    at = np.concatenate([[0], np.cumsum(keep)])[b.offsets]
    view = memoryview(raw[keep])
    return [view[x:y - 1] if y > x and view[y - 1] == 32 else view[x:y] for x, y in zip(at, at[1:])]


def decode_kept(text: str, kept: str = "kept") -> Callable:
    """The kept bytes as text where something was removed, else the text itself."""
    return F.when(F.col("n_removed") > 0, F.col(kept).cast("string")).otherwise(F.col(text))
