"""Byte-level BPE: overlapping chunk encoding, and decoding by raw bytes.

Texts longer than ``chunk`` characters are cut into chunks that overlap by
``overlap`` characters and are dealt out over the cluster.  Each chunk is
pre-tokenised on its own and reports the pre-token boundaries inside its two
overlaps.  Neighbours are stitched at the first boundary that both report
(from there on both see the same pre-tokens, as a match depends only on the
text ahead of it); the text between two stitches is a piece, and pieces are
encoded independently.  Where an overlap has no common boundary (one pre-token
covers it) the two chunks stay one piece, whose boundaries are matched anew,
so results are exact for any text.

A boundary is used only if the character before it is not white space (a run
of white space may match differently at a text's end) and if the left chunk
has at least ``MARGIN`` characters after it (its last matches may go on in the
next chunk).

Defined cases: a null or empty text has no ids; rows with equal ids are coded
one by one (rows are numbered, not grouped by id); an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

CHUNK, OVERLAP, MARGIN = 1 << 15, 1 << 10, 8


def default_ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


_CODERS: dict[tuple[str, str], object] = {}


def coder(path: str, pattern: str):
    """The encoding of a rank file, once per worker."""
    if (path, pattern) not in _CODERS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _CODERS[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _CODERS[path, pattern]


def boundaries(text: str, pattern: str) -> np.ndarray:
    """Where pre-tokens end, when matching starts at the text's start."""
    import regex

    return np.fromiter((m.end() for m in regex.compile(pattern).finditer(text)), dtype=np.int64)


def usable(text: str, ends: np.ndarray, low: int, high: int) -> list[int]:
    """The boundaries in [low, high) whose character before is no white space."""
    return [int(e) for e in ends[(ends >= max(low, 1)) & (ends < high)] if not text[e - 1].isspace()]


def _ids(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids): each row's ids as little-endian unsigned 32-bit integers (binary)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    long_ = F.coalesce(F.char_length("text"), F.lit(0)) > chunk

    def whole(batches):
        enc = coder(ranks, pattern)
        for batch in batches:
            coded = [_ids(enc.encode_ordinary(t)) if t else b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": pa.array(coded, pa.binary())})

    def cut(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for k, t in enumerate(batch.column("text").to_pylist()):
                starts = range(0, len(t), chunk)
                n = len(starts)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.concat_arrays([batch.column("doc_id").slice(k, 1)] * n), "row": pa.array([row] * n, pa.int64()),
                    "chunk": pa.array(range(n), pa.int64()), "text": pa.array([t[s:s + chunk + overlap] for s in starts], pa.string())})
                row += 1

    def edges(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            heads, tails = [], []
            for t in texts:
                ends = boundaries(t, pattern)
                heads.append(usable(t, ends, 0, overlap))
                tails.append([e - chunk for e in usable(t, ends, chunk, len(t) - MARGIN)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "row", "chunk", "text")), pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=["doc_id", "row", "chunk", "text", "head", "tail"])

    def stitch(table: pa.Table) -> pa.Table:
        """Pieces of one row's text: from one common boundary to the next."""
        table = table.sort_by("chunk")
        texts, heads, tails = (table[c].to_pylist() for c in ("text", "head", "tail"))
        pieces, now, start, behind = [], "", 0, 0  # behind: chunks merged since the last stitch
        for k, t in enumerate(texts[:-1]):
            tail = tails[k] if not behind else []
            if behind and behind & (behind - 1) == 0:  # the merged text is matched anew each time it doubles
                merged, base = now + t[start:], len(now) + chunk - start
                tail = [e - base for e in usable(merged, boundaries(merged, pattern), base, len(merged) - MARGIN)]
            common = sorted(set(tail).intersection(heads[k + 1]))
            if common:
                pieces.append(now + t[start:chunk + common[0]])
                now, start, behind = "", common[0], 0
            else:
                now, start, behind = now + t[start:chunk], 0, behind + 1
        pieces.append(now + texts[-1][start:])
        n = len(pieces)
        return pa.table({"doc_id": pa.chunked_array([pa.concat_arrays([table["doc_id"].combine_chunks().slice(0, 1)] * n)]) if n else table["doc_id"],
                         "row": pa.array([table["row"][0].as_py()] * n, pa.int64()), "piece": pa.array(range(n), pa.int64()), "text": pa.array(pieces, pa.string())})

    def encode_pieces(batches):
        enc = coder(ranks, pattern)
        for batch in batches:
            coded = [_ids(enc.encode_ordinary(t)) if t else b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "row", "piece")), pa.array(coded, pa.binary())], names=["doc_id", "row", "piece", "ids"])

    def join_ids(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        return pa.table({"doc_id": table["doc_id"].slice(0, 1), "ids": pa.array([b"".join(table["ids"].to_pylist())], pa.binary())})

    short = rows.where(~long_).mapInArrow(whole, f"doc_id {kind}, ids binary")
    chunks = rows.where(long_).mapInArrow(cut, f"doc_id {kind}, row long, chunk long, text string").repartition("row", "chunk")
    pieces = (chunks.mapInArrow(edges, f"doc_id {kind}, row long, chunk long, text string, head array<long>, tail array<long>")
              .groupBy("row").applyInArrow(stitch, f"doc_id {kind}, row long, piece long, text string").repartition("row", "piece"))
    joined = (pieces.mapInArrow(encode_pieces, f"doc_id {kind}, row long, piece long, ids binary")
              .groupBy("row").applyInArrow(join_ids, f"doc_id {kind}, ids binary"))
    return short.unionByName(joined)


def decode(coded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids) with ``decoded``: the raw bytes of the ids, concatenated."""
    kind = coded.schema["doc_id"].dataType.simpleString()

    def one(batches):
        enc = coder(ranks, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(np.frombuffer(x, dtype="<u4").tolist()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "decoded"])

    return coded.mapInArrow(one, f"doc_id {kind}, ids binary, decoded binary")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = default_ranks()
    both = decode(encode(read_table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
