"""Packing: concatenate and cut, by two-pass prefix sums.

Pass 1 encodes every document (its ids, then the end id) and writes them with
the writing task's number and the tokens before it in that task.  Pass 2 sums
the tasks' totals into global offsets and cuts each document's ids where the
fixed windows of ``length`` tokens end.  Documents follow one another in the
order they are stored, so no row is shuffled; every sequence but the last is
full, and only the last is padded.

Words and pre-tokens once coded are remembered per worker (in bounded tables),
which is exact as the white space of the vocabulary's own rule always ends a
pre-token, and pre-tokens are coded independently.  Texts that hold an added
token of the vocabulary (``<|endoftext|>``) are coded whole by the tokenizer as
it is, which gives that token's own id.

Defined cases: a null or empty text is the end id alone; repeated rows and ids
are packed as they come; an empty table gives no pieces; extra columns are not
read.  ``piece_ids`` keeps each piece's ids for writing the sequences.
"""

from __future__ import annotations

import zlib
from array import array
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import give_back, prefix_offsets, read_table, text_slices, without

SEQUENCE = 4096
END_ID = 2
REMEMBERED, SLICE, BROADCAST_PARTS = 1_000_000, 1 << 20, 1_000_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The pre-tokens of the vocabulary's own splitting rule.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_BEYOND = 0x250


class WordEncoder:
    """Ids of texts, by tables of the words (runs without the vocabulary's white space) and of the pre-tokens seen so far.

    Words of Latin letters are lower-cased and split into pre-tokens here, as
    the vocabulary's normaliser and splitter would, and new pre-tokens are
    coded many at a time: the last id of a pre-token, and no other, ends a word.
    All other words (and the Latin letter that lower-cases differently) are
    coded whole.
    """

    _loaded: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        import os

        import regex

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.whole.get_vocab_size(), dtype=bool)
        for token, number in self.whole.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.split = regex.compile(PIECES).findall
        self.solid = regex.compile(r"\S+").findall

    @classmethod
    def load(cls, path: str) -> WordEncoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        whole = [k for k, t in enumerate(texts) if t and any(a in t for a in self.added)]
        apart = set(whole)
        split = [self._words(t) if t and k not in apart else [] for k, t in enumerate(texts)]
        self._learn(set(filterfalse(self.words.__contains__, chain.from_iterable(split))))
        known = self.words.__getitem__
        out = [b"".join(map(known, words)) for words in split]
        for k, coded in zip(whole, self.whole.encode_batch_fast([texts[k] for k in whole], add_special_tokens=False)):
            out[k] = array("I", coded.ids).tobytes()
        return out

    def _words(self, text: str) -> list[str]:
        """The runs without white space; ``str.split`` would also drop U+001C to U+001F, which have ids."""
        return self.solid(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def _learn(self, words: set[str]) -> None:
        parts, others = {}, []
        for word in words:
            if word.isascii() or ord(max(word)) < _BEYOND and "\u0130" not in word:
                parts[word] = self.split(word.lower())
            else:
                others.append(word)
        new = list(set(filterfalse(self.pieces.__contains__, chain.from_iterable(parts.values()))))
        for a in range(0, len(new), 4000):
            self._code(new[a:a + 4000])
        known = self.pieces.__getitem__
        for word, part in parts.items():
            self.words[word] = known(part[0]) if len(part) == 1 else b"".join(map(known, part))
        for word, coded in zip(others, self.whole.encode_batch_fast(others, add_special_tokens=False)):
            self.words[word] = array("I", coded.ids).tobytes()

    def _code(self, pieces: list[str]) -> None:
        ids = np.array(self.plain.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(pieces):
            raw, stops = ids.tobytes(), (stops * 4).tolist()
            self.pieces.update(zip(pieces, (raw[a:b] for a, b in zip([0, *stops], stops))))
        else:  # a vocabulary that marks word ends in another way
            for piece, coded in zip(pieces, self.plain.encode_batch_fast(pieces, add_special_tokens=False)):
                self.pieces[piece] = array("I", coded.ids).tobytes()


def encoded(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, before, doc_tokens, ids): pass 1."""

    def one(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        encoder, end = WordEncoder.load(vocabulary), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            texts, ids = batch.column(text_col), batch.column(id_col)
            for a, b in text_slices(texts, SLICE):
                coded = [x + end for x in encoder.encode(texts.slice(a, b - a).to_pylist())]
                size = np.array([len(x) // 4 for x in coded], dtype=np.int64)
                ahead = before + np.cumsum(size) - size
                before += int(size.sum())
                small = [_narrow(x) for x in coded]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(a, b - a), "part": pa.array(np.full(b - a, part, dtype=np.int64)),
                    "before": pa.array(ahead), "doc_tokens": pa.array(size), "ids": pa.array(small, pa.binary())})
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
            .mapInArrow(one, f"doc_id {kind}, part long, before long, doc_tokens long, ids binary"))


def _narrow(ids: bytes) -> bytes:
    """Two bytes an id where all fit (their count is known from doc_tokens)."""
    x = np.frombuffer(ids, dtype="<u4")
    return x.astype("<u2").tobytes() if not len(x) or x.max() < 65536 else ids


def _widen(ids: bytes, count: int) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u2").astype("<u4") if len(ids) == 2 * count else np.frombuffer(ids, dtype="<u4")


def pack(docs: DataFrame, length: int = SEQUENCE, vocabulary: str | None = None, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", piece_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]."""
    coded = materialize(encoded(docs, vocabulary or default_vocabulary(), end_id, id_col, text_col), "encoded")
    totals = coded.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    bases = materialize(without(prefix_offsets(totals, "part", "tokens", "base"), ["tokens"]), "bases")
    # One row a task of pass 1: broadcast where their number allows it, so that no ids are shuffled.
    near = F.broadcast(bases) if bases.count() <= BROADCAST_PARTS else bases
    placed = (coded.join(near, "part")
              .select("doc_id", (F.col("base") + F.col("before")).alias("place"), "doc_tokens", "ids"))

    def cut(batches):
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for k, (place, count, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("place", "doc_tokens", "ids")))):
                ids, start = _widen(raw, count), 0
                while start < count:
                    sequence, offset = divmod(place + start, length)
                    size = min(length - offset, count - start)
                    piece = ids[start:start + size].tobytes()
                    for c, v in zip(rows, (k, start, size, zlib.crc32(piece), count, sequence, offset, piece)):
                        rows[c].append(v)
                    start += size
            cols = {"doc_id": batch.column("doc_id").take(pa.array(rows.pop("row"), pa.int64()))}
            pieces = rows.pop("ids")
            cols |= {c: pa.array(v, pa.int64()) for c, v in rows.items()}
            yield pa.RecordBatch.from_pydict(cols | ({"ids": pa.array(pieces, pa.binary())} if piece_ids else {}))

    kind = docs.schema[id_col].dataType.simpleString()
    numbers = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(cut, f"doc_id {kind}, {numbers}" + ", ids binary" * piece_ids)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
