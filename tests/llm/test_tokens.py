"""op7 (round trip, equal to the library), op9 (every id in exactly one piece) and op10 (laws)."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from episcope.llm import byte_bpe as B
from episcope.llm import packing as P
from episcope.llm import sharding as S
from samples import SCHEMA, documents

ODD = ["a", " ", "  ", "\n", "'", "l", "ll", "1", "é", "　", "!", "漢", "'s"]


def odd_texts():
    r = random.Random(3)
    out = ["".join(r.choices(ODD, k=r.randint(0, 400))) for _ in range(150)]
    return out + ["x" * 500, " " * 500, "ab " * 200 + "y" * 300 + " c " * 100, "\n \n" * 200, None, ""]


def test_chunked_encoding_equals_whole_encoding(spark):
    ranks, pattern = B.default_ranks()
    enc = B.coder(ranks, pattern)
    rows = [(k % 7 if k % 11 else None, t) for k, t in enumerate(odd_texts())]
    coded = B.encode(spark.createDataFrame(rows, SCHEMA), ranks, pattern, chunk=40, overlap=12)
    got = B.decode(coded, ranks, pattern).collect()
    want = Counter((i, np.array(enc.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t in rows)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want
    assert coded.where("doc_id > 99").count() == 0


def check_packing(rows, pieces, length):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.default_vocabulary())
    whole.encode_special_tokens = True
    ids = {i: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4") for i, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    assert by_doc.keys() == ids.keys()
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids[i]))
            assert p.ids_crc32 == zlib.crc32(ids[i][at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids[i])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, parts in by_sequence.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or s == len(by_sequence) - 1


@pytest.mark.parametrize("length", [16, 4096])
def test_every_id_lies_in_one_piece(spark, length):
    rows = documents() + [(5000 + k, t) for k, t in enumerate(odd_texts())] + [(9000, "İstanbul ΣΑΣ IT'S I'LL é ÉCOLE ß²")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check_packing(rows, P.pack(df, length=length).collect(), length)


def test_packing_an_empty_table(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_forgetting_words_changes_nothing():
    texts = [t or "" for _, t in documents()]
    coder = P.WordEncoder(P.default_vocabulary())
    want = coder.encode(texts)
    before, P.REMEMBERED = P.REMEMBERED, 5
    try:
        assert [coder.encode([t])[0] for t in texts] == want
    finally:
        P.REMEMBERED = before


def test_ids_equal_the_unmodified_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.default_vocabulary())
    texts = ["a\x1cb", "\x1e", "a \x1c\x1d\x1e\x1f b\x1f", "\x1cé 漢\x1d字\u3000x", "a\x85b\xa0c\u2028d\x0be", "hello<|endoftext|>world",
             "<|startoftext|>a\x1d <|endoftext|>", "<|EndOfText|> <|endoftext|", "İ<|endoftext|>\u0301é"]
    # Every code point of the letters' own splitting rule, and each that Python or the vocabulary may take for white space.
    points = [*range(0x260), *(c for c in range(0x260, 0x110000) if chr(c).isspace()), 0x180E, 0x200B, 0x2060, 0xFEFF]
    texts += [f for c in map(chr, points) for f in (c, f"a{c}b", f"1{c}{c}!{c}'s")]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    got = P.WordEncoder(P.default_vocabulary()).encode(texts)
    assert [t for t, g, w in zip(texts, got, want) if g != w] == []


def test_packing_keeps_separators_and_special_tokens(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.default_vocabulary())
    rows = [(1, "a\x1cb"), (2, "\x1e"), (3, "hello<|endoftext|>world"), (4, "plain words")]
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in P.pack(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()}
    ids = {i: np.array([*whole.encode(t, add_special_tokens=False).ids, 2], dtype="<u4") for i, t in rows}
    assert got == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in ids.items()}


def test_sharding_law_and_slots(spark):
    rows = [(i, f"t{i % 50}") for i in range(4000)] + [(None, None), (7, "é"), (7, "é")]
    tree = S.even_tree()
    got = S.assign(spark.createDataFrame(rows, SCHEMA).repartition(6), tree).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"key"}
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) < 1.5 * len(rows) / 24
    assert 0.5 * len(rows) / 25 < sum(r.grown_shard == 24 for r in got) < 1.6 * len(rows) / 25
    raw = [(i, (t or "").encode()) for i, t in rows]
    want = Counter((i, len(t) + 8, zlib.crc32(t)) for i, t in raw)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert len({r.shard for r in got if r.doc_id == 7}) == 1


def test_growing_moves_rows_only_into_the_new_shard(spark):
    from pyspark.sql import functions as F

    trees = [S.even_tree(1, 2, 2)]
    for weight in (1.0, 2.0, 0.5):
        trees.append(S.grow(trees[-1], weight))
    df = spark.range(3000).select(*[S.shard_of(F.col("id"), t).alias(f"s{k}") for k, t in enumerate(trees)])
    for r in df.collect():
        for k in range(1, len(trees)):
            assert r[k] in (r[k - 1], trees[k].leaves - 1)


def test_weight_changes_move_rows_only_through_their_subtree(spark):
    from dataclasses import replace

    from pyspark.sql import functions as F

    tree = S.even_tree()
    first = tree.children[0]
    rack = first.children[0]
    heavier = replace(rack, children=(replace(rack.children[0], leaf_weight=3.0), *rack.children[1:]))
    changed = replace(tree, children=(replace(first, children=(heavier, *first.children[1:])), *tree.children[1:]))
    df = spark.range(3000).select(S.shard_of(F.col("id"), tree).alias("a"), S.shard_of(F.col("id"), changed).alias("b"))
    moved = [(r.a, r.b) for r in df.collect() if r.a != r.b]
    assert moved and all(b < 12 for _, b in moved)  # all enter the region whose weight rose
