"""op3 and op5 against brute force."""

import hashlib

import pytest

from episcope.llm.repeats import Cover, decode_kept, remove_repeats
from episcope.llm.substring_dedup import WORDS_20, substring_dedup
from episcope.llm.suffix_dedup import BYTES_100, suffix_dedup
from samples import SCHEMA, documents, patterned, words


def brute(rows, unit, length):
    """doc_id -> (units, removed, spans, kept bytes), in order of id (null last)."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        u = (text or "").encode() if unit == "bytes" else words(text)
        gone = [False] * len(u)
        for p in range(len(u) - length + 1):
            key = bytes(u[p:p + length]) if unit == "bytes" else tuple(u[p:p + length])
            if key in seen:
                gone[p:p + length] = [True] * length
            seen.add(key)
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(b for b, g in zip(u, gone) if not g) if unit == "bytes" else b" ".join(w for w, g in zip(u, gone) if not g)
        out[i] = (len(u), sum(gone), spans, kept)
    return out


@pytest.mark.parametrize("cover", [WORDS_20, BYTES_100, Cover("bytes", 100, 73, BYTES_100.residues)], ids=["words", "bytes", "bytes-plain"])
@pytest.mark.parametrize("block_bytes", [2000, 1 << 20])
def test_equals_brute_force(spark, cover, block_bytes):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_units, r.n_removed, r.n_spans, bytes(r.kept))
           for r in remove_repeats(df, cover, block_bytes=block_bytes, keep_text=True).collect()}
    want = brute(rows, cover.unit, cover.length)
    assert got == want
    assert sum(v[1] for v in want.values()) > 0


@pytest.mark.parametrize("cover", [WORDS_20, BYTES_100], ids=["words", "bytes"])
def test_texts_that_differ_in_a_pattern_stay(spark, cover):
    pair = patterned(1 << 14, space=" ")
    rows = [*enumerate(pair), (2, pair[0]), (3, pair[1][:8000] + " other " + pair[0][:3000]), *((k + 10, w) for k, w in enumerate(patterned(1 << 15))),
            *((k + 20, " ".join(w[a:a + 2048] for a in range(0, 1 << 16, 2048))) for k, w in enumerate(patterned(1 << 16, step=16)))]
    got = {r.doc_id: (r.n_units, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(spark.createDataFrame(rows, SCHEMA), cover, keep_text=True).collect()}
    want = brute(rows, cover.unit, cover.length)
    assert got == want and want[1][1] == 0 and want[2][1] == want[2][0] and want[3][1] > 0 and want[11][1] == want[21][1] == 0


def test_digest_is_of_the_kept_bytes(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    for r in remove_repeats(df, WORDS_20, keep_text=True).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_repeats_inside_one_text_and_repeated_rows(spark):
    line = "a b c d e f g h i j k l m n o p q r s t"
    df = spark.createDataFrame([(1, f"{line} {line}"), (2, line), (2, line), (None, line)], SCHEMA)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_removed) for r in substring_dedup(df).collect())
    assert got == [((False, 1), 20), ((False, 2), 20), ((False, 2), 20), ((True, 0), 20)]


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x y", 5, 7)], "doc_id long, text string, n_removed long, block long")
    row = substring_dedup(df).first().asDict()
    assert row["n_removed"] == 0 and row["block"] == 7 and row["n_units"] == 2
    clash = substring_dedup(df.withColumnRenamed("n_removed", "N_Removed")).select("n_removed", "block").first()
    assert tuple(clash) == (0, 7)
    assert suffix_dedup(df.where("doc_id > 5")).count() == 0


def test_unremoved_texts_stay_as_they_are(spark):
    df = substring_dedup(spark.createDataFrame([(1, " a \n b "), (2, None)], SCHEMA)).withColumn("text", decode_kept("text"))
    assert sorted((r.doc_id, r.text) for r in df.collect()) == [(1, " a \n b "), (2, None)]


def test_a_cover_must_cover(spark):
    with pytest.raises(ValueError):
        Cover("words", 20, 13, (0, 1, 3))
