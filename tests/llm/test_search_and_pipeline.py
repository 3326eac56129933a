"""op6 against plain scoring, the pipeline stage by stage, and the registered names."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from episcope.llm import search as S
from episcope.llm.repeats import _pack
from episcope.llm.search import top_k
from samples import SCHEMA, documents, folder, patterned, sentence, words
from test_minhash import brute as brute_components
from test_models import INSULTS, brute_statistics
from test_repeats import brute as brute_repeats
from test_tokens import check_packing


def brute_search(rows, queries, k):
    bags = [(i, Counter(w.lower() for w in words(t))) for i, t in rows]
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / len(bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for q, text in queries:
        ranked = []
        for i, b in bags:
            score = 0
            for w in {x.lower() for x in words(text)} & b.keys():
                idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                score += round(idf * (b[w] * 2.2 / (b[w] + 1.2 * (1 - 0.75 + 0.75 * sum(b.values()) / mean))) * 1_000_000)
            if score:
                ranked.append((-score, i))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(ranked)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_bytes", [1500, 1 << 22])
def test_search_equals_plain_scoring(spark, shard_bytes):
    rows = documents() + [(8000 + k, w) for k, w in enumerate(patterned(1 << 15))]  # two long words alike but for a pattern
    asked = rows[::9] + [(2000, None), (2001, ""), rows[-1]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = top_k(df, spark.createDataFrame(list(dict(asked).items()), SCHEMA), k=7, shard_bytes=shard_bytes, lane_bytes=3 * shard_bytes, query_bytes=1 << 12)
    assert sorted(map(tuple, got.collect())) == brute_search(rows, dict(asked).items(), 7)


@pytest.mark.parametrize("common", [0, 3, 1024])
@pytest.mark.parametrize("batch", [1, 200, 1 << 16])
def test_a_shard_scores_batches_of_queries_exactly(monkeypatch, common, batch):
    """Whatever part of the terms goes through the single-precision matrix, ties with the k-th score included."""
    monkeypatch.setattr(S, "COMMON", common)
    monkeypatch.setattr(S, "BATCH", batch)
    r = random.Random(5)
    rows = [(i, sentence(r, r.randint(1, 60))) for i in range(400)] + [(900 + i, "same words here") for i in range(30)] + [(990, ""), (991, None)]
    mean = sum(len(words(t)) for _, t in rows) / len(rows)
    df = Counter(w for _, t in rows for w in {x.lower() for x in words(t)})
    hashes = dict(zip(df, S._words(pa.array(list(df)))[0].tolist()))
    asked = rows[::7] + rows[-3:]
    lists = [sorted({(hashes[x.lower()], df[x.lower()]) for x in words(t)}) for _, t in asked]
    terms = np.array([h for x in lists for h, _ in x], dtype=np.int64)
    idf = np.array([math.log(1 + (len(rows) - d + 0.5) / (d + 0.5)) for x in lists for _, d in x])
    index = S.Index(_pack(pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})), "doc_id", "text", mean)
    want = brute_search(rows, asked, 7)
    for least in (0, 1):
        # Once with nothing held, once with the k-th scores themselves.
        held = np.array([min([s for q, rank, _, s in want if q == i and rank == 7], default=0) for i, _ in asked]) * least
        got = [(asked[q][0], rank, i, s) for q, ids, scores in index.top(terms, idf, np.array([len(x) for x in lists]), 7, held)
               for rank, (i, s) in enumerate(zip(ids.tolist(), scores.tolist()), 1)]
        assert sorted(got) == want


def test_search_in_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert top_k(empty, empty).count() == 0


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    r = random.Random(12)
    rows, labels = [(i, (t or "") if t is None else t) for i, t in documents()], []
    for k in range(200):
        toxic, bad = k % 6 == 0, k % 6 == 1
        text = ". ".join(sentence(r, 12) for _ in range(6))
        text += f". {r.choice(INSULTS)} {sentence(r, 2)}" if toxic else ""
        text = " ".join(w + "##" for w in text.split()) if bad else text
        rows.append((3000 + k, text))
        labels.append((3000 + k, int(not bad), int(toxic)))
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows] + [(2900, None, "en", "s", 0)]
    return folder(spark, tmp_path_factory.mktemp("raw"), full, labels)


def test_pipeline_stage_by_stage(spark, raw, tmp_path):
    docs = spark.read.parquet(f"{raw}/documents.parquet")
    columns = docs.columns
    states = [{r.doc_id: r.text for r in docs.collect()}]
    for n, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, raw).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert docs.columns == columns
            states.append({r.doc_id: r.text for r in docs.collect()})
            assert docs.where("n_chars != char_length(coalesce(text, ''))").count() == 0
    assert [name for name, _ in C.STAGES] == ["toxicity", "quality_rules", "near_duplicates", "substring_dedup", "packing"]
    start, clean, good, single, cut = states
    insulting = {i for i, t in start.items() if any(w in (t or "") for w in INSULTS)}
    assert start.keys() - clean.keys() == insulting
    rejected = {i for i, t in clean.items() if brute_statistics(t)[-1] or "##" in (t or "")}
    assert clean.keys() - good.keys() == rejected
    components = brute_components(list(good.items()), 5, 80)
    assert single.keys() == {i for i, c in components.items() if c[2]}
    repeats = brute_repeats(list(single.items()), "words", 20)
    assert cut == {i: t if not repeats[i][1] else repeats[i][3].decode() for i, t in single.items()}
    check_packing(list(cut.items()), docs.collect(), 4096)


def test_run_equals_the_stages(spark, raw):
    pieces = C.run(spark, raw)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert pieces.count() > 0


def test_extra_columns_pass_through_whatever_their_names(spark, raw, tmp_path):
    from pyspark.sql import functions as F

    extra = {"a.b": F.lit(1.5), "N_Removed": F.col("doc_id") + 7, "score": F.lit("s"), "component id": F.col("doc_id"), "Kept": F.array(F.lit(3))}
    docs = spark.read.parquet(f"{raw}/documents.parquet").select("*", *[v.alias(k) for k, v in extra.items()])
    columns = docs.columns
    for n, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, raw).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert docs.columns == columns, name
            assert docs.where("`a.b` != 1.5 or N_Removed != doc_id + 7 or score != 's' or `component id` != doc_id or Kept[0] != 3").count() == 0, name
    assert docs.count() > 0


def test_run_leaves_no_table_of_an_earlier_stage(spark, raw):
    from episcope import session

    mark = session.scratch_mark()
    pieces = C.run(spark, raw)
    names = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session._WRITTEN[mark:]}
    assert {n for n, _ in C.STAGES[:-1]} <= names and not names & {"sketches", "buckets", "texts", "links", "statistics"}
    assert pieces.count() > 0
    session.release_scratch(spark, since=mark)
    assert session.scratch_mark() == mark


def test_all_queries_are_registered():
    names = entry.queries()
    numbers = defaultdict(list)
    for name in names:
        if name.startswith("op"):
            numbers[int(name[2:].split("_")[0])].append(name)
    assert {k: len(v) for k, v in numbers.items()} == {k: 1 for k in range(1, 14)}
    assert "pipeline" in names and entry.oracle_sql().keys() <= names.keys()


def test_lanes_searched_first_leave_every_result(spark):
    """Sixteen lanes and more, of which some are searched first; several chunks of queries and parts; copies tie with the k-th score."""
    r = random.Random(8)
    rows = [(i, sentence(r, r.randint(5, 60))) for i in range(300)] + [(1000 + i, "copies of one text") for i in range(25)]
    asked = rows[::7] + rows[-2:]
    df = spark.createDataFrame(rows, SCHEMA).repartition(24)
    got = top_k(df, spark.createDataFrame(asked, SCHEMA), k=6, shard_bytes=400, lane_bytes=900, query_bytes=1500, chunk_bytes=4000)
    assert sorted(map(tuple, got.collect())) == brute_search(rows, asked, 6)


def test_chunks_of_queries_are_packed_whole():
    """A chunk keeps every query's terms, under numbers, and puts queries of one kind side by side."""
    terms = [[5, 9, 70], [-3, 9], [], [5, 70, 80], [-3, 8]]
    df = {5: 90, 9: 3, 70: 50, -3: 80, 80: 1, 8: 2}
    table = pa.table({"query_id": [10, 11, 12, 13, 14], "terms": pa.array(terms, pa.list_(pa.int64())),
                      "dfs": pa.array([[df[t] for t in x] for x in terms], pa.list_(pa.int64()))})
    asked = S.Asked.unpack(S.Asked.pack(table), 100)
    ends = np.cumsum(asked.sizes)
    got = {i: asked.known[asked.term[b - s:b]].tolist() for i, s, b in zip(asked.ids.to_pylist(), asked.sizes, ends)}
    assert got == dict(zip(range(10, 15), terms))
    assert abs(asked.ids.to_pylist().index(10) - asked.ids.to_pylist().index(13)) == 1
    assert np.allclose(asked.idf, [math.log(1 + (100 - df[t] + 0.5) / (df[t] + 0.5)) for t in sorted(df)])


def test_only_blocks_of_the_queries_kind_are_multiplied(monkeypatch):
    """Two kinds of documents without a word in common: once k-th scores are held, products take only the blocks of a query's kind."""
    r = random.Random(4)
    rows = [(i, f"{'der' if i % 2 else 'the'} " + " ".join(f"{'d' if i % 2 else 'e'}{r.randint(0, 20)}" for _ in range(30))) for i in range(640)]
    df = Counter(w for _, t in rows for w in set(t.split()))
    hashes = dict(zip(df, S._words(pa.array(list(df)))[0].tolist()))
    asked = rows[:64]
    lists = [sorted((hashes[w], df[w]) for w in set(t.split())) for _, t in asked]
    terms = np.array([h for x in lists for h, _ in x], dtype=np.int64)
    idf = np.array([math.log(1 + (len(rows) - d + 0.5) / (d + 0.5)) for x in lists for _, d in x])
    index = S.Index(_pack(pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})), "doc_id", "text", 31.0)
    want = brute_search(rows, asked, 5)
    held = np.array([s for i, _ in asked for q, rank, _, s in want if q == i and rank == 5])
    seen = []

    class Matrix(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple):
                seen.append(len(key[1]))
            return np.asarray(super().__getitem__(key))

    index.matrix = index.matrix.view(Matrix)
    monkeypatch.setattr(S, "GROUP", 32)
    got = [(asked[q][0], rank, i, s) for q, ids, scores in index.top(terms, idf, np.array([len(x) for x in lists]), 5, held)
           for rank, (i, s) in enumerate(zip(ids.tolist(), scores.tolist()), 1)]
    assert sorted(got) == want
    assert len(seen) == 2 and max(seen) <= index.blocks // 2
