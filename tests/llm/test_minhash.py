"""op2 against brute force, and the sketch's guarantees."""

from collections import Counter

import numpy as np

from episcope.llm import minhash as M
from episcope.llm.graph import components
from samples import SCHEMA, documents, folder, patterned, words


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = [x.lower() for x in words(t)]
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            same = len(sets[i] & sets[j])
            if same and 100 * same >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_equals_brute_force(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA)
    for words_, chunk in ((4, 256), (5, 7)):
        M.CHUNK_ROWS, before = chunk, M.CHUNK_ROWS
        try:
            got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df, words_, 80).collect()}
        finally:
            M.CHUNK_ROWS = before
        assert got == brute(rows, words_, 80)


def test_long_words_that_differ_in_a_pattern_are_not_linked(spark):
    rows = [*enumerate(patterned(1 << 15)), *((k + 10, f"one two three four five {w}") for k, w in enumerate(patterned(1 << 11, step=8)))]
    rows += [(20, rows[0][1].upper())]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(spark.createDataFrame(rows, SCHEMA), 4, 80).collect()}
    assert got == brute(rows, 4, 80) and got[1][1] == 1 and got[11][1] == 11 and got[20][1] == 0


def test_nulls_repeated_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f g"), (None, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A B C D E F G"), (3, None), (4, "")],
                               "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in M.near_duplicates(df, 4).collect())
    assert got == [(False, 1, 1, True), (False, 2, 1, False), (False, 3, 3, True), (False, 4, 4, True), (True, 0, None, True)]
    assert M.near_duplicates(df.where("doc_id > 99"), 4).count() == 0


def test_the_query_gives_each_row_without_id_its_own_result(spark, tmp_path):
    texts = [(None, "a b c d e f g"), (None, "a b c d e f g"), (None, "a b c d e"), (None, None), (1, "a b c d e f g"), (1, "a b"), (2, "A b c d e f g")]
    got = M.op2_minhash_near_dedup(spark, folder(spark, tmp_path, [(i, t, "en", "s", 0) for i, t in texts])).collect()
    want = [(None, 4, None, True)] * 2 + [(None, 2, None, True), (None, 0, None, True), (1, 4, 1, True), (2, 4, 1, False)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_every_coordinate_fills_and_estimates(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [base[:1], base[:3], base[:300], base[60:360], base]
    at = np.cumsum([0, *map(len, sets)])
    sketch = M.fill(np.concatenate(sets), at, 200)
    assert (sketch != np.iinfo(np.uint64).max).all()
    share = (sketch[2] == sketch[3]).mean()  # Jaccard 240 / 360
    assert abs(share - 2 / 3) < 0.15


def test_intersections_match_sets():
    rng = np.random.default_rng(2)
    a = [np.unique(rng.integers(0, 50, 20)).astype(np.uint64) for _ in range(9)]
    b = [np.unique(rng.integers(0, 50, 20)).astype(np.uint64) for _ in range(4)]
    cat = lambda s: (np.concatenate(s), np.cumsum([0, *map(len, s)]))
    got = M.intersections(*cat(a), *cat(b), width=7)
    assert [[len(set(x) & set(y)) for y in map(list, b)] for x in map(list, a)] == got.tolist()


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert Counter(got.values())[1] == 40
