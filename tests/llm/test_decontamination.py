"""op12 against brute force: whole windows, short items, awkward texts."""

import hashlib
import random
import re

from samples import documents, sentence

from episcope.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    wins = []
    for item, text in items:
        w = words(text)
        if w:
            wins += [(item, tuple(w[s:s + window])) for s in range(max(len(w) - window, 0) + 1)]
    out = []
    for i, text in docs:
        w, hit, names = words(text), set(), set()
        for item, win in wins:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    names |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(r):
    items = [(k, sentence(r, r.choice([9, 10, 11, 25, 40]))) for k in range(12)]
    items += [(100, "Ünïque WORD"), (101, "solo"), (102, None), (103, " .,; "), (104, items[3][1]), (None, sentence(r, 12)), (9, sentence(r, 14)),
              (105, "again and " * 12), (106, "three word item")]
    docs = documents(n=30)
    for k, (_, text) in enumerate(items):
        w = (text or "x").split()
        docs.append((5000 + k, sentence(r, 20) + "\n" + (text or "") + "; " + sentence(r, 5)))
        docs.append((5100 + k, " -- ".join(w).upper()))
        docs.append((5200 + k, " ".join(w[:-1]) + " other " + sentence(r, 4)))  # less than whole, unless windows of 10 fit
        docs.append((5300 + k, text))
    docs += [(None, items[0][1]), (5000, items[1][1]), (5000, items[1][1]), (6000, "a solo b ünïque word c SOLO"), (6001, "ÜNÏQUE word"), (6002, "x " * 20_000 + items[4][1])]
    return docs, items


def test_equals_brute_force_with_one_and_with_many_slices(spark):
    docs, items = tables(random.Random(12))
    d = spark.createDataFrame([(i, t, "extra") for i, t in docs], "doc_id long, text string, n_words string").repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert sum(x[-1] for x in want) > 40
    for slice_rows in (100_000, 37):
        got = D.contamination(d, b, slice_rows=slice_rows).collect()
        have = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0)
                       for r in got), key=str)
        assert have == want
        assert all(sum(e - s for s, e in r.spans) == r.n_hit and all(x[1] < y[0] for x, y in zip(r.spans, r.spans[1:])) for r in got)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert D.contamination(d.where("doc_id > 9"), b).count() == 0
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"], r.spans) for r in D.contamination(d, b.where("item_id > 9")).collect()) == [
        (1, 2, 0, [], []), (2, 0, 0, [], [])]


def test_query_equals_its_sql_and_uses_no_python(spark):
    import duckdb

    path = "/root/testdata/sf0.001"
    df = D.op12_decontamination(spark, path)
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{path}/{t}.parquet'")
    rel = con.sql(D.OP12_SQL)
    assert sorted(map(str, (tuple(r) for r in df.select(*rel.columns).collect()))) == sorted(map(str, rel.fetchall()))
