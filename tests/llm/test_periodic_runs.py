"""op11 against brute force: runs by definition, the planted tails, whole texts."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from samples import documents, folder, words
from pyspark.sql import functions as F

from episcope.llm import periodic_runs as P


def brute_runs(w, min_length=6, min_exponent=4):
    """Every stretch by its definition."""
    out = {}
    n = len(w)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i:
                length = j - i + q
                if length >= max(min_length, min_exponent * q):
                    out.setdefault((i, length), q)  # smaller periods come first
            i = max(j, i) + 1
    return sorted((i, length, q) for (i, length), q in out.items())


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute_row(doc_id, text):
    w = planted(doc_id, words(text))
    runs = brute_runs(w)
    gone = {k for i, length, q in runs for k in range(i + q, i + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None
    lines = "".join(f"{i},{length},{q}\n" for i, length, q in runs).encode()
    kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_equal_brute_force_on_small_alphabets():
    r = random.Random(3)
    for _ in range(1500):
        n = r.randrange(0, 60)
        w = [r.randrange(r.choice([1, 2, 3])) for _ in range(n)]
        if r.random() < 0.5 and n > 8:
            p = r.randrange(1, 6)
            a = r.randrange(n)
            w = w[:a] + [w[a + (k - a) % p] if a + (k - a) % p < a + p and a + (k - a) % p < n else 0 for k in range(a, n)]
        for least, times in ((6, 4), (2, 2), (10, 3)):
            assert P.runs_of(np.array(w, dtype=np.int64), least, times) == brute_runs(w, least, times), (w, least, times)


def test_long_hot_document_is_not_quadratic():
    for unit, n in (([0], 200_000), ([0, 1, 2], 200_000), ([0, 0, 1, 0, 0, 1, 2], 140_000)):
        w = np.array(unit * (n // len(unit)), dtype=np.int64)
        got = P.runs_of(w)
        assert (0, len(w), len(unit)) in got
    r = random.Random(5)
    w = []
    for _ in range(20_000):  # many short runs of one word after different words
        w += [r.randrange(10, 10_000)] + [1] * r.randrange(3, 9)
    assert len(P.runs_of(np.array(w, dtype=np.int64))) == sum(1 for x in brute_runs_of_ones(w))


def brute_runs_of_ones(w):
    k = 0
    while k < len(w):
        e = k
        while e < len(w) and w[e] == w[k]:
            e += 1
        if e - k >= 6:
            yield k
        k = e


def test_query_equals_brute_force(spark, tmp_path):
    r = random.Random(8)
    rows = documents(n=40)
    rows += [(3000 + k, " ".join(r.choices(["x", "y", "zz"], k=r.randrange(1, 80)))) for k in range(60)]
    rows += [(4000, "a " * 30_000), (4001, "\tone two\x0bone two\none two one two  one two one"), (None, "w w w w w w w"), (4002, "b b b"), (4002, "b b b")]
    path = folder(spark, tmp_path, [(i, t, "en", "s", 0) for i, t in rows])
    got = P.op11_periodic_runs(spark, path).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *brute_row(i, t)) for i, t in rows if i is not None and len(t or "") < 20_000), key=str)
    have = sorted((tuple(x[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))
                   for x in got if x.doc_id is not None and x.doc_id not in {i for i, t in rows if len(t or "") >= 20_000}), key=str)
    assert have == want
    assert sum(x[1] > 0 for x in want) > 10
    nobody = next(x for x in got if x.doc_id is None)
    assert (nobody.n_runs, nobody.start, nobody.length, nobody.period, nobody.exponent_milli) == (1, 0, 7, 1, 7000)


def test_general_interface_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b a b a b a b c", "x", 5), (2, None, None, None)], "k long, body string, Runs string, `a.b` int")
    got = {r.k: r for r in P.periodic_runs(df, text_col="body").collect()}
    assert got[1]["runs"] == [(0, 8, 2)] and got[1]["collapsed"] == "a b c" and got[1]["a.b"] == 5 and got[1]["best"] == (0, 8, 2)
    assert got[2]["runs"] == [] and got[2]["collapsed"] == "" and got[2]["best"] is None and got[2]["n_words"] == 0
    assert P.periodic_runs(df.where("k > 5"), text_col="body").count() == 0
    long = P.periodic_runs(df, text_col="body", min_length=4, min_exponent=2).where(F.col("k") == 1).first()
    assert long["runs"] == [(0, 8, 2)]
