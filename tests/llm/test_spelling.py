"""op13 against brute force: near words by edit, forms, roots, large groups."""

import random
import re
import zlib
from collections import Counter

from samples import documents, folder

from episcope.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_counts(rows):
    out = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 6:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 5}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(counts, ratio=5):
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v)) if vs else None
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else -1) for w in counts)


def result(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def test_groups_of_all_lengths_and_hot_groups_equal_brute_force(spark):
    r = random.Random(4)
    counts = {}
    for k in range(900):
        w = "".join(r.choices("abé", k=r.randrange(1, 9)))
        counts[w] = r.choice([1, 5, 6, 30, 160, 900, 5000])
    for k in range(700):  # one first half, and one last half, with many words
        counts["prefix" + "".join(r.choices("ab", k=6))] = r.randrange(5, 4000)
        counts["".join(r.choices("ab", k=6)) + "suffix"] = r.randrange(5, 4000)
    counts |= {"𝄞clefs": 7, "𝄞clef": 50, "漢字かな交": 9, "漢字かな": 90, "long" * 60: 5, "long" * 60 + "x": 80}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    want = brute(counts)
    assert result(S.variants(df)) == want
    assert result(S.variants(df, group_words=64)) == want
    assert sum(x[1] != "" and x[2] != x[1] for x in want) > 5  # chains


def test_query_equals_brute_force(spark, tmp_path):
    r = random.Random(6)
    base = ["spelling", "variants", "grouping", "écoleécole", "Straßenbahn", "wordform"]
    rows = documents(n=40)
    for k in range(400):
        some = []
        for _ in range(12):
            w = r.choices(base, weights=[40, 20, 10, 5, 5, 2])[0]
            if r.random() < 0.15:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1:], w[:at] + r.choice("xyZÿ") + w[at:], w[:at] + "q" + w[at + 1:]])
            some.append(w)
        rows.append((7000 + k, r.choice([" ", "-", "1", "Ð "]).join(some)))
    rows += [(None, "Spelling spelling spellin"), (7000, "variants VARIANTS"), (9, "ĀspellingĀ " * 10)]
    path = folder(spark, tmp_path, [(i, t, "en", "s", 0) for i, t in rows])
    want = brute(brute_counts(rows))
    assert len(want) > 40 and any(x[1] for x in want)
    df = S.op13_spelling_variants(spark, path)
    assert df.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert result(df) == want


def test_empty_table(spark, tmp_path):
    path = folder(spark, tmp_path, [])
    assert S.op13_spelling_variants(spark, path).count() == 0
