"""Small documents with the awkward cases: nulls, empty and long texts, copies, near copies, shared passages."""

import os
import random
import re

# Python workers import the package from here, wherever pytest was started.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = f"{_ROOT}:{os.environ.get('PYTHONPATH', '')}".rstrip(":")

WORDS = [a + b + c for a in "bdfgklmnprst" for b in ("a", "e", "o", "an", "ir") for c in ("", "lo", "mi", "t")]
SCHEMA = "doc_id long, text string"


def sentence(r, n):
    return " ".join(r.choices(WORDS, k=n))


def documents(seed=5, n=60):
    r = random.Random(seed)
    passage = sentence(r, 55)
    rows = []
    for i in range(n):
        text = sentence(r, r.choice([3, 30, 80, 200]))
        if i % 7 == 3:
            text = text + "\n" + passage + "  \t" + sentence(r, 9)
        if i % 11 == 5 and rows:
            text = rows[-3][1]
        if i % 13 == 6 and rows:
            w = (rows[-2][1] or "x").split(" ")
            w[len(w) // 2] = "CHANGED"
            text = " ".join(w)
        rows.append((i * 3, text))
    family = sentence(r, 150).split(" ")
    for i in range(40):  # near copies of one text, with few or many edits
        w = list(family)
        for _ in range(r.choice([0, 1, 2, 4, 8])):
            w[r.randrange(len(w))] = r.choice(WORDS)
        rows.append((1000 + i, " ".join(w)))
    rows += [(2000, None), (2001, ""), (2002, " \n\t "), (2003, "One"), (2004, "one"), (2005, "é" * 300 + " ß漢字 " * 40),
             (2006, " ".join(["again and"] * 90)), (2007, sentence(r, 6000)), (-5, passage)]
    return rows


def patterned(size, step=64, space=""):
    """Two texts that differ at every ``step``-th place, in the pattern that sums of powers modulo 2**64 can't tell apart."""
    r = random.Random(size)
    body = [r.choice("cdefghij") for _ in range(size)]
    for k in range(7, size, 9 if space else size):
        body[k] = space
    out = []
    for turn in (0, 1):
        text = list(body)
        for k in range(0, size, step):
            text[k] = "ab"[(bin(k // step).count("1") + turn) % 2]
        out.append("".join(text))
    return out


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())


def folder(spark, path, documents_, labels=None):
    """A data folder with a documents table (and labels) for the pipeline's stages."""
    spark.createDataFrame(documents_, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    if labels is not None:
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)
