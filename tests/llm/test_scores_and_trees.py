"""op1's score and op10's descent, computed row by row from their definitions."""

import math
import random
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from episcope.llm import sharding as S
from episcope.llm import toxicity as X
from samples import documents, sentence

SCHEMA = "doc_id long, text string"


# ---------------------------------------------------------------- op10

def draw(key, node):
    """The exponential draw of a subtree: xxhash64 of the key's 8 bytes, then of the name's 4, from seed 42."""
    seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    bits = xxhash.xxh64_intdigest(struct.pack("<i", node.name), seed=seed) >> 11
    return -math.log((bits + 0.5) * 2.0 ** -53) / node.weight


def descend(key, node):
    while node.children:
        node = min((c for c in node.children if c.weight > 0), key=lambda c: draw(key, c))
    return node.shard


def uneven():
    leaf = lambda s, w: S.Node(900 + s, shard=s, leaf_weight=w)
    racks = [S.Node(100 + k, tuple(leaf(3 * k + j, 1.0 + j * (k + 1)) for j in range(3))) for k in range(4)]
    idle = S.Node(150, (leaf(12, 0.0), leaf(13, 0.0)))
    return S.Node(1, (S.Node(10, tuple(racks[:1])), S.Node(11, (*racks[1:], idle))))


@pytest.mark.parametrize("tree", [S.even_tree(), S.grow(S.even_tree()), uneven()], ids=["even", "grown", "uneven"])
def test_shards_equal_the_descent_by_hand(spark, tree):
    r = random.Random(3)
    keys = [None, 0, -1, 2 ** 63 - 1, -2 ** 63, *(r.randrange(-2 ** 63, 2 ** 63) for _ in range(1500)), *range(500)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", S.shard_of(F.col("k"), tree).alias("s")).collect()
    assert [(x.k, x.s) for x in got] == [(k, descend(k, tree)) for k in keys]


def test_shares_follow_the_weights(spark):
    tree = uneven()
    n = 40_000
    got = {x.s: x.n for x in spark.range(n).groupBy(S.shard_of(F.col("id"), tree).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(got) == list(range(12))
    for region in tree.children:
        for rack in region.children:
            for leaf in rack.children:
                want = n * region.weight / tree.weight * rack.weight / region.weight * (leaf.weight / rack.weight if rack.weight else 0)
                assert abs(got.get(leaf.shard, 0) - want) <= 5 * math.sqrt(want + 1)


def test_sharding_of_an_empty_table_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "a", 9, 9)], "doc_id long, text string, Shard int, slot int")
    got = S.assign(rows, S.even_tree()).collect()
    assert [(x.doc_id, x.size, x.slot) for x in got] == [(1, 9, 0)] and got[0].shard == descend(1, S.even_tree())
    assert S.assign(rows.where("doc_id > 1"), S.even_tree()).count() == 0


# ---------------------------------------------------------------- op1

def kernel(s, t):
    """Common subsequences of length 3, by the characters they span in both (sums over their last characters)."""
    n, m = len(s), len(t)
    ends = {(i, j): X.DECAY ** 2 for i in range(n) for j in range(m) if s[i] == t[j]}
    for _ in range(2):
        ends = {(i, j): sum(v * X.DECAY ** (i - a + j - b) for (a, b), v in ends.items() if a < i and b < j)
                for i in range(n) for j in range(m) if s[i] == t[j]}
    return sum(ends.values())


def naive_score(text, model):
    """A text's score, sentence by sentence and word by word."""
    own = [kernel(a, a) for a in model.landmarks]
    sentences, ended = [], True
    for token in (text or "").lower().replace("\n", " . ").split():
        if ended:
            sentences.append([])
        sentences[-1].append(token)
        ended = token[-1] in ".!?"
    margins = []
    for tokens in sentences:
        words, run = [X.unit(t) for t in tokens], []
        for k, t in enumerate([*tokens, ""]):
            if t and len(X.unit(t)) == 2 and t[-1] not in ".!?":
                run.append(t)
                continue
            words += [X.unit("".join(run))] * (len(run) >= 3)
            run = []
        row = [max((min(1.0, max(kernel(p, a) for p in X.windows(w)) / o) for w in words if w), default=0.0) ** X.POWER
               for a, o in zip(model.landmarks, own)]
        margins.append(float(np.dot(row, model.weights)) + model.bias)
    best = (sorted(margins, reverse=True) + [model.bias] * 3)[:3]
    z = float(np.dot([*best, math.log1p(len(sentences)), 1.0], model.document))
    return 1 / (1 + math.exp(-z))


def test_scores_equal_their_definition(spark):
    r = random.Random(4)
    marks = ["^worthless", "^idiot", "^réeu", "^achliche"]
    model = X.Model(marks, np.array([1.5, 2.0, 0.7, -0.4]), -0.8, np.array([1.2, 0.3, 0.2, -0.1, -0.5]))
    texts = [t for _, t in documents(n=12) if t is None or len(t) < 400]
    texts += ["You i-d-i-o-t. bada nilo!", "you i d i o t there", "w.orthless bada\n\nréeuxé", "idiotidiot" * 5, "...", "? ! .", "a b. c d e f"]
    texts += [f"{sentence(r, 4)} {r.choice(['worthles', 'IDIOTS', 'achlichen', 'i.diot'])} {sentence(r, 3)}. {sentence(r, 5)}" for _ in range(10)]
    got = X.score(spark.createDataFrame(list(enumerate(texts)), SCHEMA).coalesce(1), model).orderBy("doc_id").collect()
    want = [naive_score(t, model) for t in texts]
    assert np.allclose([x.score for x in got], want, atol=1e-4)
    assert max(want) - min(want) > 0.2
