"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks.

**Kernel.**  The gap-weighted subsequence kernel of order 3 (decay 0.7 a
character spanned) compares a word with a landmark string; it counts common
subsequences, so inserted, dropped or separating characters only lower it.
Words are lower-cased, get a ``^`` in front, lose what is no letter or digit,
and single letters that follow one another are read as one word.  Long words
are compared in overlapping windows; no text is cut.

**Landmarks.**  The word beginnings whose document frequency is most tied to
the label, counted by Spark over the training rows.  Their number is a parameter
of the model; no beginning enters whose kernel with ``VARIANTS`` earlier ones
is ``NEAR`` or more (of 1), so that variants of one stem leave room for others.

**Features.**  ``s(sentence, landmark)`` is the greatest kernel value of its
words, over the landmark's own, cubed to sharpen it; the Nystroem map multiplies
by the inverse square root of the landmarks' kernel matrix.

**SVM.**  Trained on sentences.  A labelled text's sentences inherit its
label; a toxic text is only known to hold one toxic sentence, so its
best-scoring sentence stands for it and is chosen anew after every fit.  A
text's score is a logistic function, fitted on the training rows, of the
margins of its three best sentences and the logarithm of their number.

Training reads at most ``max_rows`` labelled rows of each label (the least by
hash of id), of each at most ``max_sentences`` sentences, those nearest to any
landmark, and chooses landmarks among the ``max_stems`` beginnings of greatest
gain; None lifts each of the three.  Scoring reads every whole text; its only
state is the model and a table of ``REMEMBERED_BYTES`` of seen words.

Defined cases: a null or empty text has no sentence and scores as a sentence
without any similarity; null ids are scored and never trained on; repeated rows
are scored alike; ids with several labels count once for each; without rows of
both labels every score is 0; empty tables give an empty result; other columns
are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, read_table, text_slices

DECAY, ORDER, POWER = 0.7, 3, 3
LANDMARKS, STEMS = 32, (4, 13)
NEAR, VARIANTS = 0.5, 2
MAX_ROWS, MAX_SENTENCES, MAX_STEMS = 6000, 8, 4000
WINDOW = 24
REMEMBERED_BYTES, ALONE_BYTES, SLICE = 96 << 20, 216 << 20, 1 << 19


# ---------------------------------------------------------------- the kernel

def _codes(strings: list[str], width: int) -> np.ndarray:
    raw = "".join(s.ljust(width, "\0") for s in strings).encode("utf-32-le")
    return np.frombuffer(raw, dtype=np.uint32).reshape(len(strings), width)


def subsequence_kernel(strings: list[str], others: list[str], decay: float = DECAY) -> np.ndarray:
    """Gap-weighted common subsequences of length 3: one row per string, one column per other."""
    out = np.zeros((len(strings), len(others)), dtype=np.float32)
    if not strings or not others:
        return out
    wide = max(map(len, others))
    right = _codes(others, wide)
    step = np.arange(wide)
    decays = np.where(step[None, :] >= step[:, None], decay ** (step[None, :] - step[:, None]), 0).astype(np.float32)
    # Per character its matches in the others (nothing for a character that none has), and those decayed.
    letters = np.unique(right[right > 0])
    same = np.concatenate([(right[None] == letters[:, None, None]) * np.float32(decay * decay), np.zeros((1, *right.shape))]).astype(np.float32)
    faded = same @ decays
    sizes = np.array([len(s) for s in strings])
    for size in np.unique(sizes):
        if size < ORDER:
            continue
        rows = np.flatnonzero(sizes == size)
        for a in range(0, len(rows), 256):
            part = rows[a:a + 256]
            left = _codes([strings[k] for k in part], int(size))
            at = np.minimum(np.searchsorted(letters, left), len(letters) - 1)
            at = np.where(letters[at] == left, at, len(letters))
            one = np.zeros((len(part), len(others), wide), dtype=np.float32)  # orders 1 and 2
            two, total = np.zeros_like(one), np.zeros((len(part), len(others)), dtype=np.float32)
            for i in range(size):
                now = same[at[:, i]]
                total += np.einsum("abc,abc->ab", now[:, :, 1:], two[:, :, :-1])
                now[:, :, 1:] *= one[:, :, :-1]
                now[:, :, 0] = 0
                two *= decay
                two += (now.reshape(-1, wide) @ decays).reshape(now.shape)
                one *= decay
                one += faded[at[:, i]]
            out[part] = total
    return out


_NO_LETTER = re.compile(r"[\W_]+")


def unit(token: str) -> str:
    """A word as the kernel reads it: composed, letters and digits only, ``^`` in front."""
    kept = _NO_LETTER.sub("", unicodedata.normalize("NFC", token))
    return "^" + kept if kept else ""


def windows(word: str) -> list[str]:
    """The word, or windows of it of which any run of 12 characters lies in one."""
    if len(word) <= WINDOW:
        return [word]
    return [word[k:k + WINDOW] for k in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


@dataclass
class Model:
    """Landmarks, their own kernel values, and the SVM: margin = features @ weights + bias."""

    landmarks: list[str]
    weights: np.ndarray  # on the similarities: the Nystroem map times the SVM's weights
    bias: float
    document: np.ndarray  # weights of evidence()

    def score(self, margins: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores of texts with sentence ``margins[at[k]:at[k+1]]``, out of ``counts[k]`` sentences."""
        return _logistic(evidence(margins, at, counts, self.bias) @ self.document)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def evidence(margins: np.ndarray, at: np.ndarray, counts: np.ndarray, none: float) -> np.ndarray:
    """Per text: its three greatest margins (``none`` where it has fewer), log(1 + sentences), 1."""
    n = len(at) - 1
    out = np.full((n, 5), none, dtype=float)
    doc = np.repeat(np.arange(n), np.diff(at))
    order = np.lexsort((-margins, doc))
    rank = np.arange(len(doc)) - np.repeat(at[:-1], np.diff(at))
    top = rank < 3
    out[doc[top], rank[top]] = margins[order[top]]
    out[:, 3], out[:, 4] = np.log1p(counts), 1
    return out


class Similarities:
    """Per token its similarity to each landmark, remembered (a bounded table)."""

    def __init__(self, landmarks: list[str], remembered_bytes: int = REMEMBERED_BYTES):
        self.landmarks = landmarks
        # A token holds about 300 bytes in strings and tables, and a row of similarities.
        self.most = remembered_bytes // (300 + 4 * len(landmarks))
        self.own = np.maximum(np.diag(subsequence_kernel(landmarks, landmarks)), 1e-9) if landmarks else np.ones(0)
        self._reset()

    def _reset(self) -> None:
        m = len(self.landmarks)
        self.row: dict[str, int] = {}
        self.units: dict[str, int] = {}
        self.unit_rows = np.zeros((1, m), dtype=np.float32)  # row 0: no letter
        self.of = np.zeros(0, dtype=np.int64)
        self.ends = np.zeros(0, dtype=bool)
        self.single = np.zeros(0, dtype=bool)

    def of_words(self, words: list[str]) -> np.ndarray:
        parts = [windows(w) for w in words]
        flat = [p for ps in parts for p in ps]
        s = subsequence_kernel(flat, self.landmarks) / self.own
        heads = np.cumsum([0, *(len(p) for p in parts)])[:-1]
        s = np.maximum.reduceat(s, heads, axis=0) if len(flat) else np.zeros((0, len(self.landmarks)), dtype=np.float32)
        return np.minimum(s, 1.0).astype(np.float32) ** POWER

    def learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.row]
        if len(self.row) + len(new) > self.most:
            self._reset()
            new = list(tokens)
        if not new:
            return
        made = [unit(t) for t in new]
        fresh = list({u for u in made if u and u not in self.units})
        if fresh:
            base = len(self.unit_rows)
            self.unit_rows = np.concatenate([self.unit_rows, self.of_words(fresh)])
            self.units.update(zip(fresh, range(base, base + len(fresh))))
        start = len(self.row)
        self.row.update(zip(new, range(start, start + len(new))))
        self.of = np.concatenate([self.of, np.array([self.units.get(u, 0) for u in made], dtype=np.int64)])
        self.ends = np.concatenate([self.ends, np.array([t[-1] in ".!?" for t in new])])
        self.single = np.concatenate([self.single, np.array([len(u) == 2 for u in made])])

    def sentences(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """One row of similarities per sentence of all texts, and the n+1 offsets of texts into them.

        A sentence ends at a line's end or after a token that ends in ``.!?``.
        """
        split = [(t or "").lower().replace("\n", " . ").split() for t in texts]
        joined = []
        self.learn(set().union(*split)) if split else None
        ids = [np.fromiter(map(self.row.__getitem__, s), dtype=np.int64, count=len(s)) for s in split]
        for k, x in enumerate(ids):  # letters set apart: "i d i o t"
            flags = self.single[x] & ~self.ends[x]
            if len(x) >= 3 and (flags[2:] & flags[1:-1] & flags[:-2]).any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
                joined += [(k, a, "".join(split[k][a:b])) for a, b in zip(edges[::2], edges[1::2]) if b - a >= 3]
        extra = self.of_words([unit(w) for _, _, w in joined]) if joined else None
        at = np.cumsum([0, *map(len, ids)])
        every = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
        values = self.unit_rows[self.of[every]]
        for e, (k, a, _) in enumerate(joined):
            values[at[k] + a] = np.maximum(values[at[k] + a], extra[e])
        if not len(every):
            return values, np.zeros(len(texts) + 1, dtype=np.int64)
        head = np.concatenate([[True], self.ends[every][:-1]])
        inner = at[:-1][np.diff(at) > 0]
        head[inner] = True
        heads = np.flatnonzero(head)
        return np.maximum.reduceat(values, heads, axis=0), np.searchsorted(heads, at)


# ---------------------------------------------------------------- learning

def in_training(id_column: Column) -> Column:
    """Whether labels may be learned from the row: crc32 of the id's text modulo 4 is not 2."""
    return F.crc32(id_column.cast("string").cast("binary")) % 4 != 2


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int | None) -> DataFrame:
    """(doc_id, toxic, text) of at most ``max_rows`` training rows of each label (None: of all)."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & in_training(F.col("doc_id"))).select("doc_id", "toxic")
    if max_rows is None:
        return docs.select("doc_id", "text").join(usable, "doc_id")
    order = F.xxhash64("doc_id")
    some = usable.where("toxic = 1").orderBy(order).limit(max_rows).unionByName(usable.where("toxic = 0").orderBy(order).limit(max_rows))
    # At most 2 * max_rows ids: a bounded broadcast, so the texts are not shuffled.
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")


def choose_landmarks(rows: DataFrame, most: int = LANDMARKS, max_stems: int | None = MAX_STEMS) -> list[str]:
    """Word beginnings by how much their documents' labels tell them from the rest."""
    low, high = STEMS

    def stems(batches):
        for batch in batches:
            out_stem, out_toxic = [], []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = {unit(t) for t in set((text or "").lower().split())}
                found = {w[:n] for w in words for n in range(low, min(high, len(w)) + 1)}
                out_stem += found
                out_toxic += [toxic] * len(found)
            yield pa.RecordBatch.from_pydict({"stem": pa.array(out_stem, pa.string()), "toxic": pa.array(out_toxic, pa.int64())})

    counts = (rows.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(stems, "stem string, toxic long")
              .groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")))
    total = rows.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    lift = (F.col("t") + 0.5) / (F.col("c") + 0.5) * (((total.c or 0) + 1) / ((total.t or 0) + 1))
    gain = F.col("t") * F.log(lift)
    best = counts.where("t >= 3").where(lift >= 4).orderBy(gain.desc(), F.length("stem").desc(), "stem")
    stems_ = [r.stem for r in (best if max_stems is None else best.limit(max_stems)).collect()]
    own = np.concatenate([np.diag(subsequence_kernel(p, p)) for p in (stems_[a:a + 64] for a in range(0, len(stems_), 64))] or [np.zeros(0)])
    near, chosen = np.zeros(len(stems_), dtype=np.int64), []
    for k, stem in enumerate(stems_):
        if len(chosen) < most and near[k] < VARIANTS and not any(stem.startswith(c) or c.startswith(stem) for c in chosen):
            chosen.append(stem)
            near += subsequence_kernel(stems_, [stem])[:, 0] >= NEAR * np.sqrt(own * own[k])
    return chosen


def _fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 25) -> np.ndarray:
    """Squared-hinge linear SVM by Newton's method; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        live = y * (x @ w) < 1
        xs, cs = x[live], cost[live]
        new = np.linalg.solve(ridge + (xs * cs[:, None]).T @ xs, (xs * cs[:, None]).T @ y[live])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int | None = MAX_ROWS, max_sentences: int | None = MAX_SENTENCES,
          max_stems: int | None = MAX_STEMS) -> Model | None:
    rows = training_rows(docs, labels, max_rows)
    landmarks = choose_landmarks(rows, max_stems=max_stems)
    if not landmarks:
        return None

    def features(batches):
        table = Similarities(landmarks)
        for batch in batches:
            texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
            for a in range(0, len(texts), 100):
                values, at = table.sentences(texts[a:a + 100])
                ids, labels_, counts, kept = [], [], [], []
                for k in range(len(at) - 1):
                    part = values[at[k]:at[k + 1]]
                    part = part[np.argsort(-part.max(axis=1), kind="stable")[:max_sentences]] if len(part) else np.zeros((1, len(landmarks)), dtype=np.float32)
                    ids += [batch.column("doc_id")[a + k].as_py()] * len(part)
                    labels_ += [toxic[a + k]] * len(part)
                    counts += [int(at[k + 1] - at[k])] * len(part)
                    kept.append(part.astype("<f4"))
                flat = np.concatenate(kept)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "toxic": pa.array(labels_, pa.int32()), "n": pa.array(counts, pa.int64()),
                                                  "s": pa.array([v.tobytes() for v in flat], pa.binary())})

    got = (rows.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
           .mapInArrow(features, "doc_id long, toxic int, n long, s binary").toPandas().sort_values(["doc_id", "s"], kind="stable"))
    if got["toxic"].nunique() < 2:
        return None
    s = np.frombuffer(b"".join(got["s"]), dtype="<f4").reshape(len(got), -1).astype(float)
    doc, y = got["doc_id"].to_numpy(), np.where(got["toxic"].to_numpy() == 1, 1.0, -1.0)
    gram = (subsequence_kernel(landmarks, landmarks) / np.sqrt(np.outer(*[np.diag(subsequence_kernel(landmarks, landmarks))] * 2))) ** POWER
    value, vector = np.linalg.eigh(gram.astype(float))
    nystroem = vector / np.sqrt(np.maximum(value, 1e-3)) @ vector.T
    x = s @ nystroem
    heads = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (y[1:] != y[:-1])]))
    bag = np.repeat(np.arange(len(heads)), np.diff([*heads, len(doc)]))
    rank = s.sum(axis=1)
    w = np.zeros(x.shape[1] + 1)
    for _ in range(8):
        order = np.lexsort((-rank, bag))
        witness = np.zeros(len(x), dtype=bool)
        witness[order[np.flatnonzero(np.concatenate([[True], bag[order][1:] != bag[order][:-1]]))]] = True
        use = (y < 0) | witness
        new = _fit_svm(x[use], y[use], np.where(y[use] > 0, 1.0, 0.5))
        rank = x @ new[:-1] + new[-1]
        if np.allclose(new, w, atol=1e-5):
            break
        w = new
    facts = evidence(x @ w[:-1] + w[-1], np.append(heads, len(doc)), got["n"].to_numpy()[heads], float(w[-1]))
    return Model(landmarks, nystroem @ w[:-1], float(w[-1]), _fit_logistic(facts, (y[heads] > 0).astype(float)))


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a ridge on all but the last weight."""
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(60):
        p = _logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w = w - np.clip(step, -2, 2)
    return w


# ---------------------------------------------------------------- scoring

def score(docs: DataFrame, model: Model | None, text_col: str = "text", out_col: str = "score",
          remembered_bytes: int = REMEMBERED_BYTES) -> DataFrame:
    """The rows of ``docs`` with their score, 0 to 1, as ``out_col`` (in place of an input column of that name).

    A task forgets its seen words beyond ``remembered_bytes`` and meets them as new: more memory, less time."""
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != out_col.lower()])
    if model is None:
        return source.withColumn(out_col, F.lit(0.0))

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = Similarities(model.landmarks, remembered_bytes)
        for column in texts:
            out = []
            for a, b in text_slices(column, SLICE):
                values, at = table.sentences(column.slice(a, b - a).to_pylist())
                out.append(model.score(values @ model.weights + model.bias, at, np.diff(at)))
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())
        del table
        give_back()

    # Only the text goes to Python and only the score comes back; the rows stay in the JVM.
    return source.withColumn(out_col, scores(F.col(f"`{text_col}`").cast("string")))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    # On its own the query may remember more than a stage among others.
    scored = score(docs, train(docs, read_table(spark, sf_dir, "labels")), remembered_bytes=ALONE_BYTES)
    return scored.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
