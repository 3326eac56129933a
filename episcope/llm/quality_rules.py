"""Quality rules: learned decision lists over text statistics.

``statistics`` are built-in column expressions over the whole text.  ``learn``
grows a decision list by sequential covering: each rule is a conjunction of
thresholds (``feature >= t`` or ``feature <= t``) grown by FOIL gain on two
thirds of the labelled rows, pruned from the end on the last third, and
accepted only if it is precise there; the rows it covers are then set aside.
Thresholds come from quantiles and go midway between the rows on either side; all counts are Spark aggregations over the
binned labelled rows, and only (feature, bin) counts reach the driver (a few
thousand numbers, whatever the input's size).  ``verdict`` turns the list into
one ordered CASE expression; rows that no rule rejects are kept.

No Python runs on the executors.

Defined cases: a null or empty text has no words and fails the base rule; null
ids and repeated rows are judged row by row; a null label is ignored and an id
labelled more than once counts once per label row; without labelled rows of both
kinds the list is empty and keeps what the base rule keeps; an empty table
gives an empty result; ``statistics`` replaces input columns of its own names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import quoted, read_table

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_bangs", "n_capitals", "n_distinct_words", "n_lines"]
FEATURES = {
    "words": "n_words",
    "mean_word": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "bangs_per_word": "n_bangs / n_words",
    "capital_share": "n_capitals / word_chars",
    "distinct_share": "n_distinct_words / n_words",
}


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _occurrences(text: Column, chars: str) -> Column:
    """How often the one-byte characters ``chars`` occur."""
    total = F.lit(0)
    for c in chars:
        total = total + (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))))
    return total


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the array."""

    def covered(h: Column) -> Column:
        def from_sorted(s: Column) -> Column:
            again = F.filter(s, lambda x, k: F.coalesce((x["h"] == F.get(s, k - 1)["h"]), F.lit(False))
                             | F.coalesce((x["h"] == F.get(s, k + 1)["h"]), F.lit(False)))
            places = F.array_sort(F.transform(again, lambda x: x["p"]))
            # Each window adds up to three words, fewer where the next repeated window begins.
            return _let(places, lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
                F.lit(0), lambda a, x: a + x))

        pairs = F.array_sort(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(pairs, from_sorted))

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda k: F.xxhash64(F.get(w, k), F.get(w, k + 1), F.get(w, k + 2)))

    return _let(words, lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(_let(hashes(w), covered)))


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with BASE, EXTRA and base_failed."""
    own = {*BASE, *EXTRA, "base_failed"}
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    arrays = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own],
        _let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d"), _repeat_words(w).alias("r"))).alias("__w"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("__l"),
        (F.char_length(text) - _occurrences(text, WHITE)).alias("__chars"),
        _occurrences(text, SYMBOLS).alias("__symbols"), _occurrences(text, "!").alias("__bangs"),
        F.octet_length(F.regexp_replace(text, "[^A-Z]+", "")).alias("__caps"))
    made = {
        "n_words": F.col("__w.n"), "word_chars": F.col("__chars"), "n_symbols": F.col("__symbols"),
        "n_dup_lines": F.col("__l.n") - F.col("__l.d"), "n_repeat_words": F.col("__w.r"), "n_bangs": F.col("__bangs"),
        "n_capitals": F.col("__caps"), "n_distinct_words": F.col("__w.d"), "n_lines": F.col("__l.n")}
    out = arrays.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own],
                        *[v.cast("long").alias(k) for k, v in made.items()])
    return out.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


# ---------------------------------------------------------------- rules

@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        x = _value(self.feature)
        return x >= F.lit(self.threshold) if self.at_least else x <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """Rejects the rows that meet all conditions."""

    conditions: tuple[Condition, ...]
    rejected: int = field(default=0, compare=False)
    wrong: int = field(default=0, compare=False)

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def fired(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects the row (from 1), or null."""
    out = F.lit(None).cast("int")
    for k, r in reversed(list(enumerate(rules, 1))):
        out = F.when(r.column(), F.lit(k)).otherwise(out)
    return out


def verdict(rules: list[Rule]) -> Column:
    return ~F.col("base_failed") & fired(rules).isNull()


# ---------------------------------------------------------------- learning

def _value(feature: str) -> Column:
    e = FEATURES[feature]
    x = F.expr(f"try_divide({e.replace(' / ', ', ')})") if "/" in e else F.col(e).cast("double")
    return F.coalesce(x, F.lit(0.0))


def _reached(value: Column, edges: list[float]) -> Column:
    """How many of ``edges`` are at most ``value``."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= value)) if edges else F.lit(0)


def learn(labelled: DataFrame, max_rules: int = 12, max_conditions: int = 3, precision: float = 0.95,
          least_rows: int = 5, quantiles: int = 40) -> list[Rule]:
    """The decision list for rows with the statistics and a label ``quality`` (1 good, 0 bad).

    A rule is accepted if, on the pruning third, at least ``least_rows`` rows
    meet it and a share of ``precision`` of them is bad.
    """
    rows = labelled.where("not base_failed and quality is not null")
    cuts = [round(k / quantiles, 6) for k in range(1, quantiles)] + [0.002, 0.005, 0.01, 0.99, 0.995, 0.998]
    found = rows.agg(*[F.array_sort(F.array_distinct(F.concat(
        F.coalesce(F.percentile_approx(_value(f), cuts, 2000), F.array().cast("array<double>")),
        F.coalesce(F.percentile_approx(F.when(F.col("quality") == 0, _value(f)), cuts, 2000), F.array().cast("array<double>"))))).alias(f)
        for f in FEATURES]).first()
    edges = {f: list(found[f] or []) for f in FEATURES}
    if not any(edges.values()):
        return []
    # Bin k holds the values from edge k-1 up to edge k (edge k itself in bin k + 1).
    bins = [_reached(_value(f), edges[f]).alias(f) for f in FEATURES] + [_value(f).alias(f"{f}__x") for f in FEATURES]
    fold = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(3))
    binned = materialize(rows.select(*bins, (F.col("quality") == 0).alias("bad"), (fold == 0).alias("prune")), "binned")

    def met(conditions) -> Column:
        out = F.lit(True)
        for c in conditions:
            x = F.col(f"{c.feature}__x")
            out = out & (x >= c.threshold if c.at_least else x <= c.threshold)
        return out

    def table(where: Column) -> dict:
        counts = {}
        stack = ", ".join(f"'{f}', `{f}`" for f in FEATURES)
        for r in (binned.where(where & ~F.col("prune")).selectExpr("bad", f"stack({len(FEATURES)}, {stack}) as (f, k)")
                  .groupBy("f", "k", "bad").count().collect()):
            counts.setdefault(r.f, {}).setdefault(r.k, [0, 0])[int(r.bad)] += r["count"]
        return counts

    def best(where: Column, p0: int, n0: int):
        """The condition of greatest FOIL gain, with the bad and good rows it leaves, or None."""
        top, tied = 1e-9, []
        now = math.log2(p0 / (p0 + n0))
        for f, by in sorted(table(where).items()):
            for at_least in (True, False):
                p = n = 0
                # Rows in bins >= k have values >= edge k - 1; rows in bins <= k have values < edge k.
                for k in range(len(edges[f]), 0, -1) if at_least else range(0, len(edges[f])):
                    good, bad = by.get(k, (0, 0))
                    p, n = p + bad, n + good
                    gain = p * (math.log2(p / (p + n)) - now) if p else 0.0
                    if gain > top + 1e-9:
                        top, tied = gain, []
                    if bad and gain > top - 1e-9:
                        tied.append((f, at_least, edges[f][k - 1] if at_least else edges[f][k], p, n))
        if not tied:
            return None
        # Of equal gains the widest gap between the rows that meet it and the rest wins; the threshold goes midway.
        near = []
        for j, (f, at_least, edge, _, _) in enumerate(tied):
            x = F.col(f"{f}__x")
            inside = x >= edge if at_least else x < edge
            near += [(F.min if at_least else F.max)(F.when(inside, x)).alias(f"in{j}"), (F.max if at_least else F.min)(F.when(~inside, x)).alias(f"out{j}")]
        found = binned.where(where & ~F.col("prune")).agg(*near).first()

        def gap(j: int) -> float:
            a, b = found[f"in{j}"], found[f"out{j}"]
            return 0.0 if b is None else abs(a - b) / (abs(a) + abs(b) + 1e-12)

        j = max(range(len(tied)), key=lambda j: (gap(j), -j))
        f, at_least, _, p, n = tied[j]
        a, b = found[f"in{j}"], found[f"out{j}"]
        return Condition(f, at_least, a if b is None else (a + b) / 2), p, n

    rules, left = [], F.lit(True)
    while len(rules) < max_rules:
        start = binned.where(left & ~F.col("prune")).agg(F.sum(F.col("bad").cast("long")), F.count(F.lit(1))).first()
        p, n = int(start[0] or 0), int(start[1] or 0) - int(start[0] or 0)
        grown: list = []
        while len(grown) < max_conditions and n > 0 and p > 0:
            step_ = best(left & met(grown), p, n)
            if step_ is None or (grown and step_[2] >= n):
                break
            condition, p, n = step_
            grown.append(condition)
        if not grown:
            break
        held = binned.where(left & F.col("prune")).agg(*[
            F.sum(F.when(met(grown[:k]) & (F.col("bad") == b), 1).otherwise(0)).alias(f"x{k}{int(b)}")
            for k in range(1, len(grown) + 1) for b in (False, True)]).first()
        score = lambda k: ((held[f"x{k}1"] or 0) - (held[f"x{k}0"] or 0)) / max(1, (held[f"x{k}1"] or 0) + (held[f"x{k}0"] or 0))
        k = max(range(1, len(grown) + 1), key=lambda j: (round(score(j), 3), -j))
        bad, good = held[f"x{k}1"] or 0, held[f"x{k}0"] or 0
        if bad + good < least_rows or bad < precision * (bad + good):
            break
        rules.append(Rule(tuple(grown[:k]), bad + good, good))
        left = left & ~met(grown[:k])
    return rules


def labelled_statistics(stats: DataFrame, labels: DataFrame) -> DataFrame:
    return stats.select("doc_id", *BASE, *EXTRA, "base_failed").join(labels.select("doc_id", "quality"), "doc_id")


def quality_filter(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """``docs`` less the rejected rows (columns unchanged), and the learned rules."""
    stats = statistics(docs.select("doc_id", "text"))
    rules = learn(materialize(labelled_statistics(stats, labels), "statistics"))
    keep = statistics(docs.select("doc_id", "text", F.struct(*quoted(docs)).alias("__row"))).where(verdict(rules))
    return keep.select(*[F.col("__row")[c].alias(c) for c in docs.columns]), rules


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = materialize(statistics(docs).drop("text"), "statistics")
    rules = learn(labelled_statistics(stats, read_table(spark, sf_dir, "labels")))
    return stats.select("doc_id", *BASE, "base_failed", verdict(rules).alias("kept"), fired(rules).alias("rule"))
