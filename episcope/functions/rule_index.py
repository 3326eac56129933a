"""The schedule rules as data: an index of cells, joined by equality.

A rule is a box over (intent rank, tumour group, dose, fractions) with a
priority (its place in the list).  The bounds of all boxes cut dose and
fractions into elementary intervals, numbered from 0; inside a cell (one
interval of each) the same boxes hold everywhere, so the winner of each cell is
settled once, when the index is made.  A row finds its rule by its interval
numbers: an equi-join with a table of some hundred rows, whose work does not
grow with the number of rules and which needs no range comparison per rule.
Rules can come from a table as well as from ``fixed_values``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed_values as fv

DOSE_STEP = Decimal("0.001")  # doses have three decimals, so the next dose after a bound is a step away
ANY = "*"


@dataclass(frozen=True)
class Rule:
    """Bounds are inclusive; None: unbounded.  A rule of tumour ``ANY`` holds for all and looks at fractions alone."""

    rank: int
    tumour: str
    dose_lo: Decimal | None
    dose_hi: Decimal | None
    fractions_lo: int | None
    fractions_hi: int | None
    label: str | None
    outside: bool = False  # puts the row outside the selected schedules, whatever its label


def schedule_rules() -> list[Rule]:
    """The palliative fraction bands, the radical boxes and the boxes that put a schedule outside, in order of priority."""
    palliative = [Rule(1, ANY, None, None, lo, hi, label) for lo, hi, label in fv.PALLIATIVE_SCHEDULES]
    boxes = [Rule(2, t, dlo, dhi, flo, fhi, label) for t, dlo, dhi, flo, fhi, label in fv.SCHEDULE_BOXES]
    outside = [Rule(2, t, dlo, dhi, flo, fhi, None, True) for t, dlo, dhi, flo, fhi in fv.SCHEDULE_GROUP_OVERRIDES]
    return palliative + boxes + outside


@dataclass(frozen=True)
class RuleIndex:
    dose_edges: tuple[Decimal, ...]
    fraction_edges: tuple[int, ...]
    cells: tuple[tuple, ...]  # rank, tumour, dose cell, fractions cell, label, inside

    @staticmethod
    def of(rules: Iterable[Rule]) -> RuleIndex:
        rules = list(rules)
        doses = sorted({e for r in rules for e in (r.dose_lo, None if r.dose_hi is None else r.dose_hi + DOSE_STEP) if e is not None})
        fractions = sorted({e for r in rules for e in (r.fractions_lo, None if r.fractions_hi is None else r.fractions_hi + 1) if e is not None})

        def span(lo, hi, edges, step) -> range:
            return range(0 if lo is None else edges.index(lo) + 1, len(edges) + 1 if hi is None else edges.index(hi + step) + 1)

        found: dict[tuple, list] = {}
        for r in rules:  # in order of priority: the first label of a cell wins
            for d in [-1] if r.tumour == ANY else span(r.dose_lo, r.dose_hi, doses, DOSE_STEP):
                for f in span(r.fractions_lo, r.fractions_hi, fractions, 1):
                    label, inside = found.setdefault((r.rank, r.tumour, d, f), [None, True])
                    found[r.rank, r.tumour, d, f] = [r.label if label is None else label, inside and not r.outside]
        cells = tuple((*key, label, inside and label is not None) for key, (label, inside) in sorted(found.items()))
        return RuleIndex(tuple(doses), tuple(fractions), cells)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.cells), "rule_rank int, rule_tumour string, dose_cell int, fractions_cell int, label string, inside boolean")


def _cell(value: Column, edges: tuple, kind: str) -> Column:
    """The number of edges at or below the value (null for null): a balanced search, written as nested conditions."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(edges[mid]).cast(kind), search(lo, mid)).otherwise(search(mid + 1, hi))

    return F.when(value.isNotNull(), search(0, len(edges)))


def with_schedule(rows: DataFrame, index: RuleIndex | None = None, tumour: str = "cancertype", rank: str = "min_intent", dose: str = "max_dose",
                  fractions: str = "max_fractions") -> DataFrame:
    """``rows`` with schedule_label and schedule_group, as the CASE chains of ``classify`` give them."""
    index = index or RuleIndex.of(schedule_rules())
    by_fractions = F.array(*[F.lit(k) for k in sorted({c[0] for c in index.cells if c[1] == ANY})])
    alone = F.array_contains(by_fractions, F.col(rank))
    keyed = (rows.withColumn("rule_rank", F.col(rank)).withColumn("rule_tumour", F.when(alone, F.lit(ANY)).otherwise(F.col(tumour)))
             .withColumn("dose_cell", F.when(alone, F.lit(-1)).otherwise(_cell(F.col(dose), index.dose_edges, "decimal(12,3)")))
             .withColumn("fractions_cell", _cell(F.col(fractions), index.fraction_edges, "int")))
    keys = ["rule_rank", "rule_tumour", "dose_cell", "fractions_cell"]
    group = (F.when(F.col(rank) == 1, fv.SCHEDULE_GROUP_PALLIATIVE).when(F.col("inside") & (F.col(rank) == 2), fv.SCHEDULE_GROUP_INSIDE)
             .otherwise(fv.SCHEDULE_GROUP_OUTSIDE))
    return (keyed.join(index.table(rows.sparkSession), keys, "left")
            .withColumn("schedule_label", F.coalesce("label", F.lit(fv.SCHEDULE_OTHER))).withColumn("schedule_group", group)
            .drop(*keys, "label", "inside"))
