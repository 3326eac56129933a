"""F6 to F19: what follows from a row's other values, and what is added up anyway, does not move."""

import datetime as dt
import re
from collections import Counter

from pyspark.sql import functions as F

from episcope.functions import fixed_values as fv
from episcope.operators import address as AD
from episcope.operators import aggregate as AG
from episcope.operators.cells import ATTRIBUTES, UNIT_COLUMNS, cells, mark
from episcope.plans.specs import PERIODS, all_specs
from episcope.session import materialize


def plan(df, kind="executedPlan") -> str:
    return getattr(df._jdf.queryExecution(), kind)().toString()


def unit_rows(spark):
    """Episodes of one and of several combinations, in several months and years; nulls and repeated rows."""
    made = []
    for n in range(120):
        for month in (1, 2, None)[: 1 + n % 3]:
            for year in (2020, 2021)[: 1 + n % 2]:
                row = {c: None if (n + len(c)) % 11 == 0 else f"{c[:3]}{n % (2 + len(c) % 3)}" for c in ATTRIBUTES}
                row |= {UNIT_COLUMNS[0]: None if n % 40 == 7 else f"E{n % 90}", "EPI_YEAR": year, "EPI_MONTH": month,
                        "INTENT": ("Curative", "Palliative", None)[n % 3]}
                made += [tuple(row[c] for c in UNIT_COLUMNS)] * (1 + n % 2)
    return spark.createDataFrame(made, ", ".join(f"{c} {'int' if c.startswith('EPI_') else 'string'}" for c in UNIT_COLUMNS))


def test_units_are_not_moved_into_cells(spark):
    """nearly every unit was a cell, and moved with all its attributes."""
    marked = materialize(mark(unit_rows(spark).distinct()), "units")
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(AG.count_units(marked)))
    assert moved and not [m for m in moved if any(a in m for a in ATTRIBUTES)], moved


def test_counts_by_unit_are_the_counts_by_cell(spark):
    rows = unit_rows(spark)
    got = Counter(map(tuple, AG.count_units(rows).select(*AG.NARROW_KEYS, "episodeCount").collect()))
    specs, parts = all_specs(), []
    for period in PERIODS:
        single, several = cells(rows, period)
        parts.append(AG.spec_rows(single, specs, period, "n").groupBy(*AG.NARROW_KEYS).agg(F.sum("n").alias("episodeCount")))
        parts.append(AG.spec_rows(several, specs, period, UNIT_COLUMNS[0]).groupBy(*AG.NARROW_KEYS).agg(F.countDistinct(UNIT_COLUMNS[0]).alias("episodeCount")))
    by_cell = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).groupBy(*AG.NARROW_KEYS).agg(F.sum("episodeCount").alias("episodeCount"))
    want = Counter(map(tuple, AG.with_mirrors(by_cell, specs).select(*AG.NARROW_KEYS, "episodeCount").collect()))
    assert got == want and len(got) > 100


def test_the_day_of_a_row_does_not_move(spark):
    day = dt.date(2020, 1, 5)
    rows = spark.createDataFrame([(1, day, "a"), (1, dt.date(2020, 1, 7), "b"), (2, None, "c")], "patientid long, treatmentstartdate date, k string")
    geo = spark.createDataFrame([(10, 1, dt.date(2020, 1, 6), "N", "1"), (11, 1, None, "S", "2"), (12, 2, day, "E", "3")],
                                "addressid long, patientid long, dateofaddress date, icb_hb string, imd19_quintile_lsoas string")
    got = AD.with_best_address(rows, geo, "2019-01-01", "2024-05-31").select("k", "a_id")
    assert Counter(map(tuple, got.collect())) == Counter([("a", 10), ("b", 10), ("c", None)])
    above, below = plan(got, "optimizedPlan").split("RepartitionByExpression [patientid")
    assert "datediff(treatmentstartdate" in above and "datediff(treatmentstartdate" not in below


def test_only_the_periods_of_the_specs_are_marked(spark, monkeypatch):
    """the counts by month sorted every episode's rows once more for units of years."""
    kept = []
    monkeypatch.setattr(AG, "materialize", lambda df, name: (kept.append(df.columns), materialize(df, name))[1])
    rows = unit_rows(spark)
    specs = all_specs(periods=(fv.PERIOD_MONTH,))
    got = Counter(map(tuple, AG.count_units(rows, specs).select(*AG.NARROW_KEYS[1:], "episodeCount").collect()))
    assert [c for c in kept[0] if c.startswith("unit_of_")] == [f"unit_of_{fv.PERIOD_MONTH}"]
    every = AG.count_units(rows).where(F.col("spec_id").isin(*[i for i, s in enumerate(all_specs()) if s[0] == fv.PERIOD_MONTH]))
    assert got == Counter(map(tuple, every.select(*AG.NARROW_KEYS[1:], "episodeCount").collect()))
