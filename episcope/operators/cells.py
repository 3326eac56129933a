"""Exact distinct-episode counts that add up: cells of single-valued episodes, and the rest.

A group of a grouping spec counts distinct episodes within a month or a year.
Call an episode in one month (or year) a *unit*.  Nearly all units hold one
combination of the grouping attributes however many rows they have; such a unit
is in exactly one *cell* (period x all attributes), so counts of cells are plain
sums, without episode ids, and every coarser group is a sum of cells: exact,
mergeable, and as small as the number of attribute combinations.  Units with
several combinations are counted distinct, group by group, as before.  Both
counts add up, as no unit is in both.

So the rows are reduced once to distinct (unit, attributes), and only units (not
rows) are multiplied by the number of specs.  A unit's test is min = max over a
struct, taken over a window inside the episode.  ``cells`` gives the cells
themselves; the publication adds the units up group by group in their tasks
instead (``single_valued``), as moving every cell moves nearly every unit.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv

EP = "RADIOTHERAPYEPISODEID"
ATTRIBUTES = ["CANCERTYPE", "AGEGROUP", "ETHNICITY", "GENDER", "DEPRIVATION", "INTENT", "DOSE_FRACTIONATION_SCHEDULES",
              "FRACTIONATION_CATEGORY", "CANCER_ALLIANCE_NEW", "ICB"]
UNIT_COLUMNS = [EP, "EPI_YEAR", "EPI_MONTH", *ATTRIBUTES]
_PERIOD_KEYS = {fv.PERIOD_YEAR: ["EPI_YEAR"], fv.PERIOD_MONTH: ["EPI_YEAR", "EPI_MONTH"]}


def units(cleaned: DataFrame) -> DataFrame:
    """Distinct (episode, year, month, attributes)."""
    return cleaned.select(*UNIT_COLUMNS).distinct()


def mark(unit_rows: DataFrame, periods: Iterable[str] = tuple(_PERIOD_KEYS)) -> DataFrame:
    """Rows with an episode id and, by period, ``unit_of_<period>``: 1 on one row of each unit with one combination, 0 on its
    other rows, null on the rows of units with several.  Rows dealt by episode are marked where they are."""
    out = unit_rows.where(F.col(EP).isNotNull())
    all_of = F.struct(*ATTRIBUTES)
    for period in periods:
        unit = Window.partitionBy(EP, *_PERIOD_KEYS[period])
        single = F.min(all_of).over(unit).eqNullSafe(F.max(all_of).over(unit))
        first = F.row_number().over(unit.orderBy("EPI_MONTH")) == 1
        out = out.withColumn(_marker(period), F.when(single, first.cast("int")))
    return out


def _marker(period: str) -> str:
    return f"unit_of_{period}"


def cells(unit_rows: DataFrame, period: str) -> tuple[DataFrame, DataFrame]:
    """Of the units of a period: (cells with their number ``n`` of units, rows of the units with several combinations, dealt by
    episode).  ``unit_rows`` are marked here where they are not yet.

    Null episode ids count nowhere and go; repeated rows change nothing."""
    if _marker(period) not in unit_rows.columns:
        unit_rows = mark(unit_rows, [period])
    sums = single_valued(unit_rows, period).groupBy(*_PERIOD_KEYS[period], *ATTRIBUTES).agg(F.count(F.lit(1)).alias("n"))
    return sums, several_valued(unit_rows, period)


def single_valued(marked: DataFrame, period: str) -> DataFrame:
    """One row, where it lies, for each unit with one combination of attributes."""
    return marked.where(F.col(_marker(period)) == 1).select(*_PERIOD_KEYS[period], *ATTRIBUTES)


def several_valued(marked: DataFrame, period: str) -> DataFrame:
    """The distinct rows of the units with several combinations, dealt by episode."""
    parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = marked.where(F.col(_marker(period)).isNull()).select(EP, *_PERIOD_KEYS[period], *ATTRIBUTES)
    return rest.repartition(parts, EP).distinct()
