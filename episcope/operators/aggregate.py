"""Distinct-episode counts over the grouping specs, low-count folding and the
working-day adjustment: the published long table.

The cleaned rows are reduced once to units (``cells``): an episode in a month
or year.  Each unit with one combination of attributes -- not each row -- emits
one narrow group row per spec it belongs to (``inline`` over an array of
conditional structs, Spark's Expand), and these are summed where the units lie:
what moves is at most every group once a task, however many units there are.
The few units with several combinations emit their rows, counted by
``count(DISTINCT episode)``.  Every aggregate combines map-side, so even a group
holding a third of all rows is summed in many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fv
from ..functions.recode import working_day_adjust
from ..plans.specs import Geo, Spec, all_specs
from ..session import materialize
from .cells import EP, UNIT_COLUMNS, mark, several_valued, single_valued

KEYS = ["activity_year", "activity_month", "period", "wd", "geo_lvl", "geo_val",
        "prim_lvl", "prim_val", "lvl_2", "lvl_2_val"]
PUBLISHED_COLUMNS = KEYS + ["episodeCount", "adjusted"]

_STR = T.StringType()


# Grouping key while counting: the spec number stands for the constant
# columns of its spec (period, geo level, level names) and the month for its
# working days; both are attached after the count, so the shuffled keys stay
# narrow.
NARROW_KEYS = ["spec_id", "activity_year", "activity_month", "geo_val", "prim_val", "lvl_2_val"]


def _group_row(spec_id: int, period: str, geo: Geo, spec: Spec) -> Column:
    month = F.lit(None) if period == fv.PERIOD_YEAR else F.col("EPI_MONTH")
    geo_val = F.lit(geo.geo_val) if geo.geo_val_col is None else F.col(geo.geo_val_col)

    def val(c):
        return F.lit(None).cast(_STR) if c is None else F.col(c).cast(_STR)

    return F.struct(
        F.lit(spec_id).alias("spec_id"),
        F.col("EPI_YEAR").cast("int").alias("activity_year"), month.cast("int").alias("activity_month"),
        geo_val.cast(_STR).alias("geo_val"),
        val(spec.prim_col).alias("prim_val"), val(spec.lvl_2_col).alias("lvl_2_val"),
    )


def mirrored(specs) -> dict[int, int]:
    """Spec number -> number of the later spec with the same rows and its two levels swapped."""
    out, seen = {}, {}
    for i, (period, geo, s) in enumerate(specs):
        twin = seen.get((period, geo, s.lvl_2_col, s.prim_col, s.intents)) if s.lvl_2_col else None
        if twin is not None and twin not in out:
            out[twin] = i
        elif s.lvl_2_col:
            seen[(period, geo, s.prim_col, s.lvl_2_col, s.intents)] = i
    return out


def spec_rows(rows: DataFrame, specs, period: str, carried: str, spread: bool = True) -> DataFrame:
    """(``carried``, narrow keys): one row per row and spec of ``period`` it is in.

    The rows are first spread round-robin over the shuffle partitions: the
    explode multiplies them by the number of specs, so its parallelism must not
    depend on how far their partitions were coalesced.  Without ``spread`` they
    stay where they are."""
    arms = []
    mirrors = set(mirrored(specs).values())
    for i, (p, geo, spec) in enumerate(specs):
        if i in mirrors or p != period:
            continue
        row = _group_row(i, p, geo, spec)
        if spec.intents is not None:
            row = F.when(F.col("INTENT").isin(*spec.intents), row)
        arms.append(row)
    if spread:
        rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.select(F.col(carried), F.inline(F.array_compact(F.array(*arms))))


def _pick(values: list) -> Column:
    """The spec's constant for each row, by spec number."""
    arr = F.array(*[F.lit(v).cast(_STR) for v in values])
    return F.element_at(arr, F.col("spec_id") + 1)


def count_units(unit_rows: DataFrame, specs=None) -> DataFrame:
    """Distinct episodes by the narrow keys of every spec (exact); ``unit_rows`` have ``cells.UNIT_COLUMNS``, and their
    marks where they are stored."""
    specs = all_specs() if specs is None else specs
    periods, parts = list(dict.fromkeys(p for p, _, _ in specs)), []
    if not set(unit_rows.columns) > set(UNIT_COLUMNS):
        unit_rows = materialize(mark(unit_rows.repartition(EP), periods), "units")
    for period in periods:
        # Cells of all attributes are nearly as many as the units and wider than the group rows: the units are not moved into them.
        # The rest lie by episode.  So nothing moves again before its group rows are added up.
        single, several = single_valued(unit_rows, period).withColumn("n", F.lit(1)), several_valued(unit_rows, period)
        parts.append(spec_rows(single, specs, period, "n", spread=False).groupBy(*NARROW_KEYS).agg(F.sum("n").alias("episodeCount")))
        parts.append(spec_rows(several, specs, period, EP, spread=False).groupBy(*NARROW_KEYS).agg(F.countDistinct(EP).alias("episodeCount")))
    both = reduce(DataFrame.unionByName, parts).groupBy(*NARROW_KEYS).agg(F.sum("episodeCount").alias("episodeCount"))
    return with_mirrors(both, specs)


def named_counts(counts: DataFrame, month_days: DataFrame, specs=None) -> DataFrame:
    """Counts by narrow keys with the specs' constant columns, and each month's working days from
    ``month_days`` (EPI_YEAR, EPI_MONTH, WORKING_DAYS)."""
    specs = all_specs() if specs is None else specs
    days = month_days.select(F.col("EPI_YEAR").cast("int").alias("activity_year"), F.col("EPI_MONTH").cast("int").alias("activity_month"),
                             F.col("WORKING_DAYS").cast("double").alias("days"))
    counts = counts.withColumn("period", _pick([p for p, _, _ in specs]))
    wd = F.when(F.col("period") == fv.PERIOD_YEAR, F.lit(0.0)).otherwise(F.col("days"))
    return counts.join(days, ["activity_year", "activity_month"], "left").select(
        "activity_year", "activity_month", "period", wd.alias("wd"),
        _pick([g.geo_lvl for _, g, _ in specs]).alias("geo_lvl"), "geo_val",
        _pick([s.prim_lvl for _, _, s in specs]).alias("prim_lvl"), "prim_val",
        _pick([s.lvl_2 for _, _, s in specs]).alias("lvl_2"), "lvl_2_val",
        "episodeCount")


def count_episodes(cleaned: DataFrame, specs=None) -> DataFrame:
    """Distinct episodes per group of every spec (exact, not approximate)."""
    specs = all_specs() if specs is None else specs
    # Stored: each period reads the units twice, and the working days come from them too.
    stored = materialize(mark(cleaned.select(*UNIT_COLUMNS, "WORKING_DAYS").distinct(), dict.fromkeys(p for p, _, _ in specs)), "units")
    days = stored.select("EPI_YEAR", "EPI_MONTH", "WORKING_DAYS").distinct()
    return named_counts(count_units(stored.drop("WORKING_DAYS"), specs), days, specs)


def with_mirrors(counts: DataFrame, specs) -> DataFrame:
    """Adds the mirrored specs' rows: the same counts with the two level values swapped."""
    pairs = mirrored(specs)
    if not pairs:
        return counts
    twin = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    row = lambda number, a, b: F.struct(number.cast("int").alias("spec_id"), F.col(a).alias("prim_val"), F.col(b).alias("lvl_2_val"))
    rows = F.array_compact(F.array(
        row(F.col("spec_id"), "prim_val", "lvl_2_val"),
        F.when(F.col("spec_id").isin(*pairs), row(F.try_element_at(twin, F.col("spec_id")), "lvl_2_val", "prim_val"))))
    return counts.select("activity_year", "activity_month", "geo_val", "episodeCount", F.inline(rows))


def fold_low_counts(counts: DataFrame) -> DataFrame:
    """National rows only: values of the schedule levels counted below 5 are
    relabelled 'other' (first and second level tested on their own), then
    rows are regrouped and their distinct counts *summed*.  Rows of other
    specs carry no such level and pass by the regroup as they are."""
    counts = materialize(counts, "counts")
    foldable = (F.col("geo_lvl") == fv.GEO_NATIONAL[0]) & (F.col("prim_lvl").isin(*fv.LOW_COUNT_LEVELS)
                                                         | F.coalesce(F.col("lvl_2").isin(*fv.LOW_COUNT_LEVELS), F.lit(False)))
    small = F.col("episodeCount") < fv.LOW_COUNT_LIMIT
    other = F.lit(fv.LOW_COUNT_LABEL)
    relabelled = counts.where(foldable).select(
        *[c for c in KEYS if c not in ("prim_val", "lvl_2_val")],
        F.when(F.col("prim_lvl").isin(*fv.LOW_COUNT_LEVELS) & small, other)
        .otherwise(F.col("prim_val")).alias("prim_val"),
        F.when(F.col("lvl_2").isin(*fv.LOW_COUNT_LEVELS) & small, other)
        .otherwise(F.col("lvl_2_val")).alias("lvl_2_val"),
        "episodeCount")
    folded = relabelled.groupBy(*KEYS).agg(F.sum("episodeCount").alias("episodeCount"))
    return counts.where(~F.coalesce(foldable, F.lit(False))).select(*KEYS, "episodeCount").unionByName(folded.select(*KEYS, "episodeCount"))


def drop_unmatched_icb(counts: DataFrame) -> DataFrame:
    """ICB rows of unmatched postcodes go; a null area is kept."""
    unmatched = ((F.col("geo_lvl") == fv.GEO_ICB)
                 & F.col("geo_val").eqNullSafe(fv.POSTCODE_NOT_MATCHED))
    return counts.filter(~unmatched)


def publish(cleaned: DataFrame, specs=None) -> DataFrame:
    """The published table (12 columns)."""
    return published_columns(count_episodes(cleaned, specs))


def published_columns(counts: DataFrame) -> DataFrame:
    """Named counts, folded and adjusted."""
    counts = drop_unmatched_icb(fold_low_counts(counts))
    return counts.select(
        *KEYS, F.col("episodeCount").cast("long").alias("episodeCount"),
        working_day_adjust(F.col("episodeCount"), F.col("wd")).alias("adjusted"))


def area_counts(cleaned: DataFrame, geo_lvl: str, period: str) -> DataFrame:
    """Counts of one area family and period, without folding (area rows are
    never folded); unmatched ICBs removed."""
    specs = all_specs(geos=(geo_lvl,), periods=(period,))
    out = count_episodes(cleaned, specs)
    if geo_lvl == fv.GEO_ICB:
        out = drop_unmatched_icb(out)
    return out.select(*[c for c in KEYS if c not in ("lvl_2", "lvl_2_val")],
                      F.col("episodeCount").cast("long").alias("episodeCount"))


def national_counts(cleaned: DataFrame, period: str, fold: bool = True) -> DataFrame:
    specs = all_specs(geos=(fv.GEO_NATIONAL[0],), periods=(period,))
    out = count_episodes(cleaned, specs)
    if fold:
        out = fold_low_counts(out)
    return out.select(*KEYS, F.col("episodeCount").cast("long").alias("episodeCount"))
