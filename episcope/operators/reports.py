"""QA reports of the monthly run, as small DataFrame reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv

# Coded columns of the cleaned table whose values are reviewed each month.
PROFILED_COLUMNS = [
    "EPI_YEAR", "EPI_MONTH", "CALENDAR_MONTH", "INTENT", "AGEGROUP", "GENDER",
    "ETHNICITY", "DEPRIVATION", "ICB", "CANCERTYPE", "FRACTIONATION_CATEGORY",
    "DOSE_FRACTIONATION_SCHEDULES", "CANCER_ALLIANCE_NEW", "WORKING_DAYS",
    "SEX", "ETHNICITYNAME", "IMD19_QUINTILE_LSOAS", "ICB_HB",
]
# Columns of the published table reviewed before release.
PUBLISHED_PROFILE = ["prim_val", "prim_lvl", "wd"]


def value_profile(cleaned: DataFrame, columns: list[str] = PROFILED_COLUMNS) -> DataFrame:
    """(column, value, rows) for every profiled column, in one pass:
    ``stack`` turns each row into one (name, value) pair per column, and one
    group-by counts them (map-side partial counts)."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    stacked = cleaned.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, value)")
    return stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def unmatched_months(joined_full: DataFrame) -> DataFrame:
    """Working-day months without any activity (null year after the full
    join of activity and working days)."""
    return (joined_full.filter(F.col("EPI_YEAR").isNull())
            .select(F.date_format("CALENDAR_MONTH", "yyyy-MM-dd").alias("calendar_month"),
                    F.col("WORKING_DAYS").alias("working_days")).distinct())


def low_counts(published: DataFrame, limit: int = fv.LOW_COUNT_LIMIT) -> DataFrame:
    return published.filter(F.col("episodeCount") < limit)


def level_slice(published: DataFrame, levels: list[str], value: str | None = None) -> DataFrame:
    """Rows of some primary levels, or those of one value of theirs."""
    rows = published.filter(F.col("prim_lvl").isin(*levels))
    return rows if value is None else rows.filter(F.col("prim_val") == value)
