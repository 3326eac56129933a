"""Cleaning of the extract before publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import recode as R
from ..plans.params import DEFAULT, RunParams
from ..session import materialize


def patch_provider(ext: DataFrame) -> DataFrame:
    """Fixed names for one provider code, then that code and its sibling are
    merged into their successor (the code is replaced last)."""
    code = F.col("ORGCODEPROVIDER")
    out = ext
    for colname, value in fv.PATCHED_PROVIDER_VALUES.items():
        out = out.withColumn(colname, F.when(code == fv.PATCHED_PROVIDER, F.lit(value))
                             .otherwise(F.col(colname)))
    return out.withColumn("ORGCODEPROVIDER",
                          F.when(code.isin(*fv.PATCHED_PROVIDER_CODES),
                                 F.lit(fv.PATCHED_PROVIDER_TARGET)).otherwise(code))


def england_only(ext: DataFrame) -> DataFrame:
    return ext.filter(F.col("COUNTRY") == fv.ENGLAND)


def with_month_parts(ext: DataFrame) -> DataFrame:
    """``yyyy/MM`` -> first day of the month, its year and month."""
    m = F.to_date(F.concat(F.col("CALENDAR_MONTH"), F.lit("/01")), "yyyy/MM/dd")
    return (ext.withColumn("CALENDAR_MONTH", m)
            .withColumn("EPI_YEAR", F.year("CALENDAR_MONTH"))
            .withColumn("EPI_MONTH", F.month("CALENDAR_MONTH")))


def complete_months(ext: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    return ext.filter(F.col("CALENDAR_MONTH") <= F.lit(params.complete_month_cutoff_date))


def working_days_clean(working_days: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """First two columns, de-duplicated, month as a date, months before the
    working-day cut-off (strictly)."""
    wd = working_days.select(
        F.to_date(F.col("calendar_month")).alias("CALENDAR_MONTH"),
        F.col("working_days").alias("WORKING_DAYS")).distinct()
    return wd.filter(F.col("CALENDAR_MONTH") < F.lit(params.working_day_cutoff_date))


def join_working_days(ext: DataFrame, wd: DataFrame, how: str = "left") -> DataFrame:
    """Working days of the month.  The specification uses a full outer join;
    its right-only rows have no gender and are dropped by the gender filter,
    so the left join gives the same published rows.  ``how='full'`` keeps
    them (for the unmatched-months report)."""
    return ext.join(wd, "CALENDAR_MONTH", how)


def recode_demographics(ext: DataFrame) -> DataFrame:
    return (ext
            .withColumn("INTENT", R.recode_intent(F.col("INTENT")))
            .withColumn("AGEGROUP", R.recode_age(F.col("AGE")))
            .withColumn("GENDER", R.recode_gender(F.col("SEX"))))


def drop_other_gender(ext: DataFrame) -> DataFrame:
    """Drops 'Other' and, like the specification's filter, unknown gender."""
    return ext.filter(F.col("GENDER") != fv.GENDER_EXCLUDED)


def recode_areas(ext: DataFrame) -> DataFrame:
    return (ext
            .withColumn("ETHNICITY", R.recode_ethnicity(F.col("ETHNICITYNAME")))
            .withColumn("DEPRIVATION", R.deprivation(F.col("IMD19_QUINTILE_LSOAS")))
            .withColumn("ICB", R.icb_clean(F.col("ICB_HB"))))


def drop_impossible_pairs(ext: DataFrame) -> DataFrame:
    """Drop (gender, tumour) pairs that cannot occur; like the
    specification's filter, rows where the test is unknown go too."""
    out = ext
    for gender, tumour in fv.IMPOSSIBLE_PAIRS:
        out = out.filter(~((F.col("GENDER") == gender) & (F.col("CANCERTYPE") == tumour)))
    return out


def recode_tumour_and_category(ext: DataFrame) -> DataFrame:
    return (ext
            .withColumn("CANCERTYPE", R.recode_tumour(F.col("CANCERTYPE")))
            .withColumn("FRACTIONATION_CATEGORY", R.recode_category(F.col("FRACTIONATION_CATEGORY"))))


def clean(ext: DataFrame, working_days: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """All cleaning steps in the specification's order."""
    out = patch_provider(ext)
    out = england_only(out)
    out = with_month_parts(out)
    out = complete_months(out, params)
    # Stored: a row a month, whose size is then known, so that the rows stay where they are.
    out = join_working_days(out, materialize(working_days_clean(working_days, params), "working_days"))
    out = recode_demographics(out)
    out = drop_other_gender(out)
    out = recode_areas(out)
    out = drop_impossible_pairs(out)
    return recode_tumour_and_category(out)


def attributes(ext: DataFrame) -> DataFrame:
    """The cleaning steps that look at a row alone: all but the month cut-offs
    and the working days, which belong to one run."""
    out = with_month_parts(england_only(patch_provider(ext)))
    out = drop_other_gender(recode_demographics(out))
    return recode_tumour_and_category(drop_impossible_pairs(recode_areas(out)))
