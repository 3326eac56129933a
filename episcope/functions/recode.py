"""Column recodes of the cleaning stage (built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def recode(c: Column, mapping: dict) -> Column:
    """Replace listed values, keep the others (and nulls) as they are."""
    return F.coalesce(F.element_at(literal_map(mapping), c), c)


def recode_strict(c: Column, mapping: dict) -> Column:
    """Replace listed values; anything else becomes null (numeric codes)."""
    return F.element_at(literal_map(mapping), c)


def blank_to(c: Column, default: str) -> Column:
    """Null or empty text -> ``default``."""
    return F.when(c.isNull() | (c == F.lit("")), F.lit(default)).otherwise(c)


def recode_intent(intent: Column) -> Column:
    return recode(intent, fv.INTENT_RECODE)


def recode_age(age: Column) -> Column:
    return recode(age, fv.AGE_RECODE)


def recode_gender(sex: Column) -> Column:
    return recode_strict(sex.cast("int"), fv.GENDER_RECODE)


def recode_ethnicity(name: Column) -> Column:
    return blank_to(recode(name, fv.ETHNICITY_RECODE), fv.UNKNOWN)


def deprivation(imd: Column) -> Column:
    return blank_to(imd, fv.UNKNOWN)


def icb_clean(icb: Column) -> Column:
    matched = blank_to(icb, fv.POSTCODE_NOT_MATCHED)
    matched = F.when(matched.isin(*fv.NON_ICB_AREAS),
                     F.lit(fv.POSTCODE_NOT_MATCHED)).otherwise(matched)
    return F.replace(matched, F.lit(fv.ICB_SUFFIX), F.lit(""))


def recode_tumour(tumour: Column) -> Column:
    return recode(tumour, fv.TUMOUR_RECODE)


def recode_category(category: Column) -> Column:
    return recode(category, fv.CATEGORY_RECODE)


def working_day_adjust(count: Column, wd: Column) -> Column:
    """Counts per standard month: ``wd == 0`` keeps the count, otherwise
    ``count / wd * 21``; rounded half to even; null ``wd`` gives null."""
    scaled = (count.cast("double") / wd) * F.lit(float(fv.STANDARD_MONTH_DAYS))
    return F.bround(F.when(wd == 0, count.cast("double")).otherwise(scaled), 0)
