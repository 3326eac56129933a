"""The grouping specs of the published table, as data.

A spec names a primary level (and optionally a second level), the cleaned
column that gives each level's value, and an optional intent subset the rows
must be in.  National specs may have a second level; Cancer Alliance and ICB
specs never do.  Each spec is counted by year and by month.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..functions import fixed_values as fv


@dataclass(frozen=True)
class Spec:
    prim_lvl: str
    prim_col: str | None          # None: the level has no value (Total)
    lvl_2: str | None = None
    lvl_2_col: str | None = None
    intents: tuple[str, ...] | None = None   # row filter on the recoded intent


@dataclass(frozen=True)
class Geo:
    geo_lvl: str
    geo_val_col: str | None       # None: the fixed national value
    geo_val: str | None = None


CURATIVE_PALLIATIVE = ("Curative", "Palliative")
CURATIVE = ("Curative",)

NATIONAL_SPECS: list[Spec] = [
    Spec(fv.LVL_TOTAL, None),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE"),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE", fv.LVL_AGE, "AGEGROUP"),
    Spec(fv.LVL_AGE, "AGEGROUP", fv.LVL_TUMOUR, "CANCERTYPE"),
    Spec(fv.LVL_AGE, "AGEGROUP"),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE", fv.LVL_ETHNICITY, "ETHNICITY"),
    Spec(fv.LVL_ETHNICITY, "ETHNICITY"),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE", fv.LVL_GENDER, "GENDER"),
    Spec(fv.LVL_GENDER, "GENDER"),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE", fv.LVL_DEPRIVATION, "DEPRIVATION"),
    Spec(fv.LVL_DEPRIVATION, "DEPRIVATION"),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE", fv.LVL_INTENT, "INTENT", CURATIVE_PALLIATIVE),
    Spec(fv.LVL_INTENT, "INTENT", intents=CURATIVE_PALLIATIVE),
    Spec(fv.LVL_SCHEDULE, "DOSE_FRACTIONATION_SCHEDULES"),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE", fv.LVL_SCHEDULE, "DOSE_FRACTIONATION_SCHEDULES"),
    Spec(fv.LVL_SCHEDULE, "DOSE_FRACTIONATION_SCHEDULES", fv.LVL_TUMOUR, "CANCERTYPE"),
    Spec(fv.LVL_CATEGORY, "FRACTIONATION_CATEGORY", intents=CURATIVE),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE", fv.LVL_CATEGORY, "FRACTIONATION_CATEGORY", CURATIVE),
    Spec(fv.LVL_CATEGORY, "FRACTIONATION_CATEGORY", fv.LVL_TUMOUR, "CANCERTYPE", CURATIVE),
]

AREA_SPECS: list[Spec] = [
    Spec(fv.LVL_TOTAL, None),
    Spec(fv.LVL_TUMOUR, "CANCERTYPE"),
    Spec(fv.LVL_AGE, "AGEGROUP"),
    Spec(fv.LVL_GENDER, "GENDER"),
    Spec(fv.LVL_ETHNICITY, "ETHNICITY"),
    Spec(fv.LVL_DEPRIVATION, "DEPRIVATION"),
    Spec(fv.LVL_INTENT, "INTENT", intents=CURATIVE_PALLIATIVE),
]

NATIONAL = Geo(fv.GEO_NATIONAL[0], None, fv.GEO_NATIONAL[1])
ALLIANCE = Geo(fv.GEO_ALLIANCE, "CANCER_ALLIANCE_NEW")
ICB = Geo(fv.GEO_ICB, "ICB")

# (geography, specs) families of the published table: 19 + 7 + 7 specs,
# each by year and by month = 66 grouping specs.
FAMILIES: list[tuple[Geo, list[Spec]]] = [
    (NATIONAL, NATIONAL_SPECS),
    (ALLIANCE, AREA_SPECS),
    (ICB, AREA_SPECS),
]
PERIODS = (fv.PERIOD_YEAR, fv.PERIOD_MONTH)


def all_specs(geos: tuple[str, ...] | None = None,
              periods: tuple[str, ...] = PERIODS) -> list[tuple[str, Geo, Spec]]:
    out = []
    for geo, specs in FAMILIES:
        if geos is not None and geo.geo_lvl not in geos:
            continue
        for period in periods:
            out.extend((period, geo, s) for s in specs)
    return out
