"""Fixed values.

Everything in this module is a value that must equal the published
specification of the radiotherapy dose-and-fractionation statistics for the
results to be right: code lists, rule boxes, labels and recode tables.  They
are stated plainly, in the order the specification gives them, and are not
derived from anything.  Column logic lives in ``classify.py`` / ``recode.py``.
"""

from __future__ import annotations

from decimal import Decimal

# --------------------------------------------------------------------------
# FIXED VALUES -- extract stage
# --------------------------------------------------------------------------

# Provider codes merged into a successor organisation (old -> new).
PROVIDER_MERGES: list[tuple[str, str]] = [
    ("RH1", "R1H"),
    ("RP6", "R1H"),
    ("RNL", "RNN"),
    ("RGQ", "RDE"),
    ("RQ8", "RAJ"),
    ("RDD", "RAJ"),
    ("RBA", "RH5"),
    ("RA3", "RA7"),
    ("RDZ", "R0D"),
    ("RD3", "R0D"),
    ("RNJ", "R1H"),
    ("RXH", "RYR"),
    ("E0A", "RYR"),
]

# Tumour groups by the first three characters of the ICD-10 diagnosis, in
# the order they are tested (first match wins).
TUMOUR_GROUPS: list[tuple[str, list[str]]] = [
    ("HEAD AND NECK", ["C00", "C01", "C02", "C03", "C04", "C05", "C06", "C07", "C08",
                       "C09", "C10", "C11", "C12", "C13", "C14", "C30", "C31", "C32"]),
    ("BREAST", ["C50", "D05"]),
    ("OESOPHAGUS", ["C15"]),
    ("LYMPHOMA", ["C81", "C82", "C83", "C84", "C85", "C86"]),
    ("PROSTATE", ["C61"]),
    ("LUNG", ["C33", "C34"]),
    ("RECTAL", ["C20"]),
    ("CERVIX", ["C53"]),
    ("ANAL", ["C21"]),
    ("BLADDER", ["C67"]),
    ("BRAIN", ["C70", "C71", "D32", "D33"]),
    ("SKIN", ["C44"]),
]
OTHER_TUMOUR = "OTHER ICD CODES"
# Lung also needs a treatment region other than this one (null fails too).
LUNG_EXCLUDED_REGION = "O"

# The ICD white-list of the extract: the same 39 codes as TUMOUR_GROUPS.
ICD_WHITELIST: list[str] = [
    "C00", "C01", "C02", "C03", "C04", "C05", "C06", "C07", "C08", "C09", "C10", "C11",
    "C12", "C13", "C14", "C30", "C31", "C32", "C50", "D05", "C15", "C33", "C34", "C44",
    "C20", "C53", "C21", "C67", "C81", "C82", "C83", "C84", "C85", "C86", "C61", "C70",
    "C71", "D32", "D33",
]

# Treatment modality admitted on its own, and machines admitted under any
# modality.
RT_MODALITY = "05"
ADMITTED_MACHINES: list[str] = [
    "RA7OT1887", "RHQOT1816", "RHQOT1817", "R1HOT2041", "R1HOT3116", "RTHOT3117",
    "RR8OT3006", "RNJLA1743", "RWHLA1685", "RRKLA1819", "RPYLA1894", "RPYLA1978",
]

# Intent code -> rank (anything else, null included, ranks 4).
INTENT_RANKS: list[tuple[str, int]] = [("01", 1), ("02", 2), ("03", 3)]
INTENT_RANK_OTHER = 4
# Rank -> label.
INTENT_LABELS: list[tuple[int, str]] = [(1, "PALLIATIVE"), (2, "RADICAL")]
INTENT_LABEL_OTHER = "OTHER/UNKNOWN"

# Age at treatment -> band: (lowest age, highest age or None, label).
AGE_BANDS: list[tuple[int | None, int | None, str]] = [
    (None, 39, "< 40"),
    (40, 49, "40 - 49"),
    (50, 59, "50 - 59"),
    (60, 69, "60 - 69"),
    (70, 79, "70 - 79"),
    (80, 89, "80 - 89"),
    (90, None, "90+"),
]
AGE_BAND_OTHER = "unknown"
ADULT_AGE = 18
DAYS_PER_YEAR = 365.25

# Sex code -> name.
SEX_NOT_KNOWN_CODES = [0, 9]
SEX_NOT_KNOWN = "Not Known/ Not Specified/Null"
SEX_NAMES: list[tuple[int, str]] = [(1, "Male"), (2, "Female")]
SEX_NAME_OTHER = "Unknown"

# Fractionation category by dose per fraction (rounded to 2 decimals), only
# for radical (rank 2) episodes: (lowest, highest or None, label).
FRACTIONATION_CATEGORIES: list[tuple[Decimal | None, Decimal | None, str]] = [
    (None, None, "less than 2Gy per fraction"),  # < 2
    (Decimal("2"), Decimal("2.49"), "standard fractionation"),
    (Decimal("2.5"), Decimal("4.99"), "mild-moderate hypofractionation"),
    (Decimal("5"), None, "ultra hypofractionation"),
]
FRACTIONATION_LESS_THAN = Decimal("2")
FRACTIONATION_OTHER = "other/non-curative fractionation"

# Palliative (rank 1) schedules by number of fractions: (lo, hi or None, label).
PALLIATIVE_SCHEDULES: list[tuple[int, int | None, str]] = [
    (1, 1, "single fraction"),
    (2, 5, "2 to 5 fractions"),
    (6, 10, "6 to 10 fractions"),
    (11, None, "over 10 fractions"),
]
SCHEDULE_OTHER = "other"

# Radical (rank 2) schedule boxes, first match wins:
# (tumour, dose lo, dose hi, fractions lo, fractions hi, label).  Bounds are
# inclusive, dose in Gy.
D = Decimal
SCHEDULE_BOXES: list[tuple[str, Decimal, Decimal, int, int, str]] = [
    ("ANAL", D("49"), D("55"), 28, 28, "50-54 Gy in 28 fractions"),
    ("ANAL", D("39"), D("41"), 28, 28, "40 Gy in 28 fractions"),
    ("ANAL", D("19"), D("31"), 5, 15, "20-30 Gy in 5-15 fractions"),
    ("BLADDER", D("59"), D("65"), 30, 32, "60-64 Gy in 30-32 fractions"),
    ("BLADDER", D("51.5"), D("56"), 20, 20, "52.5-55 Gy in 20 fractions"),
    ("BRAIN", D("12"), D("26"), 1, 5, "13-25 Gy in 1-5 fractions"),
    ("BRAIN", D("29"), D("41"), 6, 15, "30-40 Gy in 6-15 fractions"),
    ("BRAIN", D("35"), D("46"), 15, 20, "36-45 Gy in 15-20 fractions"),
    ("BRAIN", D("44"), D("67"), 25, 33, "45-66 Gy in 25-33 fractions"),
    ("BREAST", D("47"), D("49"), 15, 15, "48 Gy in 15 fractions"),
    ("BREAST", D("39"), D("41"), 15, 15, "40 Gy in 15 fractions"),
    ("BREAST", D("25"), D("27"), 5, 5, "26 Gy in 5 fractions"),
    ("CERVIX", D("39"), D("66"), 20, 28, "40-65 Gy in 20-28 fractions"),
    ("HEAD AND NECK", D("65"), D("71"), 33, 35, "66-70 Gy in 33-35 fractions"),
    ("HEAD AND NECK", D("59"), D("67"), 28, 30, "60-66 Gy in 28-30 fractions"),
    ("HEAD AND NECK", D("49"), D("56"), 16, 20, "50-55 Gy in 16-20 fractions"),
    ("HEAD AND NECK", D("53"), D("61"), 30, 35, "54-60 Gy in 30-35 fractions"),
    ("LUNG", D("53"), D("55"), 36, 36, "54 Gy in 36 fractions"),
    ("LUNG", D("44"), D("67"), 25, 33, "45-66 Gy in 25-33 fractions"),
    ("LUNG", D("39"), D("56"), 15, 20, "40-55 Gy in 15-20 fractions"),
    ("LUNG", D("29"), D("61"), 1, 8, "30-60 Gy in 1-8 fractions"),
    ("LYMPHOMA", D("35"), D("46"), 20, 25, "36-45 Gy in 20-25 fractions"),
    ("LYMPHOMA", D("19"), D("35"), 10, 15, "20-34 Gy in 10-15 fractions"),
    ("LYMPHOMA", D("19"), D("31"), 5, 6, "20-30 Gy in 5-6 fractions"),
    ("LYMPHOMA", D("35"), D("40"), 9, 13, "36-39 Gy in 9-13 fractions"),
    ("SKIN", D("49"), D("56"), 15, 20, "50-55 Gy in 15-20 fractions"),
    ("SKIN", D("44"), D("46"), 10, 10, "45 Gy in 10 fractions"),
    ("SKIN", D("39"), D("41"), 8, 8, "40 Gy in 8 fractions"),
    ("SKIN", D("34"), D("36"), 4, 5, "35 Gy in 4-5 fractions"),
    ("SKIN", D("31.5"), D("33.5"), 4, 5, "32.5 Gy in 4-5 fractions"),
    ("SKIN", D("17"), D("21"), 1, 1, "18-20 Gy in 1 fraction"),
    ("SKIN", D("49"), D("67"), 25, 33, "50-66 Gy in 25-33 fractions"),
    ("OESOPHAGUS", D("40.5"), D("46"), 23, 28, "41.5-45 Gy in 23-28 fractions"),
    ("OESOPHAGUS", D("49"), D("67"), 25, 30, "50-66 Gy in 25-30 fractions"),
    ("OESOPHAGUS", D("39"), D("56"), 15, 20, "40-55 Gy in 15-20 fractions"),
    ("PROSTATE", D("65"), D("79"), 33, 39, "66-78 Gy in 33-39 fractions"),
    ("PROSTATE", D("51.5"), D("61"), 20, 20, "52.5-60 Gy in 20 fractions"),
    ("PROSTATE", D("35.25"), D("37.25"), 5, 5, "36.25 Gy in 5 fractions"),
    ("PROSTATE", D("36.5"), D("38.5"), 15, 15, "37.5 Gy in 15 fractions"),
    ("PROSTATE", D("45"), D("51"), 23, 25, "46-50 Gy in 23-25 fractions"),
    ("RECTAL", D("44"), D("51.4"), 25, 28, "45-50.4 Gy in 25-28 fractions"),
    ("RECTAL", D("24"), D("26"), 5, 5, "25 Gy in 5 fractions"),
]

# Schedule group.  Palliative episodes are outside the curative schedules; a
# radical episode inside one of SCHEDULE_BOXES is inside, unless one of these
# boxes (tested first) puts it outside; everything else is outside.
SCHEDULE_GROUP_PALLIATIVE = "outside curative RCR schedules"
SCHEDULE_GROUP_INSIDE = "inside RCR schedules"
SCHEDULE_GROUP_OUTSIDE = "outside selected schedules"
SCHEDULE_GROUP_OVERRIDES: list[tuple[str, Decimal, Decimal, int, int]] = [
    ("BRAIN", D("44"), D("46"), 20, 20),
    ("BREAST", D("49"), D("51"), 25, 25),
    ("LUNG", D("49"), D("51"), 5, 5),
    ("LUNG", D("59"), D("61"), 5, 5),
    ("LUNG", D("29"), D("35"), 1, 1),
    ("LUNG", D("44"), D("51"), 4, 5),
    ("LUNG", D("49"), D("51"), 16, 16),
    ("LUNG", D("49"), D("51"), 25, 25),
]
del D

# Extraction period and the reporting cut-offs (parameters of a monthly run).
PERIOD_START = "2019-01-01"
PERIOD_END = "2024-05-31"
COMPLETE_MONTH_CUTOFF = "2024-04-01"   # extract months kept: <= this month
WORKING_DAY_CUTOFF = "2024-04-01"      # working-day months kept: < this month

# --------------------------------------------------------------------------
# FIXED VALUES -- clean and aggregate stage
# --------------------------------------------------------------------------

# Provider patched by hand before the merge map existed.
PATCHED_PROVIDER = "E0A"
PATCHED_PROVIDER_VALUES = {
    "COUNTRY": "England",
    "PROVIDER_NAME": "University Hospitals Sussex NHS Foundation Trust",
    "RT_NETWORK_NAME": "West London, North London, Surrey and Sussex",
    "CANCER_ALLIANCE_OLD": "Surrey and Sussex",
    "CANCER_ALLIANCE_NEW": "Surrey and Sussex",
}
PATCHED_PROVIDER_CODES = ["E0A", "RXH"]
PATCHED_PROVIDER_TARGET = "RYR"

ENGLAND = "England"

INTENT_RECODE = {
    "PALLIATIVE": "Palliative",
    "RADICAL": "Curative",
    "OTHER/UNKNOWN": "Other/unknown",
}

AGE_RECODE = {
    "< 40": "<50",
    "40 - 49": "<50",
    "50 - 59": "50-59",
    "60 - 69": "60-69",
    "70 - 79": "70-79",
    "80 - 89": "80+",
    "90+": "80+",
}

# Sex code -> gender; codes not listed become null.
GENDER_RECODE = {1: "Male", 2: "Female", 0: "Other"}
GENDER_EXCLUDED = "Other"

ETHNICITY_RECODE = {
    "WHITE BRITISH": "White",
    "ANY OTHER ASIAN BACKGROUND": "Asian",
    "ASIAN INDIAN": "Asian",
    "CHINESE": "Asian",
    "ASIAN BANGLADESHI": "Asian",
    "ANY OTHER BLACK BACKGROUND": "Black",
    "BLACK AFRICAN": "Black",
    "BLACK CARIBBEAN": "Black",
    "ASIAN PAKISTANI": "Asian",
    "MIXED WHITE AND BLACK CARIBBEAN": "Mixed/Other",
    "ANY OTHER ETHNIC GROUP": "Mixed/Other",
    "ANY OTHER MIXED BACKGROUND": "Mixed/Other",
    "MIXED WHITE AND BLACK AFRICAN": "Mixed/Other",
    "MIXED WHITE AND ASIAN": "Mixed/Other",
    "Polish": "White",
    "WHITE": "White",
    "WHITE IRISH": "White",
    "ANY OTHER WHITE BACKGROUND": "White",
    "English": "White",
    "NOT STATED": "Unknown",
    "NOT KNOWN": "Unknown",
}
UNKNOWN = "Unknown"

POSTCODE_NOT_MATCHED = "Postcode not matched"
# Home areas outside England's ICBs, reported as not matched.
NON_ICB_AREAS: list[str] = [
    "Swansea Bay University Health Board",
    "Cwm Taf Morgannwg University Health Board",
    "Cardiff and Vale University Health Board",
    "Hywel Dda University Health Board",
    "Aneurin Bevan University Health Board",
    "Betsi Cadwaladr University Health Board",
    "Powys Teaching Health Board",
    "Forth Valley",
    "Lanarkshire",
    "Tayside",
    "Borders",
    "Lothian",
    "Grampian",
    "Sark Health Authority",
    "Highland",
    "Health & Social Care Board",
    "Fife",
    "Greater Glasgow and Clyde",
    "Guernsey Health Authority",
    "Dumfries and Galloway",
    "Jersey Health Authority",
    "Isle of Man",
]
ICB_SUFFIX = " Integrated Care Board"

# (gender, tumour) pairs that cannot occur and are dropped.
IMPOSSIBLE_PAIRS = [("Female", "PROSTATE"), ("Male", "CERVIX")]

TUMOUR_RECODE = {
    "ANAL": "Anal",
    "BLADDER": "Bladder",
    "BRAIN": "Brain",
    "BREAST": "Breast",
    "CERVIX": "Cervix",
    "HEAD AND NECK": "Head and Neck",
    "LYMPHOMA": "Lymphoma",
    "LUNG": "Lung",
    "OESOPHAGUS": "Oesophagus",
    "PROSTATE": "Prostate",
    "RECTAL": "Rectal",
    "SKIN": "Skin",
}

CATEGORY_RECODE = {"other/non-curative fractionation": "other"}

# Level names of the published table.
LVL_TOTAL = "Total"
LVL_TUMOUR = "Tumour group"
LVL_AGE = "Age group"
LVL_ETHNICITY = "Ethnicity"
LVL_GENDER = "Gender"
LVL_DEPRIVATION = "Deprivation"
LVL_INTENT = "Treatment intent"
LVL_SCHEDULE = "Dose fractionation schedules"
LVL_CATEGORY = "Fractionation category"

GEO_NATIONAL = ("National", "England")
GEO_ALLIANCE = "Cancer Alliance"
GEO_ICB = "Integrated Care Board"

PERIOD_YEAR = "Year"
PERIOD_MONTH = "Month"

# Small counts of these levels are folded into "other" (national rows only).
LOW_COUNT_LEVELS = [LVL_CATEGORY, LVL_SCHEDULE]
LOW_COUNT_LIMIT = 5
LOW_COUNT_LABEL = "other"

# Working-day adjustment: counts are scaled to a month of this many days.
STANDARD_MONTH_DAYS = 21
