"""Column expressions that classify an episode (all JVM-side built-ins).

Each function returns a ``Column``; most take ``Column`` arguments, the dose
rules take column names (see below).  The rule tables live in
``fixed_values``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv


def _chain(arms: list[tuple[Column, Column]], otherwise: Column | None) -> Column:
    """``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE otherwise END``."""
    expr = F.when(arms[0][0], arms[0][1])
    for cond, val in arms[1:]:
        expr = expr.when(cond, val)
    return expr.otherwise(otherwise) if otherwise is not None else expr


def provider_remap(code: Column) -> Column:
    """Merge retired provider codes into their successor; others unchanged."""
    merges = F.create_map(*[F.lit(x) for pair in fv.PROVIDER_MERGES for x in pair])
    return F.coalesce(F.element_at(merges, code), code)


def month_label(d: Column) -> Column:
    """Treatment month as ``yyyy/MM`` text."""
    return F.date_format(d, "yyyy/MM")


def age_at(event_date: Column, birth_date: Column) -> Column:
    """Whole years between birth and the event, truncated toward zero."""
    return (F.datediff(event_date, birth_date) / F.lit(fv.DAYS_PER_YEAR)).cast("int")


def age_band(age: Column) -> Column:
    arms = []
    for lo, hi, label in fv.AGE_BANDS:
        if lo is None:
            cond = age <= hi
        elif hi is None:
            cond = age >= lo
        else:
            cond = age.between(lo, hi)
        arms.append((cond, F.lit(label)))
    return _chain(arms, F.lit(fv.AGE_BAND_OTHER))


def sex_name(sex: Column) -> Column:
    """Null sex is not in the not-known list (``NULL IN (...)`` is unknown)."""
    arms = [(sex.isin(*fv.SEX_NOT_KNOWN_CODES), F.lit(fv.SEX_NOT_KNOWN))]
    arms += [(sex == code, F.lit(name)) for code, name in fv.SEX_NAMES]
    return _chain(arms, F.lit(fv.SEX_NAME_OTHER))


def icd3(icd: Column) -> Column:
    return F.substring(icd, 1, 3)


def tumour_group(icd: Column, region: Column) -> Column:
    """Tumour group from the ICD-10 code; lung needs a region other than 'O'."""
    code = icd3(icd)
    arms = []
    for group, codes in fv.TUMOUR_GROUPS:
        cond = code.isin(*codes)
        if group == "LUNG":
            cond = cond & (region != F.lit(fv.LUNG_EXCLUDED_REGION))
        arms.append((cond, F.lit(group)))
    return _chain(arms, F.lit(fv.OTHER_TUMOUR))


def icd_whitelisted(icd: Column) -> Column:
    return icd3(icd).isin(*fv.ICD_WHITELIST)


def intent_rank(intent: Column) -> Column:
    arms = [(intent == code, F.lit(rank)) for code, rank in fv.INTENT_RANKS]
    return _chain(arms, F.lit(fv.INTENT_RANK_OTHER))


def intent_label(rank: Column) -> Column:
    arms = [(rank == r, F.lit(label)) for r, label in fv.INTENT_LABELS]
    return _chain(arms, F.lit(fv.INTENT_LABEL_OTHER))


def home_area(lsoa: Column, authority_name: Column, icb_name: Column) -> Column:
    """Outside England (LSOA not starting 'E', or unknown) the health
    authority names the home area, else the ICB."""
    outside = (F.substring(lsoa, 1, 1) != F.lit("E")) | lsoa.isNull()
    return F.when(outside, authority_name).otherwise(icb_name)


# The dose rules are long CASE chains.  They are generated once as SQL text
# from the rule tables and handed to Spark as one expression (``F.expr``):
# the same Catalyst expression as the equivalent ``when`` chain, built with
# one call instead of thousands of small ones.  Arguments are column names.

def _num(v) -> str:
    return str(v)


def _sql_box(dose: str, fx: str, dlo, dhi, flo, fhi) -> str:
    fcond = f"{fx} = {flo}" if flo == fhi else f"{fx} BETWEEN {flo} AND {fhi}"
    return f"({dose} BETWEEN {_num(dlo)} AND {_num(dhi)} AND {fcond})"


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def dose_per_fraction_sql(dose: str, fx: str) -> str:
    """``round(dose / fractions, 2)``; zero fractions give null, not an error."""
    return f"round(try_divide({dose}, {fx}), 2)"


def fractionation_category(rank: str, dose: str, fx: str) -> Column:
    r = dose_per_fraction_sql(dose, fx)
    arms = []
    for lo, hi, label in fv.FRACTIONATION_CATEGORIES:
        if lo is None and hi is None:
            cond = f"{r} < {fv.FRACTIONATION_LESS_THAN}"
        elif hi is None:
            cond = f"{r} >= {lo}"
        else:
            cond = f"{r} BETWEEN {lo} AND {hi}"
        arms.append(f"WHEN {rank} = 2 AND {cond} THEN {_sql_str(label)}")
    return F.expr("CASE " + " ".join(arms) + f" ELSE {_sql_str(fv.FRACTIONATION_OTHER)} END")


def _boxes_by_tumour(boxes) -> dict:
    out: dict[str, list] = {}
    for t, *rest in boxes:
        out.setdefault(t, []).append(rest)
    return out


def schedule_label(tumour: str, rank: str, dose: str, fx: str) -> Column:
    """Dose-fractionation schedule: palliative by number of fractions, radical
    by the first matching (tumour, dose, fractions) box, else 'other'.

    The radical boxes are grouped by tumour (one outer arm per tumour, its
    boxes in order inside), which keeps first-match order and lets a row test
    only its own tumour's boxes.
    """
    other = _sql_str(fv.SCHEDULE_OTHER)
    arms = []
    for lo, hi, label in fv.PALLIATIVE_SCHEDULES:
        fcond = f"{fx} = {lo}" if lo == hi else (
            f"{fx} >= {lo}" if hi is None else f"{fx} BETWEEN {lo} AND {hi}")
        arms.append(f"WHEN {rank} = 1 AND {fcond} THEN {_sql_str(label)}")
    for t, boxes in _boxes_by_tumour(fv.SCHEDULE_BOXES).items():
        inner = " ".join(f"WHEN {_sql_box(dose, fx, *b[:4])} THEN {_sql_str(b[4])}" for b in boxes)
        arms.append(f"WHEN {rank} = 2 AND {tumour} = {_sql_str(t)} THEN CASE {inner} ELSE {other} END")
    return F.expr("CASE " + " ".join(arms) + f" ELSE {other} END")


def _sql_any_box(tumour: str, dose: str, fx: str, boxes) -> str:
    parts = []
    for t, bs in _boxes_by_tumour(boxes).items():
        inner = " OR ".join(_sql_box(dose, fx, *b[:4]) for b in bs)
        parts.append(f"({tumour} = {_sql_str(t)} AND ({inner}))")
    return "(" + " OR ".join(parts) + ")"


def schedule_group(tumour: str, rank: str, dose: str, fx: str) -> Column:
    """Inside / outside the selected curative schedules.

    Override boxes come before the inside boxes of their tumour, and both the
    overrides and the default give 'outside', so a row is inside exactly when
    it hits an inside box and no override box.
    """
    inside = _sql_any_box(tumour, dose, fx, fv.SCHEDULE_BOXES)
    override = _sql_any_box(tumour, dose, fx, fv.SCHEDULE_GROUP_OVERRIDES)
    return F.expr(
        f"CASE WHEN {rank} = 1 THEN {_sql_str(fv.SCHEDULE_GROUP_PALLIATIVE)} "
        f"WHEN {rank} = 2 AND {inside} AND NOT coalesce({override}, false) "
        f"THEN {_sql_str(fv.SCHEDULE_GROUP_INSIDE)} "
        f"ELSE {_sql_str(fv.SCHEDULE_GROUP_OUTSIDE)} END")
