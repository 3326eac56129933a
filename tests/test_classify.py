"""Rule tables: boundary points of every box against a brute-force
first-match evaluation of the same ordered rules."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episcope.functions import classify as C
from episcope.functions import fixed_values as fv

SCHEMA = T.StructType([
    T.StructField("cancertype", T.StringType()),
    T.StructField("min_intent", T.IntegerType()),
    T.StructField("max_dose", T.DecimalType(8, 3)),
    T.StructField("max_fractions", T.IntegerType()),
])


def _expected_label(t, rank, dose, fx):
    if rank == 1 and fx is not None:
        for lo, hi, label in fv.PALLIATIVE_SCHEDULES:
            if (fx >= lo) and (hi is None or fx <= hi):
                return label
    if rank == 2 and dose is not None and fx is not None:
        for bt, dlo, dhi, flo, fhi, label in fv.SCHEDULE_BOXES:
            if bt == t and dlo <= dose <= dhi and flo <= fx <= fhi:
                return label
    return fv.SCHEDULE_OTHER


def _expected_group(t, rank, dose, fx):
    if rank == 1:
        return fv.SCHEDULE_GROUP_PALLIATIVE
    if rank == 2 and dose is not None and fx is not None:
        for bt, dlo, dhi, flo, fhi in fv.SCHEDULE_GROUP_OVERRIDES:
            if bt == t and dlo <= dose <= dhi and flo <= fx <= fhi:
                return fv.SCHEDULE_GROUP_OUTSIDE
        for bt, dlo, dhi, flo, fhi, _ in fv.SCHEDULE_BOXES:
            if bt == t and dlo <= dose <= dhi and flo <= fx <= fhi:
                return fv.SCHEDULE_GROUP_INSIDE
    return fv.SCHEDULE_GROUP_OUTSIDE


def _boundary_rows():
    eps = Decimal("0.001")
    rows = []
    boxes = [(b[0], b[1], b[2], b[3], b[4]) for b in fv.SCHEDULE_BOXES] + list(fv.SCHEDULE_GROUP_OVERRIDES)
    for t, dlo, dhi, flo, fhi in boxes:
        for dose in (dlo - eps, dlo, dhi, dhi + eps, (dlo + dhi) / 2):
            for fx in (flo - 1, flo, fhi, fhi + 1):
                for rank in (1, 2, 3):
                    rows.append((t, rank, dose.quantize(Decimal("0.001")), fx))
    rows += [("LUNG", 2, None, 5), ("LUNG", 2, Decimal("50"), None), ("BRAIN", 1, Decimal("20"), None),
             ("BRAIN", 1, Decimal("20"), 0), ("SKIN", 4, Decimal("40"), 8)]
    return rows


def test_schedule_label_and_group_boundaries(spark):
    rows = _boundary_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    t, r, d, f = "cancertype", "min_intent", "max_dose", "max_fractions"
    out = df.select("*", C.schedule_label(t, r, d, f).alias("label"),
                    C.schedule_group(t, r, d, f).alias("grp")).collect()
    assert len(out) == len(rows)
    for row in out:
        args = (row.cancertype, row.min_intent, row.max_dose, row.max_fractions)
        assert row.label == _expected_label(*args), args
        assert row.grp == _expected_group(*args), args


def test_overlapping_boxes_first_match(spark):
    # BRAIN 35-41 Gy in 15 fractions is in two boxes; the earlier one wins.
    df = spark.createDataFrame([("BRAIN", 2, Decimal("38"), 15)], SCHEMA)
    t, r, d, f = "cancertype", "min_intent", "max_dose", "max_fractions"
    assert df.select(C.schedule_label(t, r, d, f)).first()[0] == "30-40 Gy in 6-15 fractions"


@pytest.mark.parametrize("dose,fx,rank,expected", [
    ("39.8", 20, 2, "less than 2Gy per fraction"),      # 1.99
    ("39.9", 20, 2, "standard fractionation"),          # 1.995 -> 2.00 (half up)
    ("49.8", 20, 2, "standard fractionation"),          # 2.49
    ("49.85", 20, 2, "standard fractionation"),         # 2.4925 -> 2.49
    ("50", 20, 2, "mild-moderate hypofractionation"),   # 2.50
    ("99.8", 20, 2, "mild-moderate hypofractionation"),  # 4.99
    ("100", 20, 2, "ultra hypofractionation"),          # 5.00
    ("50", 0, 2, "other/non-curative fractionation"),   # zero fractions: no error
    ("50", None, 2, "other/non-curative fractionation"),
    ("50", 20, 1, "other/non-curative fractionation"),
])
def test_fractionation_category(spark, dose, fx, rank, expected):
    df = spark.createDataFrame([("X", rank, Decimal(dose), fx)], SCHEMA)
    got = df.select(C.fractionation_category("min_intent", "max_dose", "max_fractions")).first()[0]
    assert got == expected


def test_null_traps(spark):
    df = spark.createDataFrame(
        [(None, "C341", None, "01"), (9, "C341", "O", "02"), (0, "C340", "P", "03"),
         (1, "C501", None, None), (2, "C999", "R", "7"), (3, None, None, "")],
        "sex int, icd string, region string, intent string")
    out = df.select(C.sex_name(F.col("sex")).alias("sn"),
                    C.tumour_group(F.col("icd"), F.col("region")).alias("tg"),
                    C.intent_rank(F.col("intent")).alias("ir")).collect()
    assert [r.sn for r in out] == ["Unknown", fv.SEX_NOT_KNOWN, fv.SEX_NOT_KNOWN, "Male", "Female", "Unknown"]
    # Lung needs a region other than 'O'; a null region fails too.
    assert [r.tg for r in out] == ["OTHER ICD CODES", "OTHER ICD CODES", "LUNG", "BREAST",
                                   "OTHER ICD CODES", "OTHER ICD CODES"]
    assert [r.ir for r in out] == [1, 2, 3, 4, 4, 4]


def test_provider_remap_and_age(spark):
    df = spark.createDataFrame(
        [("RH1",), ("RDD",), ("RBA",), ("RDZ",), ("RD3",), ("RNJ",), ("E0A",), ("ZZZ",), (None,)], "p string")
    got = [r[0] for r in df.select(C.provider_remap(F.col("p"))).collect()]
    assert got == ["R1H", "RAJ", "RH5", "R0D", "R0D", "R1H", "RYR", "ZZZ", None]
    ages = spark.createDataFrame(
        [("2020-01-01", "1980-01-01"), ("2020-01-01", "1980-01-02"), ("2020-01-01", "1930-06-01"),
         ("2020-01-01", None)], "a string, b string")
    a = C.age_at(F.to_date("a"), F.to_date("b"))
    out = ages.select(a.alias("age"), C.age_band(a).alias("band")).collect()
    assert [r.age for r in out] == [40, 39, 89, None]
    assert [r.band for r in out] == ["40 - 49", "< 40", "80 - 89", "unknown"]


def _expected_category(rank, dose, fx):
    from decimal import ROUND_HALF_UP
    if rank != 2 or dose is None or not fx:
        return fv.FRACTIONATION_OTHER
    r = (dose / Decimal(fx)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    if r < 2:
        return "less than 2Gy per fraction"
    if Decimal("2") <= r <= Decimal("2.49"):
        return "standard fractionation"
    if Decimal("2.5") <= r <= Decimal("4.99"):
        return "mild-moderate hypofractionation"
    if r >= 5:
        return "ultra hypofractionation"
    return fv.FRACTIONATION_OTHER


def test_fractionation_category_random(spark):
    import random
    rng = random.Random(11)
    rows = []
    for _ in range(3000):
        dose = Decimal(rng.randint(0, 120000)) / 1000
        fx = rng.choice([None, 0] + list(range(1, 41)))
        rows.append(("X", rng.choice([1, 2, 2, 2, 3, 4]), dose, fx))
    df = spark.createDataFrame(rows, SCHEMA)
    out = df.select("*", C.fractionation_category("min_intent", "max_dose", "max_fractions").alias("c")).collect()
    for r in out:
        assert r.c == _expected_category(r.min_intent, r.max_dose, r.max_fractions), r


def test_schedule_label_and_group_random(spark):
    import random
    rng = random.Random(5)
    tumours = [g for g, _ in fv.TUMOUR_GROUPS] + [fv.OTHER_TUMOUR]
    rows = []
    for _ in range(4000):
        dose = None if rng.random() < 0.03 else Decimal(rng.randint(0, 90000)) / 1000
        fx = rng.choice([None, 0] + list(range(1, 45)))
        rows.append((rng.choice(tumours), rng.choice([1, 2, 2, 3, 4]), dose, fx))
    df = spark.createDataFrame(rows, SCHEMA)
    t, r, d, f = "cancertype", "min_intent", "max_dose", "max_fractions"
    out = df.select("*", C.schedule_label(t, r, d, f).alias("label"),
                    C.schedule_group(t, r, d, f).alias("grp")).collect()
    for row in out:
        args = (row.cancertype, row.min_intent, row.max_dose, row.max_fractions)
        assert row.label == _expected_label(*args), args
        assert row.grp == _expected_group(*args), args
