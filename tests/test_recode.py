"""Cleaning recodes and their null rules."""

from pyspark.sql import functions as F

from episcope.functions import fixed_values as fv
from episcope.functions import recode as R


def test_gender_recode_unmatched_is_null(spark):
    df = spark.createDataFrame([(1,), (2,), (0,), (9,), (None,)], "sex int")
    assert [r[0] for r in df.select(R.recode_gender(F.col("sex"))).collect()] == \
        ["Male", "Female", "Other", None, None]


def test_ethnicity_deprivation_icb(spark):
    df = spark.createDataFrame(
        [("ASIAN INDIAN", None, None), ("UNLISTED GROUP", "", "Fife"), (None, "2", "X Integrated Care Board"),
         ("", "1 - most deprived", "")], "e string, imd string, icb string")
    out = df.select(R.recode_ethnicity(F.col("e")).alias("e"), R.deprivation(F.col("imd")).alias("d"),
                    R.icb_clean(F.col("icb")).alias("i")).collect()
    assert [r.e for r in out] == ["Asian", "UNLISTED GROUP", "Unknown", "Unknown"]
    assert [r.d for r in out] == ["Unknown", "Unknown", "2", "1 - most deprived"]
    assert [r.i for r in out] == [fv.POSTCODE_NOT_MATCHED, fv.POSTCODE_NOT_MATCHED, "X", fv.POSTCODE_NOT_MATCHED]


def test_working_day_adjust_half_even(spark):
    df = spark.createDataFrame([(1, 42.0), (3, 42.0), (5, 0.0), (7, None), (20, 20.0)], "n long, wd double")
    got = [r[0] for r in df.select(R.working_day_adjust(F.col("n"), F.col("wd"))).collect()]
    # 1/42*21 = 0.5 -> 0 and 3/42*21 = 1.5 -> 2 (half to even); wd 0 keeps the count.
    assert got == [0.0, 2.0, 5.0, None, 21.0]
