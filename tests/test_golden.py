"""Hand-computed results for a tiny set of episodes (SURVEY section 5 (e)).

E1  patient 1 (born 1950-06-01, male), provider RH1 (merged into R1H),
    breast C501, intent 02, two attendances in March 2020, 40 Gy / 15 fx,
    modality 05.  Addresses: dated 2019-01-01 (North ICB, IMD 3) and
    2021-01-01 (South ICB): the earlier one is the latest on/before start.
E2  patient 2 (17 at treatment): dropped by the adult filter.
E3  episode id used by patients 3 and 4 at one provider: a duplicate, dropped.
E4  patient 5, lung C341 with region O: not lung but OTHER ICD CODES;
    palliative, 8 Gy in 1 fraction, machine admitted under modality 06;
    no address at all.
E5  patient 6, provider 7A1 (Wales): in the extract, dropped by cleaning.
"""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from episcope.operators import aggregate as AG
from episcope.operators import clean as CL
from episcope.operators import extract as X
from episcope.sources.fixtures import Inputs

D = dt.date


def _inputs(spark) -> Inputs:
    ep = spark.createDataFrame([
        (11, "E1", 1, "RH1", D(2020, 3, 2), "02", "C501"),
        (12, "E1", 1, "RH1", D(2020, 3, 9), "02", "C501"),
        (21, "E2", 2, "RAJ", D(2020, 5, 1), "02", "C61"),
        (31, "E3", 3, "RAJ", D(2021, 1, 4), "02", "C61"),
        (32, "E3", 4, "RAJ", D(2021, 1, 5), "02", "C61"),
        (41, "E4", 5, "RDE", D(2022, 7, 1), "01", "C341"),
        (51, "E5", 6, "7A1", D(2022, 8, 1), "02", "C20"),
    ], "attendid long, radiotherapyepisodeid string, patientid long, orgcodeprovider string, "
       "treatmentstartdate date, radiotherapyintent string, radiotherapydiagnosisicd string")
    rx_schema = T.StructType([
        T.StructField("attendid", T.LongType()), T.StructField("radiotherapyepisodeid", T.StringType()),
        T.StructField("patientid", T.LongType()), T.StructField("orgcodeprovider", T.StringType()),
        T.StructField("prescriptionid", T.StringType()),
        T.StructField("rtprescribeddose", T.DecimalType(8, 3)),
        T.StructField("prescribedfractions", T.IntegerType()),
        T.StructField("rttreatmentmodality", T.StringType()), T.StructField("rttreatmentregion", T.StringType()),
    ])
    rx = spark.createDataFrame([
        (11, "E1", 1, "RH1", "P1", Decimal("40"), 15, "05", "P"),
        (12, "E1", 1, "RH1", "P2", Decimal("40"), 15, "05", "P"),
        (21, "E2", 2, "RAJ", "P3", Decimal("60"), 20, "05", "P"),
        (31, "E3", 3, "RAJ", "P4", Decimal("60"), 20, "05", "P"),
        (32, "E3", 4, "RAJ", "P5", Decimal("60"), 20, "05", "P"),
        (41, "E4", 5, "RDE", "P6", Decimal("8"), 1, "06", "O"),
        (51, "E5", 6, "7A1", "P7", Decimal("25"), 5, "05", "P"),
    ], rx_schema)
    ex = spark.createDataFrame([
        (11, "E1", 1, "RH1", "P1", "M1"), (12, "E1", 1, "RH1", "P2", "M1"),
        (21, "E2", 2, "RAJ", "P3", "M1"), (31, "E3", 3, "RAJ", "P4", "M1"),
        (32, "E3", 4, "RAJ", "P5", "M1"), (41, "E4", 5, "RDE", "P6", "RHQOT1816"),
        (51, "E5", 6, "7A1", "P7", "M1"),
    ], "attendid long, radiotherapyepisodeid string, patientid long, orgcodeprovider string, "
       "prescriptionid string, machineid string")
    pa = spark.createDataFrame([
        (1, D(1950, 6, 1), 1, "A", "WHITE BRITISH"), (2, D(2003, 1, 1), 2, "A", "WHITE BRITISH"),
        (3, D(1960, 1, 1), 1, "A", "WHITE BRITISH"), (4, D(1961, 1, 1), 1, "A", "WHITE BRITISH"),
        (5, D(1940, 1, 1), 2, "R", "CHINESE"), (6, D(1945, 1, 1), 1, None, None),
    ], "patientid long, birthdatebest date, sex int, ethnicity string, ethnicityname string")
    addr = spark.createDataFrame([
        (100, 1, D(2019, 1, 1), "PC1"), (101, 1, D(2021, 1, 1), "PC2"), (102, 6, None, "PC1"),
    ], "addressid long, patientid long, dateofaddress date, postcode string")
    nspl = spark.createDataFrame([("PC1", "E01", 1), ("PC2", "E02", 1)], "pcd string, lsoa11 string, hlthau int")
    hl = spark.createDataFrame([(1, "Some Authority")], "hlthaucd int, hlthaunm string")
    icb = spark.createDataFrame([("E01", "North Integrated Care Board"), ("E02", "South Integrated Care Board")],
                                "lsoa11cd string, icb22nm string")
    imd = spark.createDataFrame([("E01", "3"), ("E02", "5 - least deprived")],
                                "lsoa11_code string, imd19_quintile_lsoas string")
    net = spark.createDataFrame([
        (c, "Wales" if c == "7A1" else "England", f"Provider {c}", f"Network {c}", f"Alliance {c}", f"Alliance {c}")
        for c in ("R1H", "RAJ", "RDE", "7A1")],
        "provider_code string, country string, provider_name string, rt_network_name string, "
        "cancer_alliance_old string, cancer_alliance_new string")
    wd = spark.createDataFrame([("2020-03-01", 21), ("2022-07-01", 20)], "calendar_month string, working_days int")
    trusts = net.selectExpr("provider_code AS code", "provider_name AS trustname")
    return Inputs(ep, rx, ex, pa, addr, nspl, hl, icb, imd, net, wd, trusts)


def test_golden_extract(spark):
    ext = X.extract(_inputs(spark))
    rows = {r["RADIOTHERAPYEPISODEID"]: r.asDict() for r in ext.collect()}
    assert set(rows) == {"E1", "E4", "E5"}
    e1 = rows["E1"]
    assert e1 == {
        "ORGCODEPROVIDER": "R1H", "COUNTRY": "England", "PROVIDER_NAME": "Provider R1H",
        "RT_NETWORK_NAME": "Network R1H", "CANCER_ALLIANCE_OLD": "Alliance R1H",
        "CANCER_ALLIANCE_NEW": "Alliance R1H", "CALENDAR_MONTH": "2020/03", "CANCERTYPE": "BREAST",
        "INTENT": "RADICAL", "FRACTIONATION_CATEGORY": "mild-moderate hypofractionation",
        "AGE": "60 - 69", "ETHNICITY": "A", "ETHNICITYNAME": "WHITE BRITISH", "SEX": 1, "SEXNAME": "Male",
        "IMD19_QUINTILE_LSOAS": "3", "ICB_HB": "North Integrated Care Board", "RADIOTHERAPYEPISODEID": "E1",
        "DOSE_FRACTIONATION_SCHEDULES": "40 Gy in 15 fractions", "SCHEDULE_GROUP": "inside RCR schedules",
        "COUNT": 1,
    }
    e4 = rows["E4"]
    assert (e4["CANCERTYPE"], e4["INTENT"], e4["DOSE_FRACTIONATION_SCHEDULES"], e4["SCHEDULE_GROUP"],
            e4["FRACTIONATION_CATEGORY"], e4["ICB_HB"], e4["IMD19_QUINTILE_LSOAS"], e4["AGE"]) == (
        "OTHER ICD CODES", "PALLIATIVE", "single fraction", "outside curative RCR schedules",
        "other/non-curative fractionation", None, None, "80 - 89")
    e5 = rows["E5"]
    assert (e5["COUNTRY"], e5["ICB_HB"], e5["IMD19_QUINTILE_LSOAS"], e5["SEXNAME"], e5["ETHNICITYNAME"]) == (
        "Wales", "North Integrated Care Board", "3", "Male", None)


def test_golden_published(spark):
    inp = _inputs(spark)
    pub = AG.publish(CL.clean(X.extract(inp), inp.working_days))
    got = {(r.period, r.activity_year, r.activity_month, r.geo_lvl, r.geo_val, r.prim_lvl, r.prim_val,
            r.lvl_2, r.lvl_2_val): (r.episodeCount, r.wd, r.adjusted) for r in pub.collect()}
    # E1 only: E4 is female with other ICD codes (kept), E5 is Welsh (dropped).
    assert got[("Year", 2020, None, "National", "England", "Total", None, None, None)] == (1, 0.0, 1.0)
    assert got[("Month", 2020, 3, "National", "England", "Total", None, None, None)] == (1, 21.0, 1.0)
    assert got[("Month", 2022, 7, "National", "England", "Tumour group", "OTHER ICD CODES", None, None)] \
        == (1, 20.0, 1.0)
    # Schedules counted below 5 are folded into 'other' (national rows).
    assert got[("Year", 2020, None, "National", "England", "Dose fractionation schedules", "other",
                None, None)] == (1, 0.0, 1.0)
    # Area rows are not folded; the ICB name loses its suffix.
    assert got[("Year", 2020, None, "Integrated Care Board", "North", "Tumour group", "Breast",
                None, None)] == (1, 0.0, 1.0)
    assert got[("Year", 2020, None, "Cancer Alliance", "Alliance R1H", "Treatment intent", "Curative",
                None, None)] == (1, 0.0, 1.0)
    # E4's patient has no address: its ICB is 'Postcode not matched' and ICB rows for it are dropped.
    assert not [k for k in got if k[3] == "Integrated Care Board" and k[1] == 2022]
    # Palliative episodes are not in the fractionation-category specs (curative only).
    assert not [k for k in got if k[5] == "Fractionation category" and k[1] == 2022]
