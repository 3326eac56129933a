"""Hot-key shape: one patient and one episode hold a large share of rows.
The pair-free and aggregate-joined-back forms must still equal the window
forms of the specification (computed here by brute force over all pairs)."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from episcope.operators import address as AD
from episcope.operators import episodes as EPI


def test_hot_patient_best_address(spark):
    rng = random.Random(3)
    start = dt.date(2019, 1, 1)
    # Patient 1 is hot: 600 treatment days and 300 addresses (some undated,
    # some on equal dates); 20 other patients have a few of each.
    keys = [(1, start + dt.timedelta(days=rng.randint(0, 1977))) for _ in range(600)]
    keys += [(p, start + dt.timedelta(days=rng.randint(0, 1977))) for p in range(2, 22) for _ in range(3)]
    addrs, aid = [], 0
    for p, n in [(1, 300)] + [(p, 2) for p in range(2, 22)]:
        for _ in range(n):
            aid += 1
            d = None if rng.random() < 0.1 else start + dt.timedelta(days=rng.randint(-3000, 2500))
            addrs.append((aid, p, d, rng.choice(["North", "South"]), rng.choice(["1", "5"])))
    kdf = spark.createDataFrame(sorted(set(keys)), "patientid long, treatmentstartdate date")
    geo = spark.createDataFrame(addrs, "addressid long, patientid long, dateofaddress date, "
                                       "icb_hb string, imd19_quintile_lsoas string")
    key_cols = ["patientid", "treatmentstartdate"]
    got = AD.best_address(kdf.withColumn("k", F.lit(1)), key_cols + ["k"], geo,
                          "2019-01-01", "2024-05-31").drop("k")
    w = Window.partitionBy(*key_cols).orderBy(
        AD.address_rank(F.col("dateofaddress"), F.col("treatmentstartdate")).asc(),
        F.col("addressid").asc_nulls_last(), F.col("icb_hb").asc_nulls_last(),
        F.col("imd19_quintile_lsoas").asc_nulls_last())
    brute = (kdf.join(geo, "patientid", "left").withColumn("rn", F.row_number().over(w))
             .filter("rn = 1").select(*key_cols, "icb_hb", "imd19_quintile_lsoas", "addressid"))
    cols = sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == \
        Counter(tuple(r) for r in brute.select(*cols).collect())


def test_hot_episode_summary(spark):
    rng = random.Random(4)
    # Demographics are patient attributes (equal on every row of a patient).
    person = {p: (rng.choice([None, "A", "B"]), rng.choice([None, 1, 2]), rng.choice([None, "X", "Y"]))
              for p in range(1, 6)}
    rows = []
    for i in range(3000):
        ep = "HOT" if i % 3 else f"E{i % 50}"
        p = rng.randint(1, 5)
        rows.append((ep, "R1H", 1, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 300)),
                     rng.randint(1, 40), *person[p], p))
    df = spark.createDataFrame(rows, "radiotherapyepisodeid string, orgcodeprovider string, chunk_id int, "
                                     "treatmentstartdate date, dose int, ethnicity string, sex int, "
                                     "ethnicityname string, patientid long").withColumn("fractions", F.col("dose"))
    w = Window.partitionBy(EPI.EP, EPI.PROV, "chunk_id").orderBy("treatmentstartdate", "patientid") \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    brute = df.select(
        EPI.EP, EPI.PROV, "chunk_id", F.max("dose").over(w).alias("max_dose"),
        F.max("fractions").over(w).alias("max_fractions"),
        F.first("ethnicity", ignorenulls=True).over(w).alias("first_ethnicity"),
        F.first("ethnicityname", ignorenulls=True).over(w).alias("first_ethnicityname"),
        F.first("sex", ignorenulls=True).over(w).alias("first_sex")).distinct()
    got = EPI.episode_summary(df)
    cols = sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == \
        Counter(tuple(r) for r in brute.select(*cols).collect())
