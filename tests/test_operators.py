"""Operator properties on the smallest fixture (SURVEY section 5 (d)) and
brute-force checks of the skew-safe rewrites against window forms."""

from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from episcope.functions import fixed_values as fv
from episcope.operators import address as AD
from episcope.operators import aggregate as AG
from episcope.operators import clean as CL
from episcope.operators import episodes as EPI
from episcope.operators import extract as X
from episcope.plans.calendar import chunk_calendar
from episcope.sources.fixtures import load_inputs


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    ra = Counter(tuple(r) for r in a.select(*cols).collect())
    rb = Counter(tuple(r) for r in b.select(*cols).collect())
    assert ra == rb


def test_chunk_calendar():
    cal = chunk_calendar("2019-01-01", "2024-05-31")
    assert [(c.start.isoformat(), c.end.isoformat()) for c in cal] == [
        ("2019-01-01", "2019-12-31"), ("2020-01-01", "2020-12-31"), ("2021-01-01", "2021-12-31"),
        ("2022-01-01", "2022-12-31"), ("2023-01-01", "2024-05-31")]


def test_duplicate_ids_match_count_distinct(spark):
    e = load_inputs(spark, SF_SMALL).at_episodes
    brute = (e.groupBy(EPI.EP).agg(F.countDistinct("patientid").alias("p"), F.countDistinct(EPI.PROV).alias("o"))
             .filter("p > 1 AND o = 1").select(EPI.EP))
    _same(EPI.duplicate_episode_ids(e), brute)


def test_semi_join_equals_inner_join(spark):
    inp = load_inputs(spark, SF_SMALL)
    p = inp.at_prescriptions
    semi = EPI.admitted(p, inp.at_exposures)
    x = inp.at_exposures.select(*EPI.RX_KEYS, "machineid")
    inner = (p.join(x, EPI.RX_KEYS, "inner")
             .filter((F.col("rttreatmentmodality") == "05") | F.col("machineid").isin(*fv.ADMITTED_MACHINES))
             .select(*p.columns).distinct())
    _same(semi, inner)


def test_first_known_and_max_match_windows(spark):
    inp = load_inputs(spark, SF_SMALL)
    rows = EPI.episode_rows(inp)
    w = Window.partitionBy(EPI.EP, EPI.PROV, "chunk_id").orderBy("treatmentstartdate", "patientid") \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    brute = rows.select(
        EPI.EP, EPI.PROV, "chunk_id",
        F.max("dose").over(w).alias("max_dose"), F.max("fractions").over(w).alias("max_fractions"),
        F.first("ethnicity", ignorenulls=True).over(w).alias("first_ethnicity"),
        F.first("ethnicityname", ignorenulls=True).over(w).alias("first_ethnicityname"),
        F.first("sex", ignorenulls=True).over(w).alias("first_sex")).distinct()
    _same(EPI.episode_summary(rows), brute)


def test_best_address_matches_row_number(spark):
    inp = load_inputs(spark, SF_SMALL)
    keys = EPI.episode_keys(inp)
    key_cols = EPI.EPISODE_KEY + ["calendar_month"]
    geo = AD.address_geography(inp)
    got = AD.best_address(keys, key_cols, geo)
    cand = keys.join(geo, "patientid", "left")
    w = Window.partitionBy(*key_cols).orderBy(
        AD.address_rank(F.col("dateofaddress"), F.col("treatmentstartdate")).asc(),
        F.col("addressid").asc_nulls_last(), F.col("icb_hb").asc_nulls_last(),
        F.col("imd19_quintile_lsoas").asc_nulls_last())
    brute = (cand.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
             .select(*key_cols, "icb_hb", "imd19_quintile_lsoas", "addressid"))
    _same(got, brute)


def test_count_per_matches_window(spark):
    inp = load_inputs(spark, SF_SMALL)
    rows = X.labelled_rows(inp).distinct()
    w = Window.partitionBy(*X.RECOUNT_KEY)
    _same(X.count_per(rows, X.RECOUNT_KEY), rows.withColumn("COUNT", F.count(F.lit(1)).over(w)))


def test_chunked_equals_single(spark):
    import __spark_entry__ as E
    q = E.queries()
    _same(q["chunked_equals_single"](spark, SF_SMALL), q["extract"](spark, SF_SMALL))


def _cleaned(spark):
    inp = load_inputs(spark, SF_SMALL)
    return CL.clean(X.extract(inp), inp.working_days)


def test_one_pass_equals_union_of_group_bys(spark):
    cleaned = _cleaned(spark).cache()
    specs = AG.all_specs()
    got = AG.count_episodes(cleaned, specs)
    parts = None
    for period, geo, spec in specs:
        df = cleaned if spec.intents is None else cleaned.filter(F.col("INTENT").isin(*spec.intents))
        yearly = period == fv.PERIOD_YEAR
        cols = [
            F.col("EPI_YEAR").cast("int").alias("activity_year"),
            (F.lit(None).cast("int") if yearly else F.col("EPI_MONTH").cast("int")).alias("activity_month"),
            F.lit(period).alias("period"),
            (F.lit(0.0) if yearly else F.col("WORKING_DAYS").cast("double")).alias("wd"),
            F.lit(geo.geo_lvl).alias("geo_lvl"),
            (F.lit(geo.geo_val) if geo.geo_val_col is None else F.col(geo.geo_val_col)).cast("string").alias("geo_val"),
            F.lit(spec.prim_lvl).alias("prim_lvl"),
            (F.lit(None) if spec.prim_col is None else F.col(spec.prim_col)).cast("string").alias("prim_val"),
            F.lit(spec.lvl_2).cast("string").alias("lvl_2"),
            (F.lit(None) if spec.lvl_2_col is None else F.col(spec.lvl_2_col)).cast("string").alias("lvl_2_val"),
        ]
        one = df.groupBy(*cols).agg(F.countDistinct(AG.EP).alias("episodeCount"))
        parts = one if parts is None else parts.unionByName(one)
    _same(got, parts)
    cleaned.unpersist()


def test_fold_keeps_totals(spark):
    counts = AG.count_episodes(_cleaned(spark)).cache()
    folded = AG.fold_low_counts(counts)
    k = ["activity_year", "activity_month", "period", "geo_lvl", "geo_val", "prim_lvl", "lvl_2"]
    before = counts.groupBy(*k).agg(F.sum("episodeCount").alias("s"))
    after = folded.groupBy(*k).agg(F.sum("episodeCount").alias("s"))
    _same(before, after)
    small = folded.filter((F.col("prim_lvl").isin(*fv.LOW_COUNT_LEVELS)) & (F.col("prim_val") != "other")
                          & (F.col("episodeCount") < fv.LOW_COUNT_LIMIT))
    assert small.count() == 0
    counts.unpersist()


def test_gender_filter_drops_null(spark):
    df = spark.createDataFrame([("Male",), ("Other",), (None,)], "GENDER string")
    assert [r[0] for r in CL.drop_other_gender(df).collect()] == ["Male"]


def test_unmatched_icb_keeps_null(spark):
    df = spark.createDataFrame(
        [(fv.GEO_ICB, fv.POSTCODE_NOT_MATCHED), (fv.GEO_ICB, None), (fv.GEO_ICB, "North"),
         (fv.GEO_ALLIANCE, fv.POSTCODE_NOT_MATCHED)], "geo_lvl string, geo_val string")
    assert AG.drop_unmatched_icb(df).count() == 3


def test_results_do_not_depend_on_partitioning(spark):
    """Every tie is broken explicitly, so the extract and the published
    table are the same whatever the shuffle partitioning."""
    inp = load_inputs(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a_ext = Counter(tuple(r) for r in X.extract(inp).collect())
        a_pub = Counter(tuple(r) for r in AG.publish(CL.clean(X.extract(inp), inp.working_days)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    b_ext = Counter(tuple(r) for r in X.extract(inp).collect())
    b_pub = Counter(tuple(r) for r in AG.publish(CL.clean(X.extract(inp), inp.working_days)).collect())
    assert a_ext == b_ext
    assert a_pub == b_pub
