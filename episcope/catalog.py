"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

query reads the driver's tables through the fixture views and runs over all
of their rows; dates are returned as ``yyyy-MM-dd`` text and doses as
doubles so that results compare exactly across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import classify as C
from .functions import fixed_values as fv
from .functions import recode as R
from .operators import address as AD
from .operators import aggregate as AG
from .operators import clean as CL
from .operators import episodes as EPI
from .operators import extract as X
from .operators import reports as RP
from .plans.calendar import chunk_id, in_period
from .plans.chunked import chunk_rows, of_chunks
from .plans.params import DEFAULT, RunParams
from .sources.fixtures import load_inputs
from .sources.tables import Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _day(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def _dbl(c: str) -> Column:
    return F.col(c).cast("double")


def _n() -> Column:
    return F.count(F.lit(1)).alias("n_rows")


# -- shared stage builders ----------------------------------------------------

def extract_df(spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT) -> DataFrame:
    return X.extract(load_inputs(spark, sf_dir), params)


def _cleaned(inp: Inputs, params: RunParams = DEFAULT) -> DataFrame:
    return CL.clean(X.extract(inp, params), inp.working_days, params)


def cleaned_df(spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT) -> DataFrame:
    return _cleaned(load_inputs(spark, sf_dir), params)


def _patched_england_months(inp: Inputs, params: RunParams = DEFAULT) -> DataFrame:
    ext = CL.with_month_parts(CL.england_only(CL.patch_provider(X.extract(inp, params))))
    return CL.complete_months(ext, params)


# -- the published table and the extract --------------------------------------

@query("published_table")
def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AG.publish(cleaned_df(spark, sf_dir))


@query("extract")
def extract_query(spark, sf_dir):
    return extract_df(spark, sf_dir)


# -- sources and sinks ----------------------------------------------------------

@query("scan_episodes")
def scan_episodes(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    chunks = list(DEFAULT.chunks)
    e = inp.at_episodes.filter(in_period(F.col("treatmentstartdate"), chunks))
    return e.select("attendid", EPI.EP, "patientid", EPI.PROV, _day("treatmentstartdate").alias("treatmentstartdate"),
                    "radiotherapyintent", "radiotherapydiagnosisicd")


@query("chunk_calendar")
def chunk_calendar_query(spark, sf_dir):
    """Each chunk of the period with its bounds and the core rows and
    episodes that fall in it."""
    inp = load_inputs(spark, sf_dir)
    cal = spark.createDataFrame(
        [(c.chunk_id, c.start.isoformat(), c.end.isoformat()) for c in DEFAULT.chunks],
        "chunk_id int, chunk_start string, chunk_end string")
    return cal.join(EPI.chunk_counts(inp), "chunk_id", "left")


@query("qa_chunk_counts")
def qa_chunk_counts(spark, sf_dir):
    """Extract rows per chunk ("check each year is populated")."""
    ext = extract_df(spark, sf_dir)
    month = F.to_date(F.concat("CALENDAR_MONTH", F.lit("/01")), "yyyy/MM/dd")
    return (ext.withColumn("chunk_id", chunk_id(month, list(DEFAULT.chunks)))
            .groupBy("chunk_id").agg(_n()))


@query("duplicate_episode_report")
def duplicate_episode_report(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    dup = EPI.duplicate_episode_rows(inp.at_episodes)
    trusts = inp.trustsics.select(F.col("code").alias(EPI.PROV), "trustname")
    return (dup.join(trusts, EPI.PROV, "left")
            .select(EPI.EP, _day("treatmentstartdate").alias("treatmentstartdate"),
                    "patientid", EPI.PROV, "trustname"))


@query("working_days_clean")
def working_days_clean(spark, sf_dir):
    wd = CL.working_days_clean(load_inputs(spark, sf_dir).working_days)
    return wd.select(_day("CALENDAR_MONTH").alias("calendar_month"), "WORKING_DAYS")


# -- projections and classification ---------------------------------------------

@query("provider_remap")
def provider_remap(spark, sf_dir):
    e = load_inputs(spark, sf_dir).at_episodes
    return (e.select(F.col(EPI.PROV), C.provider_remap(F.col(EPI.PROV)).alias(EPI.MAPPED))
            .groupBy(EPI.PROV, EPI.MAPPED).agg(_n()))


@query("month_label")
def month_label(spark, sf_dir):
    e = load_inputs(spark, sf_dir).at_episodes
    return e.groupBy(C.month_label(F.col("treatmentstartdate")).alias("calendar_month")).agg(_n())


def _episode_patient(inp: Inputs) -> DataFrame:
    pa = inp.at_patient.select("patientid", "birthdatebest", "sex")
    return inp.at_episodes.join(pa, "patientid", "left")


@query("age_at_event")
def age_at_event(spark, sf_dir):
    rows = _episode_patient(load_inputs(spark, sf_dir))
    return (rows.groupBy(C.age_at(F.col("treatmentstartdate"), F.col("birthdatebest")).alias("tx_age"))
            .agg(_n()))


@query("age_band")
def age_band(spark, sf_dir):
    rows = _episode_patient(load_inputs(spark, sf_dir))
    age = C.age_at(F.col("treatmentstartdate"), F.col("birthdatebest"))
    return rows.groupBy(C.age_band(age).alias("age")).agg(_n())


@query("sex_name")
def sex_name(spark, sf_dir):
    pa = load_inputs(spark, sf_dir).at_patient
    return pa.groupBy("sex", C.sex_name(F.col("sex")).alias("sexname")).agg(_n())


@query("tumour_group")
def tumour_group(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    p = inp.at_prescriptions.select(*EPI.ATTEND_KEYS, "rttreatmentregion")
    rows = inp.at_episodes.join(p, EPI.ATTEND_KEYS, "inner")
    icd = F.col("radiotherapydiagnosisicd")
    return rows.groupBy(C.icd3(icd).alias("icd3"), "rttreatmentregion",
                        C.tumour_group(icd, F.col("rttreatmentregion")).alias("cancertype")).agg(_n())


@query("intent_rank")
def intent_rank(spark, sf_dir):
    e = load_inputs(spark, sf_dir).at_episodes
    return e.groupBy("radiotherapyintent",
                     C.intent_rank(F.col("radiotherapyintent")).alias("ordered_intent")).agg(_n())


@query("home_area")
def home_area(spark, sf_dir):
    geo = AD.address_geography(load_inputs(spark, sf_dir))
    return geo.groupBy("icb_hb", "imd19_quintile_lsoas").agg(_n())


def _keys(spark, sf_dir) -> DataFrame:
    return X.addressed_keys(load_inputs(spark, sf_dir))


@query("intent_label")
def intent_label(spark, sf_dir):
    k = _keys(spark, sf_dir)
    return k.groupBy("min_intent", C.intent_label(F.col("min_intent")).alias("intent")).agg(_n())


def _dose_cols():
    return [F.col("min_intent"), _dbl("max_dose").alias("max_dose"), F.col("max_fractions")]


@query("fractionation_category")
def fractionation_category(spark, sf_dir):
    k = _keys(spark, sf_dir)
    cat = C.fractionation_category("min_intent", "max_dose", "max_fractions")
    return k.select(*_dose_cols(), cat.alias("fractionation_category")).distinct()


@query("schedule_label")
def schedule_label(spark, sf_dir):
    k = _keys(spark, sf_dir)
    lab = C.schedule_label("cancertype", "min_intent", "max_dose", "max_fractions")
    return k.select("cancertype", *_dose_cols(), lab.alias("dose_fractionation_schedules")).distinct()


@query("schedule_group")
def schedule_group(spark, sf_dir):
    k = _keys(spark, sf_dir)
    grp = C.schedule_group("cancertype", "min_intent", "max_dose", "max_fractions")
    return k.select("cancertype", *_dose_cols(), grp.alias("schedule_group")).distinct()


@query("provider_patch")
def provider_patch(spark, sf_dir):
    """A hand-over that still holds the two merged codes: every seventh
    episode number is submitted under the one, the next under the other."""
    number = F.substring("RADIOTHERAPYEPISODEID", 2, 18).cast("long") % 7
    submitted = (F.when(number == 0, fv.PATCHED_PROVIDER_CODES[0]).when(number == 1, fv.PATCHED_PROVIDER_CODES[1])
                 .otherwise(F.col("ORGCODEPROVIDER")))
    ext = CL.patch_provider(extract_df(spark, sf_dir).withColumn("ORGCODEPROVIDER", submitted))
    return ext.groupBy("ORGCODEPROVIDER", "COUNTRY", "PROVIDER_NAME", "RT_NETWORK_NAME",
                       "CANCER_ALLIANCE_OLD", "CANCER_ALLIANCE_NEW").agg(_n())


@query("month_parts")
def month_parts(spark, sf_dir):
    ext = CL.with_month_parts(extract_df(spark, sf_dir))
    return ext.groupBy(_day("CALENDAR_MONTH").alias("calendar_month"), "EPI_YEAR", "EPI_MONTH").agg(_n())


def _recode_profile(name: str, src: str, recode_fn, out: str):
    @query(name)
    def q(spark, sf_dir):
        ext = extract_df(spark, sf_dir)
        return ext.groupBy(F.col(src), recode_fn(F.col(src)).alias(out)).agg(_n())
    q.__name__ = name
    return q


_recode_profile("recode_intent", "INTENT", R.recode_intent, "INTENT_RECODED")
_recode_profile("recode_age", "AGE", R.recode_age, "AGEGROUP")
_recode_profile("recode_gender", "SEX", R.recode_gender, "GENDER")
_recode_profile("recode_ethnicity", "ETHNICITYNAME", R.recode_ethnicity, "ETHNICITY_GROUP")
_recode_profile("deprivation_default", "IMD19_QUINTILE_LSOAS",
                R.deprivation, "DEPRIVATION")
_recode_profile("icb_clean", "ICB_HB", R.icb_clean, "ICB")
_recode_profile("recode_tumour", "CANCERTYPE", R.recode_tumour, "TUMOUR_GROUP")
_recode_profile("recode_category", "FRACTIONATION_CATEGORY",
                R.recode_category, "CATEGORY")


@query("working_day_adjust")
def working_day_adjust(spark, sf_dir):
    pub = published_table(spark, sf_dir)
    return pub.select("episodeCount", "wd", "adjusted").distinct()


# -- filters -------------------------------------------------------------------

@query("filter_period")
def filter_period(spark, sf_dir):
    e = load_inputs(spark, sf_dir).at_episodes
    chunks = list(DEFAULT.chunks)
    return (e.filter(in_period(F.col("treatmentstartdate"), chunks))
            .select("attendid", EPI.EP, _day("treatmentstartdate").alias("treatmentstartdate")))


@query("filter_modality_or_machine")
def filter_modality_or_machine(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    p = inp.at_prescriptions.select(*EPI.RX_KEYS, "rttreatmentmodality")
    return EPI.admitted(p, inp.at_exposures).select(*EPI.RX_KEYS, "rttreatmentmodality")


@query("filter_icd")
def filter_icd(spark, sf_dir):
    e = load_inputs(spark, sf_dir).at_episodes
    return (e.filter(C.icd_whitelisted(F.col("radiotherapydiagnosisicd")))
            .select("attendid", EPI.EP, "radiotherapydiagnosisicd"))


@query("drop_duplicate_episodes")
def drop_duplicate_episodes(spark, sf_dir):
    e = load_inputs(spark, sf_dir).at_episodes
    ids = EPI.duplicate_episode_ids(e)
    return EPI.drop_duplicate_episodes(e, ids).select("attendid", EPI.EP, "patientid", EPI.PROV)


@query("duplicate_episode_ids")
def duplicate_episode_ids(spark, sf_dir):
    return EPI.duplicate_episode_ids(load_inputs(spark, sf_dir).at_episodes)


@query("filter_adult")
def filter_adult(spark, sf_dir):
    rows = EPI.classified_rows(load_inputs(spark, sf_dir))
    return rows.select(EPI.EP, EPI.MAPPED, _day("treatmentstartdate").alias("treatmentstartdate"),
                       "patientid", "tx_age", "age").distinct()


@query("best_address")
def best_address(spark, sf_dir):
    k = _keys(spark, sf_dir)
    return k.select(_day("treatmentstartdate").alias("treatmentstartdate"), EPI.EP, EPI.MAPPED, "min_intent",
                    "cancertype", _dbl("max_dose").alias("max_dose"), "max_fractions", "age",
                    "ethnicity", "ethnicityname", "sex", "sexname", "calendar_month",
                    "addressid", "icb_hb", "imd19_quintile_lsoas")


def _ext_group(name: str, fn, cols: list[str]):
    @query(name)
    def q(spark, sf_dir):
        inp = load_inputs(spark, sf_dir)
        return fn(inp).groupBy(*cols).agg(_n())
    q.__name__ = name
    return q


_ext_group("filter_country", lambda inp: CL.england_only(CL.patch_provider(X.extract(inp))),
           ["ORGCODEPROVIDER", "COUNTRY"])


@query("filter_complete_months")
def filter_complete_months(spark, sf_dir):
    ext = _patched_england_months(load_inputs(spark, sf_dir))
    return ext.groupBy(_day("CALENDAR_MONTH").alias("calendar_month")).agg(_n())


def _to_gender(inp: Inputs) -> DataFrame:
    ext = _patched_england_months(inp)
    ext = CL.join_working_days(ext, CL.working_days_clean(inp.working_days))
    return CL.recode_demographics(ext)


_ext_group("filter_gender", lambda inp: CL.drop_other_gender(_to_gender(inp)), ["GENDER", "SEX"])
_ext_group("filter_impossible_pairs",
           lambda inp: CL.drop_impossible_pairs(CL.recode_areas(CL.drop_other_gender(_to_gender(inp)))),
           ["GENDER", "CANCERTYPE"])


# -- joins ---------------------------------------------------------------------

@query("join_prescriptions")
def join_prescriptions(spark, sf_dir):
    """Each episode row with its prescriptions (inner join on the four
    attendance keys): how many, and the largest dose and fractions.  The
    prescriptions are aggregated per key before the join, so the join never
    multiplies rows."""
    inp = load_inputs(spark, sf_dir)
    p = inp.at_prescriptions.groupBy(*EPI.ATTEND_KEYS).agg(
        F.count(F.lit(1)).alias("n_prescriptions"),
        F.max("rtprescribeddose").cast("double").alias("max_dose"),
        F.max("prescribedfractions").alias("max_fractions"))
    rows = inp.at_episodes.join(p, EPI.ATTEND_KEYS, "inner")
    return rows.select("attendid", EPI.EP, "n_prescriptions", "max_dose", "max_fractions")


@query("semi_join_exposures")
def semi_join_exposures(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    p = inp.at_prescriptions.select(*EPI.RX_KEYS)
    x = inp.at_exposures.select(*EPI.RX_KEYS)
    return p.join(x, EPI.RX_KEYS, "left_semi")


@query("join_patient")
def join_patient(spark, sf_dir):
    rows = _episode_patient(load_inputs(spark, sf_dir))
    return rows.select("attendid", "patientid", _day("birthdatebest").alias("birthdatebest"), "sex")


@query("join_address")
def join_address(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    pats = inp.at_episodes.select("patientid").distinct()
    a = inp.address.select("patientid", "addressid")
    return pats.join(a, "patientid", "left").groupBy("patientid").agg(
        F.count("addressid").alias("n_addresses"))


@query("join_geography")
def join_geography(spark, sf_dir):
    geo = AD.address_geography(load_inputs(spark, sf_dir))
    return geo.select("addressid", "patientid", _day("dateofaddress").alias("dateofaddress"),
                      "icb_hb", "imd19_quintile_lsoas")


_ext_group("join_network", lambda inp: X.extract(inp),
           ["ORGCODEPROVIDER", "COUNTRY", "PROVIDER_NAME", "RT_NETWORK_NAME",
            "CANCER_ALLIANCE_OLD", "CANCER_ALLIANCE_NEW"])


@query("join_working_days")
def join_working_days(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    full = CL.join_working_days(_patched_england_months(inp), CL.working_days_clean(inp.working_days), "full")
    return full.groupBy(_day("CALENDAR_MONTH").alias("calendar_month"), "WORKING_DAYS").agg(
        F.count("RADIOTHERAPYEPISODEID").alias("n_rows"))


# -- aggregations ----------------------------------------------------------------

@query("max_month")
def max_month(spark, sf_dir):
    return X.max_month(extract_df(spark, sf_dir))


def _agg_query(name: str, fn):
    @query(name)
    def q(spark, sf_dir):
        return fn(cleaned_df(spark, sf_dir))
    q.__name__ = name
    return q


_agg_query("agg_england_year", lambda c: AG.national_counts(c, fv.PERIOD_YEAR, fold=False))
_agg_query("agg_england_month", lambda c: AG.national_counts(c, fv.PERIOD_MONTH, fold=False))
_agg_query("agg_alliance_year", lambda c: AG.area_counts(c, fv.GEO_ALLIANCE, fv.PERIOD_YEAR))
_agg_query("agg_alliance_month", lambda c: AG.area_counts(c, fv.GEO_ALLIANCE, fv.PERIOD_MONTH))
_agg_query("agg_icb_year", lambda c: AG.area_counts(c, fv.GEO_ICB, fv.PERIOD_YEAR))
_agg_query("agg_icb_month", lambda c: AG.area_counts(c, fv.GEO_ICB, fv.PERIOD_MONTH))


@query("low_count_fold")
def low_count_fold(spark, sf_dir):
    c = cleaned_df(spark, sf_dir)
    specs = [s for s in AG.all_specs(geos=(fv.GEO_NATIONAL[0],))]
    out = AG.fold_low_counts(AG.count_episodes(c, specs))
    return out.select(*AG.KEYS, F.col("episodeCount").cast("long").alias("episodeCount"))


@query("distinct_core")
def distinct_core(spark, sf_dir):
    return X.labelled_rows(load_inputs(spark, sf_dir)).distinct()


# -- windows ---------------------------------------------------------------------

@query("first_known_demographics")
def first_known_demographics(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    s = EPI.episode_summary(EPI.episode_rows(inp))
    return s.select(EPI.EP, EPI.PROV, "chunk_id", F.col("first_ethnicity").alias("ethnicity"),
                    F.col("first_ethnicityname").alias("ethnicityname"), F.col("first_sex").alias("sex"))


@query("episode_max_dose")
def episode_max_dose(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    s = EPI.episode_summary(EPI.episode_rows(inp))
    return s.select(EPI.EP, EPI.PROV, "chunk_id", _dbl("max_dose").alias("max_dose"), "max_fractions")


@query("episode_min_intent")
def episode_min_intent(spark, sf_dir):
    rows = EPI.classified_rows(load_inputs(spark, sf_dir))
    return rows.select(EPI.EP, EPI.MAPPED, "chunk_id", "min_intent").distinct()


@query("episode_month_count")
def episode_month_count(spark, sf_dir):
    return X.month_counts_before_distinct(load_inputs(spark, sf_dir)).select(
        *X.MONTH_COUNT_KEY, "COUNT").distinct()


@query("episode_month_recount")
def episode_month_recount(spark, sf_dir):
    return extract_df(spark, sf_dir).select(*X.RECOUNT_KEY, "COUNT").distinct()


@query("chunked_equals_single")
def chunked_equals_single(spark, sf_dir):
    """The extract built chunk by chunk (one run per yearly chunk, results
    bound, then recounted) -- equal to the single-plan extract."""
    inp = load_inputs(spark, sf_dir)
    parts, chunks = None, list(DEFAULT.chunks)
    stored_rows = chunk_rows(inp, chunks)
    for c in chunks:
        p = RunParams(period_start=c.start.isoformat(), period_end=c.end.isoformat())
        rows = X.labelled_rows(inp, p, of_chunks(stored_rows, [c])).distinct()
        parts = rows if parts is None else parts.unionByName(rows)
    return X.count_per(parts, X.RECOUNT_KEY).select(*X.EXTRACT_COLUMNS)


# -- hand-over files ----------------------------------------------------------------

@query("extract_from_raw_tables")
def extract_from_raw_tables(spark, sf_dir):
    """The extract over raw tables read by the typed reader: dates with a time
    of day, blanks for nulls, and columns in another order."""
    from .session import scratch_path
    from .sources.tables import SCHEMAS, read_inputs

    inp, folder = load_inputs(spark, sf_dir), scratch_path(spark, "raw")
    for name, schema in SCHEMAS.items():
        def raw(f):
            kind = f.dataType.simpleString()
            c = F.col(f.name).cast("string") if kind == "string" else F.col(f.name)
            if kind == "date":
                return (F.to_timestamp(F.col(f.name)) + F.expr("INTERVAL 10 HOURS")).alias(f.name)
            return F.coalesce(c, F.lit("")).alias(f.name) if kind == "string" else c
        getattr(inp, name).select(*[raw(f) for f in reversed(schema.fields)]).write.parquet(f"{folder}/{name}")
    return X.extract(read_inputs(spark, folder))


@query("extract_file_roundtrip")
def extract_file_roundtrip(spark, sf_dir):
    """The extract written as the pipe-delimited hand-over file (named by its
    latest month) and read back with its explicit schema."""
    from .session import scratch_path
    from .sources.io import read_extract, write_extract
    path = write_extract(extract_df(spark, sf_dir), scratch_path(spark, "extract"))
    return read_extract(spark, path)


@query("published_file_roundtrip")
def published_file_roundtrip(spark, sf_dir):
    """The published table written as date-stamped Parquet + review CSV and
    read back from the Parquet copy."""
    from .session import scratch_path
    from .sources.io import write_published
    paths = write_published(published_table(spark, sf_dir), scratch_path(spark, "published"))
    return spark.read.parquet(paths["parquet"])


# -- QA reports --------------------------------------------------------------------

@query("qa_value_profile")
def qa_value_profile(spark, sf_dir):
    return RP.value_profile(cleaned_df(spark, sf_dir))


@query("qa_published_profile")
def qa_published_profile(spark, sf_dir):
    return RP.value_profile(published_table(spark, sf_dir), RP.PUBLISHED_PROFILE)


@query("qa_unknown_deprivation")
def qa_unknown_deprivation(spark, sf_dir):
    return RP.level_slice(published_table(spark, sf_dir), [fv.LVL_DEPRIVATION], "Unknown")


@query("qa_unmatched_months")
def qa_unmatched_months(spark, sf_dir):
    inp = load_inputs(spark, sf_dir)
    full = CL.join_working_days(_patched_england_months(inp), CL.working_days_clean(inp.working_days), "full")
    return RP.unmatched_months(full)


@query("qa_low_counts")
def qa_low_counts(spark, sf_dir):
    return RP.low_counts(published_table(spark, sf_dir))


@query("qa_level_slice")
def qa_level_slice(spark, sf_dir):
    return RP.level_slice(published_table(spark, sf_dir), [fv.LVL_DEPRIVATION, fv.LVL_INTENT])


from . import catalog_runs  # noqa: E402,F401  (registers the queries of the monthly run's machinery)
