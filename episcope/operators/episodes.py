"""Episode core of the extract: joins, filters and per-episode aggregates.

Design notes (scale):

* Filters that only read the episode table (period, ICD white-list, the
  duplicate exclusion) run on that table before it meets the prescriptions,
  so they reach the Parquet scan and shrink the first join.
* Exposures only decide *whether* a prescription row qualifies (modality or
  an admitted machine), and every value later taken from the joined rows is
  insensitive to the exposure fan-out, so the exposure join is a
  ``left_semi`` join with the qualifying condition as its residual.
* Whole-partition window aggregates of the specification (max dose, first
  known demographics, min intent) are windows over rows that were moved once,
  by episode: every later step of the extract has the episode in its keys and
  finds its rows in place.  The rows are first collapsed to one per skeleton
  key, so an episode holds few; its window spills where it does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import fixed_values as fv
from ..plans.calendar import chunk_id, in_period
from ..plans.params import DEFAULT, RunParams
from ..session import materialize
from ..sources.tables import Inputs
from .address import address_geography, with_best_address

EP = "radiotherapyepisodeid"
PROV = "orgcodeprovider"          # provider code as submitted
MAPPED = "mapped_provider"        # provider code after the merge map
ATTEND_KEYS = ["attendid", PROV, EP, "patientid"]
RX_KEYS = ATTEND_KEYS + ["prescriptionid"]


def _chunk_cols(params: RunParams) -> list[str]:
    return ["chunk_id"] if params.chunked else []


# -- duplicates -------------------------------------------------------------

def duplicate_episode_ids(episodes: DataFrame) -> DataFrame:
    """Episode ids used by more than one patient at exactly one provider.

    ``count(distinct x) > 1`` is ``min(x) <> max(x)`` and ``= 1`` is
    ``min(x) = max(x)`` (nulls ignored either way); min/max aggregate
    map-side, so a hot id never gathers its rows in one task.
    """
    return (episodes.groupBy(EP)
            .agg(F.min("patientid").alias("p_lo"), F.max("patientid").alias("p_hi"),
                 F.min(PROV).alias("o_lo"), F.max(PROV).alias("o_hi"))
            .filter((F.col("p_lo") != F.col("p_hi")) & (F.col("o_lo") == F.col("o_hi")))
            .select(EP))


def duplicate_episode_rows(episodes: DataFrame, dup_ids: DataFrame | None = None) -> DataFrame:
    """Distinct (episode, start date, patient, provider) rows of the
    duplicate ids -- the de-duplication table of the monthly run."""
    # Distinct and stored: the ids are found in these rows, and the rows of the ids are taken from them.
    days = materialize(episodes.select(EP, "treatmentstartdate", "patientid", PROV).distinct(), "episode_days")
    return days.join(duplicate_episode_ids(days) if dup_ids is None else dup_ids, EP, "left_semi")


def drop_duplicate_episodes(episodes: DataFrame, dup_ids: DataFrame) -> DataFrame:
    """Anti join with the duplicates table on (episode, start date, provider,
    patient).  Every row of a duplicate id is itself in that table, so a row
    goes exactly when its id is a duplicate id and none of the other three
    keys is null (null keys never match).  Joining on the id set is the same
    and keeps the right side as small as the number of duplicate ids.
    """
    d = dup_ids.withColumnRenamed(EP, "dup_ep")
    cond = ((F.col(EP) == F.col("dup_ep")) & F.col("treatmentstartdate").isNotNull()
            & F.col(PROV).isNotNull() & F.col("patientid").isNotNull())
    return episodes.join(d, cond, "left_anti")


# -- core rows (joins + filters) --------------------------------------------

def stored_duplicate_ids(inp: Inputs) -> DataFrame:
    """The duplicate ids, stored: a small table of known size, against which the episodes need not move by episode."""
    return materialize(duplicate_episode_ids(inp.at_episodes.select(EP, "patientid", PROV)), "duplicate_ids")


def qualifying_episodes(inp: Inputs, params: RunParams = DEFAULT, dup_ids: DataFrame | None = None) -> DataFrame:
    """Episode rows in the period, on a white-listed ICD code, not duplicates (``dup_ids``, where they are stored already)."""
    chunks = list(params.chunks)
    dup_ids = stored_duplicate_ids(inp) if dup_ids is None else dup_ids
    e = (inp.at_episodes
         .filter(in_period(F.col("treatmentstartdate"), chunks))
         .filter(C.icd_whitelisted(F.col("radiotherapydiagnosisicd"))))
    return drop_duplicate_episodes(e, dup_ids)


def admitted(rows: DataFrame, exposures: DataFrame) -> DataFrame:
    """Keep prescription rows with an exposure, where the prescription is of
    the admitted modality or the exposure is on an admitted machine."""
    x = exposures.select(*[F.col(k).alias("x_" + k) for k in RX_KEYS],
                         F.col("machineid").isin(*fv.ADMITTED_MACHINES).alias("on_admitted"))
    qualifies = (F.col("rttreatmentmodality") == F.lit(fv.RT_MODALITY)) | F.col("on_admitted")
    return rows.join(x, attendance_equal("x_", RX_KEYS) & qualifies, "left_semi")


def attendance_equal(prefix: str, keys: list[str] = ATTEND_KEYS) -> Column:
    """Equality of ``keys`` with the other side's prefixed ones, the attendance id alone as the key of the join.

    Spark moves a side again for every other list of keys.  Under the one narrow
    key, episodes, prescriptions and exposures each move once, and the groups
    by longer keys between the joins move nothing; the other keys are compared
    among the rows of one attendance id (nulls match nothing)."""
    cond = F.col("attendid") == F.col(prefix + "attendid")
    for k in keys:
        if k != "attendid":
            cond = cond & (F.col(k) <= F.col(prefix + k)) & (F.col(k) >= F.col(prefix + k))
    return cond


def admitted_prescriptions(inp: Inputs, episodes: DataFrame | None = None) -> DataFrame:
    """Prescriptions (of the given episode rows, if any) that qualify (modality or an
    admitted machine), both as semi joins: no row is multiplied."""
    p = inp.at_prescriptions.select(*RX_KEYS, "rtprescribeddose", "prescribedfractions",
                                    "rttreatmentmodality", "rttreatmentregion")
    if episodes is not None:
        p = p.join(episodes.select(*[F.col(k).alias("e_" + k) for k in ATTEND_KEYS]), attendance_equal("e_"), "left_semi")
    return admitted(p, inp.at_exposures)


def with_prescriptions(episodes: DataFrame, prescriptions: DataFrame) -> DataFrame:
    """Episode rows with the (collapsed) prescriptions of their attendance."""
    p = prescriptions.select(*[F.col(c).alias("p_" + c) if c in ATTEND_KEYS else F.col(c) for c in prescriptions.columns])
    return episodes.join(p, attendance_equal("p_"), "inner").drop(*["p_" + k for k in ATTEND_KEYS])


def core_rows(inp: Inputs, params: RunParams = DEFAULT, dup_ids: DataFrame | None = None) -> DataFrame:
    """Qualifying episode rows joined with their qualifying prescriptions,
    with the row-level derived columns.

    Later steps use a prescription only through its treatment region (for
    the tumour group) and the maxima of dose and fractions, so prescriptions
    are first collapsed map-side to one row per (attendance, region): the
    join then multiplies an episode row by its number of regions at most,
    never by its number of prescriptions."""
    e = qualifying_episodes(inp, params, dup_ids)
    p = (admitted_prescriptions(inp)
         .groupBy(*ATTEND_KEYS, "rttreatmentregion")
         .agg(F.max("rtprescribeddose").alias("dose"), F.max("prescribedfractions").alias("fractions")))
    rows = with_prescriptions(e, p)
    return with_labels(rows.select(
        EP, PROV, "patientid", "attendid", "treatmentstartdate",
        C.tumour_group(F.col("radiotherapydiagnosisicd"), F.col("rttreatmentregion")).alias("cancertype"),
        C.intent_rank(F.col("radiotherapyintent")).alias("ordered_intent"),
        "dose", "fractions",
    ), params)


def with_labels(rows: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Adds the merged provider, the month and the chunk, which follow from the submitted provider and the date."""
    date = F.col("treatmentstartdate")
    return rows.withColumns({MAPPED: C.provider_remap(F.col(PROV)), "calendar_month": C.month_label(date),
                             "chunk_id": chunk_id(date, list(params.chunks))})


def chunk_counts(inp: Inputs, params: RunParams = DEFAULT) -> DataFrame:
    """Per chunk: qualifying (episode row, prescription) rows and distinct
    episodes.  The row count is a sum of per-attendance products of counts,
    so no pair is formed."""
    e = qualifying_episodes(inp, params).withColumn(
        "chunk_id", chunk_id(F.col("treatmentstartdate"), list(params.chunks)))
    per_key = admitted_prescriptions(inp).groupBy(*ATTEND_KEYS).agg(F.count(F.lit(1)).alias("n_rx"))
    return (with_prescriptions(e, per_key).groupBy("chunk_id")
            .agg(F.sum("n_rx").alias("n_rows"), F.countDistinct(EP).alias("n_episodes")))


def with_patient(rows: DataFrame, patients: DataFrame) -> DataFrame:
    pa = patients.select("patientid", "birthdatebest", "sex", "ethnicity", "ethnicityname")
    return rows.join(pa, "patientid", "left")


# Row-level columns every later step needs.  Rows that agree on them differ
# only in dose and fractions, whose per-episode maxima are all that is used.
SKELETON = [EP, PROV, "chunk_id", MAPPED, "treatmentstartdate", "calendar_month",
            "cancertype", "ordered_intent", "patientid"]
# Those of them that follow from others and need not move.
LABELS = ["chunk_id", MAPPED, "calendar_month"]


def widest() -> list[Column]:
    """The maxima of dose and fractions of rows that agree on the skeleton."""
    return [F.max("dose").alias("dose"), F.max("fractions").alias("fractions")]


def episode_rows(inp: Inputs, params: RunParams = DEFAULT) -> DataFrame:
    """Core rows collapsed to one row per skeleton key (maxima of dose and
    fractions kept) with the patient attached."""
    # Moved once, by patient: for the collapse and for the patients' join.
    sk = core_rows(inp, params).repartition("patientid").groupBy(*SKELETON).agg(*widest())
    return with_patient(sk, inp.at_patient)


def addressed_rows(inp: Inputs, params: RunParams = DEFAULT, dup_ids: DataFrame | None = None) -> DataFrame:
    """``episode_rows`` with each row's best address (``address.ADDRESS_COLUMNS``): core rows and addresses move by patient as one table,
    for the collapse, the address choice and the patients' join."""
    keys = [c for c in SKELETON if c not in LABELS]
    rows = with_best_address(core_rows(inp, params, dup_ids).drop(*LABELS, "attendid"), address_geography(inp),
                             params.period_start, params.period_end, (keys, widest()))
    return with_patient(with_labels(rows, params), inp.at_patient)


# -- per-episode aggregates (windows of the specification) -------------------

def _first_known(value: str, order: list[str], over: WindowSpec | None = None) -> Column:
    """First non-null ``value`` in ``order`` (ties broken by the later order
    columns): min over structs, which aggregates map-side."""
    s = F.struct(*[F.col(o) for o in order], F.col(value).alias("v"))
    least = F.min(F.when(F.col(value).isNotNull(), s))
    return (least if over is None else least.over(over)).getField("v")


def summary_columns(over: WindowSpec | None = None) -> dict[str, Column]:
    """The summary values of an episode, as aggregates or over a window."""
    order = ["treatmentstartdate", "patientid"]
    most = {"max_dose": F.max("dose"), "max_fractions": F.max("fractions")}
    first = {f"first_{v}": _first_known(v, order, over) for v in ("ethnicity", "ethnicityname", "sex")}
    return {n: c if over is None else c.over(over) for n, c in most.items()} | first


def episode_summary(rows: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Per (episode, submitted provider[, chunk]): maximum dose and fractions
    (independent maxima) and the first known ethnicity, ethnicity name and
    sex by treatment date (patient id breaks ties)."""
    keys = [EP, PROV] + _chunk_cols(params)
    return rows.groupBy(*keys).agg(*[c.alias(n) for n, c in summary_columns().items()])


def with_age(rows: DataFrame) -> DataFrame:
    """Whole years at treatment (null when the birth date is unknown)."""
    return rows.withColumn("tx_age", C.age_at(F.col("treatmentstartdate"), F.col("birthdatebest")))


def is_adult() -> Column:
    """Adults only; an unknown age fails the test."""
    return F.col("tx_age") >= fv.ADULT_AGE


def with_episode_values(rows: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Rows with the summary values of their (episode, submitted provider[, chunk]), plus the
    lowest intent rank over the *adult* rows of the episode at its *merged* provider.

    The rows move once, by episode, and the values are taken over windows inside an episode, in place.
    Rows without an episode, provider or chunk belong to none and go."""
    keys = [PROV] + _chunk_cols(params)
    for k in (EP, *keys):
        rows = rows.filter(F.col(k).isNotNull())
    rows = rows.drop(MAPPED, "calendar_month").repartition(EP)
    rows = rows.withColumns({MAPPED: C.provider_remap(F.col(PROV)), "calendar_month": C.month_label(F.col("treatmentstartdate"))})
    submitted = Window.partitionBy(EP, *keys)
    merged = Window.partitionBy(EP, MAPPED, *_chunk_cols(params))
    intent = F.min(F.when(is_adult(), F.col("ordered_intent"))).over(merged)
    return rows.withColumns(summary_columns(submitted)).withColumn("min_intent", intent)


# The columns that identify a candidate row of the best-address choice.
EPISODE_KEY = [
    "treatmentstartdate", EP, MAPPED, "min_intent", "cancertype", "max_dose",
    "max_fractions", "age", "ethnicity", "ethnicityname", "sex", "sexname",
]


def classified_rows(inp: Inputs, params: RunParams = DEFAULT, stored_rows: DataFrame | None = None) -> DataFrame:
    """Adult episode rows with every per-episode value attached (before the
    address choice); ``stored_rows`` are the run's ``episode_rows``, where they are stored already."""
    # Written once to the checkpoint folder: a lost executor recomputes from
    # here rather than from the raw facts.
    if stored_rows is None:
        stored_rows = materialize(episode_rows(inp, params), "episode_rows")
    rows = with_episode_values(with_age(stored_rows), params).filter(is_adult())
    rows = rows.drop("ethnicity", "ethnicityname", "sex", "dose", "fractions")
    # The per-episode first known values replace the patient's own.
    return (rows.withColumnRenamed("first_ethnicity", "ethnicity")
            .withColumnRenamed("first_ethnicityname", "ethnicityname")
            .withColumnRenamed("first_sex", "sex")
            .withColumn("sexname", C.sex_name(F.col("sex")))
            .withColumn("age", C.age_band(F.col("tx_age"))))


def episode_keys(inp: Inputs, params: RunParams = DEFAULT, stored_rows: DataFrame | None = None) -> DataFrame:
    """Distinct candidate keys with the patient whose addresses compete."""
    rows = classified_rows(inp, params, stored_rows)
    return rows.select(*EPISODE_KEY, "calendar_month", "patientid").distinct()
