"""The 21-column extract: one classified row per episode x month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..plans.params import DEFAULT, RunParams
from ..session import materialize
from ..sources.tables import Inputs
from .address import best_of_rows
from .episodes import EP, EPISODE_KEY, MAPPED, addressed_rows, classified_rows

EXTRACT_COLUMNS = [
    "ORGCODEPROVIDER", "COUNTRY", "PROVIDER_NAME", "RT_NETWORK_NAME",
    "CANCER_ALLIANCE_OLD", "CANCER_ALLIANCE_NEW", "CALENDAR_MONTH", "CANCERTYPE",
    "INTENT", "FRACTIONATION_CATEGORY", "AGE", "ETHNICITY", "ETHNICITYNAME", "SEX",
    "SEXNAME", "IMD19_QUINTILE_LSOAS", "ICB_HB", "RADIOTHERAPYEPISODEID",
    "DOSE_FRACTIONATION_SCHEDULES", "SCHEDULE_GROUP", "COUNT",
]

# Per-episode-month recount key (provider *name*: null names form one group).
RECOUNT_KEY = ["RADIOTHERAPYEPISODEID", "PROVIDER_NAME", "CANCERTYPE", "CALENDAR_MONTH"]
# Row-count key evaluated before the final DISTINCT (provider *code*).
MONTH_COUNT_KEY = ["RADIOTHERAPYEPISODEID", "CANCERTYPE", "ORGCODEPROVIDER", "CALENDAR_MONTH"]


def addressed_keys(inp: Inputs, params: RunParams = DEFAULT, stored_rows: DataFrame | None = None) -> DataFrame:
    """One row per episode key with its best address (rank-1 rows); ``stored_rows`` are the run's ``addressed_rows``."""
    if stored_rows is None:
        stored_rows = materialize(addressed_rows(inp, params), "addressed_rows")
    return best_of_rows(classified_rows(inp, params, stored_rows), EPISODE_KEY + ["calendar_month"])


def labelled_rows(inp: Inputs, params: RunParams = DEFAULT, stored_rows: DataFrame | None = None) -> DataFrame:
    """Rank-1 rows with the network look-up and every label, before the
    final DISTINCT (20 columns, upper-case names of the hand-over file)."""
    rows = addressed_keys(inp, params, stored_rows)
    net = inp.rt_networks.select(
        F.col("provider_code").alias(MAPPED), "country", "provider_name",
        "rt_network_name", "cancer_alliance_old", "cancer_alliance_new")
    rows = rows.join(net, MAPPED, "left")
    rank, tumour, dose, fx = "min_intent", "cancertype", "max_dose", "max_fractions"
    return rows.select(
        F.col(MAPPED).alias("ORGCODEPROVIDER"),
        F.col("country").alias("COUNTRY"),
        F.col("provider_name").alias("PROVIDER_NAME"),
        F.col("rt_network_name").alias("RT_NETWORK_NAME"),
        F.col("cancer_alliance_old").alias("CANCER_ALLIANCE_OLD"),
        F.col("cancer_alliance_new").alias("CANCER_ALLIANCE_NEW"),
        F.col("calendar_month").alias("CALENDAR_MONTH"),
        F.col(tumour).alias("CANCERTYPE"),
        C.intent_label(F.col(rank)).alias("INTENT"),
        C.fractionation_category(rank, dose, fx).alias("FRACTIONATION_CATEGORY"),
        F.col("age").alias("AGE"),
        F.col("ethnicity").alias("ETHNICITY"),
        F.col("ethnicityname").alias("ETHNICITYNAME"),
        F.col("sex").alias("SEX"),
        F.col("sexname").alias("SEXNAME"),
        F.col("imd19_quintile_lsoas").alias("IMD19_QUINTILE_LSOAS"),
        F.col("icb_hb").alias("ICB_HB"),
        F.col(EP).alias("RADIOTHERAPYEPISODEID"),
        C.schedule_label(tumour, rank, dose, fx).alias("DOSE_FRACTIONATION_SCHEDULES"),
        C.schedule_group(tumour, rank, dose, fx).alias("SCHEDULE_GROUP"),
    )


def count_per(rows: DataFrame, key: list[str], name: str = "COUNT") -> DataFrame:
    """Attach the number of rows per ``key`` (nulls form one group).

    A window: both keys hold the episode, by which the extract's rows are
    dealt, so they are counted where they are.
    """
    return rows.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*key)))


def extract(inp: Inputs, params: RunParams = DEFAULT) -> DataFrame:
    """The hand-over extract: distinct labelled rows plus the per
    episode-month count by provider name (21 columns)."""
    return recounted(labelled_rows(inp, params).distinct())


def recounted(rows: DataFrame) -> DataFrame:
    return count_per(rows, RECOUNT_KEY).select(*EXTRACT_COLUMNS)


def month_counts_before_distinct(inp: Inputs, params: RunParams = DEFAULT) -> DataFrame:
    """The row count per (episode, tumour, provider code, month) that the
    extract query computes before its DISTINCT (later replaced by the
    recount)."""
    return count_per(labelled_rows(inp, params), MONTH_COUNT_KEY).distinct()


def max_month(extract_df: DataFrame) -> DataFrame:
    """Latest extract month and the ``MMYYYY`` tag of the hand-over file."""
    m = F.max("CALENDAR_MONTH")
    return extract_df.agg(m.alias("max_month")).select(
        "max_month",
        F.concat(F.substring("max_month", 6, 2), F.substring("max_month", 1, 4)).alias("file_tag"))
