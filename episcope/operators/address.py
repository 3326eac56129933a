"""Home address of an episode: geography look-ups and the best-address choice.

The specification ranks, per episode key, all addresses of its patient(s):
the latest address dated on or before the treatment start first, then the
soonest after it, undated addresses ranking as 9999 days after; address id
breaks ties (nulls last).  It then keeps rank 1.

Pairing every episode day with every address of its patient would emit all
pairs within a patient (quadratic for a patient holding many rows of both).
Instead the choice is made exactly from three candidates per (patient, day):

* the best address on the latest address date <= day,
* the best address on the soonest address date > day,
* the best undated address,

compared under the specification's rank.  Rows and address days move by patient
once, as one table, and windows along each patient's days carry the addresses
to the rows.  Address days are distinct and those outside the extraction period
reduce to the latest before and the soonest after it: at most 1,981 rows a
patient by default, however many addresses there are.  No pair of rows of one
patient is ever formed.
Rows with equal rank and address id (an address matching several look-up
rows) are ordered by home area, then deprivation, nulls last, so the choice
is deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions.fixed_values import PERIOD_END, PERIOD_START
from ..sources.tables import Inputs

NO_DATE_RANK = 9999
RANK_ANCHOR = "1800-01-01"


def address_geography(inp: Inputs) -> DataFrame:
    """Each address with its home area (ICB, or
    health authority outside England) and deprivation quintile; exact postcode
    match, left joins.  The look-ups are joined to each other first, so the
    growing address table is shuffled once."""
    icb = inp.lsoa_icb.select(F.col("lsoa11cd").alias("lsoa11"), "icb22nm")
    imd = inp.imd.select(F.col("lsoa11_code").alias("lsoa11"), "imd19_quintile_lsoas")
    places = (inp.nspl.select(F.col("pcd").alias("postcode"), "lsoa11", "hlthau")
              .join(inp.hlthau.select(F.col("hlthaucd").alias("hlthau"), "hlthaunm"), "hlthau", "left")
              .join(icb, "lsoa11", "left").join(imd, "lsoa11", "left")
              .select("postcode", C.home_area(F.col("lsoa11"), F.col("hlthaunm"), F.col("icb22nm")).alias("icb_hb"),
                      "imd19_quintile_lsoas"))
    a = inp.address.select("addressid", "patientid", "dateofaddress", "postcode")
    return a.join(places, "postcode", "left").select(
        "patientid", "addressid", "dateofaddress", "icb_hb", "imd19_quintile_lsoas")


def address_rank(address_date, start_date):
    """Preference of an address for a treatment date (lower is better)."""
    return (F.when(address_date.isNull(), F.lit(NO_DATE_RANK))
            .when(address_date <= start_date,
                  F.datediff(F.lit(RANK_ANCHOR).cast("date"), address_date))
            .otherwise(F.datediff(address_date, start_date)))


def _day_number(c, zero: str):
    return F.datediff(c, F.lit(zero).cast("date"))


def _tie_break() -> Column:
    """Order of addresses on the same date (and of undated ones)."""
    return F.struct(
        F.col("addressid").isNull().alias("id_null"),
        F.col("addressid").alias("id"),
        F.col("icb_hb").isNull().alias("icb_null"),
        F.col("icb_hb").alias("icb"),
        F.col("imd19_quintile_lsoas").isNull().alias("imd_null"),
        F.col("imd19_quintile_lsoas").alias("imd"),
    )


# A row's best address: its rank, id, home area and deprivation (all null without one).
ADDRESS_COLUMNS = ["a_rank", "a_id", "a_icb", "a_imd"]


def address_days(geo: DataFrame, zero: str, span: int) -> DataFrame:
    """The best address ``b`` of each patient and day ``t``, with its day ``x``, counted from ``zero``.

    Days before 0 share ``t`` = -1, of which only the latest can be chosen, and days after ``span`` share ``span`` + 1, of
    which only the soonest can; undated addresses have a null ``t``.  So a patient has at most ``span`` + 4 rows."""
    x = F.col("x")
    known = geo.withColumn("x", _day_number(F.col("dateofaddress"), zero)).filter(F.col("patientid").isNotNull())
    t = F.when(x < 0, F.lit(-1)).when(x > span, F.lit(span + 1)).otherwise(x).alias("t")
    nearest = F.struct(F.when(x < 0, -x).otherwise(x).alias("distance"), _tie_break().alias("b"), x.alias("x"))
    return known.groupBy("patientid", t).agg(F.min(nearest).alias("a")).select("patientid", "t", "a.x", "a.b")


def with_best_address(rows: DataFrame, geo: DataFrame, first_day: str, last_day: str,
                      collapse: tuple[list[str], list[Column]] | None = None) -> DataFrame:
    """``rows`` (with ``patientid`` and ``treatmentstartdate``) with ``ADDRESS_COLUMNS``: the patient's best address on that
    date.  Treatment dates must lie in [first_day, last_day] (the extraction period).

    Rows and address days move once, by patient, as one table; windows along each patient's days carry the latest
    address before a row, the soonest after it and the undated one to it.  With ``collapse`` = (keys, aggregates) the
    rows are first grouped, in place; the keys hold the patient and the date."""
    span = (dt.date.fromisoformat(last_day) - dt.date.fromisoformat(first_day)).days
    known = address_days(geo, first_day, span).withColumn("is_row", F.lit(False))
    line = rows.withColumn("is_row", F.lit(True)).unionByName(known, allowMissingColumns=True).repartition("patientid")
    # A row's day follows from its date and doesn't move.
    line = line.withColumn("t", F.when(F.col("is_row"), _day_number(F.col("treatmentstartdate"), first_day)).otherwise(F.col("t")))
    if collapse:
        keys, aggregates = collapse
        line = line.groupBy(*keys, "t", "is_row", "x", "b").agg(*aggregates)
    names = [c for c in line.columns if c not in ("t", "is_row", "x", "b")]
    dated = F.when(~F.col("is_row") & F.col("t").isNotNull(), F.struct("x", "b"))
    undated = F.when(~F.col("is_row") & F.col("t").isNull(), F.col("b"))
    # Of one day the addresses come ahead of the rows: the latest is on the day or before it, the soonest after it.
    by_patient = Window.partitionBy("patientid")
    upward = by_patient.orderBy(F.asc_nulls_first("t"), F.asc("is_row")).rowsBetween(Window.unboundedPreceding, 0)
    downward = by_patient.orderBy(F.desc_nulls_last("t"), F.desc("is_row")).rowsBetween(Window.unboundedPreceding, 0)
    near = (line.withColumn("prev", F.last(dated, ignorenulls=True).over(upward))
            .withColumn("undated", F.last(undated, ignorenulls=True).over(upward))
            .withColumn("next", F.last(dated, ignorenulls=True).over(downward))
            .filter("is_row"))
    anchor = _day_number(F.lit(RANK_ANCHOR).cast("date"), first_day)

    def ranked(address: str, rank) -> Column:
        fields = [F.col(f"{address}.{f}").alias(f) for f in ("id_null", "id", "icb_null", "icb", "imd_null", "imd")]
        return F.when(F.col(address).isNotNull() & F.col("t").isNotNull(), F.struct(rank.cast("int").alias("r"), *fields))

    best = F.array_min(F.array(ranked("prev.b", anchor - F.col("prev.x")), ranked("next.b", F.col("next.x") - F.col("t")),
                               ranked("undated", F.lit(NO_DATE_RANK))))
    return near.withColumn("best", best).select(
        *names, *[F.col(f"best.{f}").alias(c) for f, c in zip(("r", "id", "icb", "imd"), ADDRESS_COLUMNS)])


def ranked_address() -> Column:
    """``ADDRESS_COLUMNS`` as a struct whose least is the preferred one (null without an address)."""
    rank, a_id, icb, imd = (F.col(c) for c in ADDRESS_COLUMNS)
    return F.when(rank.isNotNull(), F.struct(
        rank.alias("r"), a_id.isNull().alias("id_null"), a_id.alias("id"), icb.isNull().alias("icb_null"), icb.alias("icb"),
        imd.isNull().alias("imd_null"), imd.alias("imd")))


def best_address_per_day(days: DataFrame, geo: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """(patient, treatment date) -> the preferred address as a ranked struct
    (null when the patient has no address)."""
    d = days.select("patientid", "treatmentstartdate")
    rows = with_best_address(d, geo, first_day, last_day, (d.columns, [F.count(F.lit(1)).alias("n")]))
    return rows.select("patientid", "treatmentstartdate", ranked_address().alias("best"))


def best_of_rows(rows: DataFrame, key_cols: list[str]) -> DataFrame:
    """For each key the home area and deprivation of its best address; ``rows`` come from ``with_best_address``.  The date
    is part of every key, so the key's best is the best of its patients' on that date.  Keys whose patients have no
    address keep null geography."""
    best = rows.groupBy(*key_cols).agg(F.min(ranked_address()).alias("best"))
    return best.select(*key_cols,
                       F.col("best.icb").alias("icb_hb"),
                       F.col("best.imd").alias("imd19_quintile_lsoas"),
                       F.col("best.id").alias("addressid"))


def best_address(keys: DataFrame, key_cols: list[str], geo: DataFrame,
                 first_day: str = PERIOD_START, last_day: str = PERIOD_END) -> DataFrame:
    """The best address of each key (carrying ``patientid`` and ``treatmentstartdate``)."""
    return best_of_rows(with_best_address(keys, geo, first_day, last_day), key_cols)
