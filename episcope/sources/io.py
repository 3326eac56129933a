"""Hand-over files: the extract (pipe-delimited text or Parquet), the
working-day table and the published table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .tables import read_table

# The 21-column extract, typed (never inferred).
EXTRACT_SCHEMA = T.StructType([
    T.StructField("ORGCODEPROVIDER", T.StringType()),
    T.StructField("COUNTRY", T.StringType()),
    T.StructField("PROVIDER_NAME", T.StringType()),
    T.StructField("RT_NETWORK_NAME", T.StringType()),
    T.StructField("CANCER_ALLIANCE_OLD", T.StringType()),
    T.StructField("CANCER_ALLIANCE_NEW", T.StringType()),
    T.StructField("CALENDAR_MONTH", T.StringType()),
    T.StructField("CANCERTYPE", T.StringType()),
    T.StructField("INTENT", T.StringType()),
    T.StructField("FRACTIONATION_CATEGORY", T.StringType()),
    T.StructField("AGE", T.StringType()),
    T.StructField("ETHNICITY", T.StringType()),
    T.StructField("ETHNICITYNAME", T.StringType()),
    T.StructField("SEX", T.IntegerType()),
    T.StructField("SEXNAME", T.StringType()),
    T.StructField("IMD19_QUINTILE_LSOAS", T.StringType()),
    T.StructField("ICB_HB", T.StringType()),
    T.StructField("RADIOTHERAPYEPISODEID", T.StringType()),
    T.StructField("DOSE_FRACTIONATION_SCHEDULES", T.StringType()),
    T.StructField("SCHEDULE_GROUP", T.StringType()),
    T.StructField("COUNT", T.LongType()),
])

def extract_file_tag(rows: DataFrame) -> str:
    """``MMYYYY`` of the latest extract month (one aggregated value)."""
    m = rows.agg(F.max("CALENDAR_MONTH")).first()[0]
    return f"{m[5:7]}{m[0:4]}" if m else "000000"


def write_extract(extract: DataFrame, folder: str, fmt: str = "csv", tag: str | None = None) -> str:
    """Write the extract as ``<folder>/extract_<MMYYYY>``: pipe-delimited text
    with a header (the hand-over format), or Parquet.  Written by many tasks
    in parallel (a folder of part files), never through the driver.  ``tag``
    names the month where the caller knows it."""
    if tag is None:
        # Read for its latest month and again for the file.
        extract = materialize(extract, "extract")
    path = f"{folder.rstrip('/')}/extract_{tag or extract_file_tag(extract)}"
    w = extract.write.mode("overwrite")
    if fmt == "csv":
        w.option("sep", "|").option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def read_extract(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read an extract hand-over with its explicit schema.  Blank text
    fields read as null, so the cleaning's null-or-blank tests cover both."""
    if fmt == "csv":
        return (spark.read.schema(EXTRACT_SCHEMA).option("sep", "|").option("header", True)
                .csv(path))
    return spark.read.parquet(path)


def read_working_days_csv(spark: SparkSession, path: str) -> DataFrame:
    """Working days per month from CSV: the first two columns only."""
    return read_table(spark, "working_days", path, "csv")


def write_published(published: DataFrame, folder: str, run_date: dt.date | None = None) -> dict:
    """Date-stamped Parquet table plus one CSV for small-number review.

    The CSV is written from the stored table, as part files in range order."""
    stamp = (run_date or dt.date.today()).isoformat()
    base = f"{folder.rstrip('/')}/aggregation{stamp}"
    published.write.mode("overwrite").parquet(f"{base}.parquet")
    stored = published.sparkSession.read.schema(published.schema).parquet(f"{base}.parquet")
    return {"parquet": f"{base}.parquet", "csv": write_review(stored, f"{base}.csv")}


REVIEW_ORDER = ["geo_lvl", "period", "prim_lvl", "activity_year", "activity_month"]


def write_review(stored: DataFrame, path: str) -> str:
    """The small-number review file: CSV part files in range order, sorted inside."""
    (stored.repartitionByRange(*REVIEW_ORDER).sortWithinPartitions(*REVIEW_ORDER)
     .write.mode("overwrite").option("header", True).csv(path))
    return path
