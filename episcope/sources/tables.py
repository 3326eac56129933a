"""The extract's input tables: explicit schemas and a typed reader.

Tables are read from any path that Spark reads (Parquet, or CSV with a
header), never inferred: columns are picked by name and cast to the stated
type, empty text becomes null (as in the source database; spaces are kept) and timestamps
become dates, so period bounds keep the whole of their last day.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Inputs:
    """The extract's input tables as Spark DataFrames."""

    at_episodes: DataFrame
    at_prescriptions: DataFrame
    at_exposures: DataFrame
    at_patient: DataFrame
    address: DataFrame
    nspl: DataFrame
    hlthau: DataFrame
    lsoa_icb: DataFrame
    imd: DataFrame
    rt_networks: DataFrame
    working_days: DataFrame
    trustsics: DataFrame


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "date": T.DateType(), "decimal(8,3)": T.DecimalType(8, 3)}


def _schema(columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])


_ATTENDANCE = "attendid long, radiotherapyepisodeid string, patientid long, orgcodeprovider string"

SCHEMAS: dict[str, T.StructType] = {
    "at_episodes": _schema(f"{_ATTENDANCE}, treatmentstartdate date, radiotherapyintent string, radiotherapydiagnosisicd string"),
    "at_prescriptions": _schema(f"{_ATTENDANCE}, prescriptionid string, rtprescribeddose decimal(8,3), prescribedfractions int, "
                                "rttreatmentmodality string, rttreatmentregion string"),
    "at_exposures": _schema(f"{_ATTENDANCE}, prescriptionid string, machineid string"),
    "at_patient": _schema("patientid long, birthdatebest date, sex int, ethnicity string, ethnicityname string"),
    "address": _schema("addressid long, patientid long, dateofaddress date, postcode string"),
    "nspl": _schema("pcd string, lsoa11 string, hlthau string"),
    "hlthau": _schema("hlthaucd string, hlthaunm string"),
    "lsoa_icb": _schema("lsoa11cd string, icb22nm string"),
    "imd": _schema("lsoa11_code string, imd19_quintile_lsoas string"),
    "rt_networks": _schema("provider_code string, country string, provider_name string, rt_network_name string, "
                           "cancer_alliance_old string, cancer_alliance_new string"),
    "working_days": _schema("calendar_month date, working_days int"),
    "trustsics": _schema("code string, trustname string"),
}


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types; empty text is null.  A missing column is an error."""

    def value(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(df.schema[f.name].dataType, T.StringType):
            c = F.when(c != "", c)
        return c.cast(f.dataType).alias(f.name)

    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df.select(*[value(f) for f in schema.fields])


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """One input table from ``path``.  The working days' CSV is taken by position (its first two columns)."""
    if fmt == "csv":
        raw = spark.read.option("header", True).csv(path)
        if name == "working_days":
            names = SCHEMAS[name].fieldNames()
            raw = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(raw.columns, names)])
    else:
        raw = spark.read.format(fmt).load(path)
    return typed(raw, SCHEMAS[name])


def read_inputs(spark: SparkSession, folder: str, formats: dict[str, str] | None = None) -> Inputs:
    """All input tables from ``folder``: ``<folder>/<table>``, Parquet unless ``formats`` says otherwise."""
    base, formats = folder.rstrip("/"), formats or {}
    return Inputs(**{f.name: read_table(spark, f.name, f"{base}/{f.name}", formats.get(f.name, "parquet")) for f in fields(Inputs)})
