"""Reject capture: delimited files are read permissively, and what doesn't parse is kept and counted.

A line is rejected as a whole when it has another number of fields than the
schema or a field that is not of its type; the others are typed as before.
Accepted rows and rejects are stored together in one pass, so both come from
the same reading of the file.  A limit on the number of rejects stops the run
before anything is computed from the file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .io import EXTRACT_SCHEMA
from .tables import SCHEMAS

_LINE = "_rejected_line"
FIELD_COUNT, FIELD_TYPE = "number of fields", "type of a field"


class TooManyRejects(RuntimeError):
    """A file has more rejected lines than the limit."""


@dataclass
class Reading:
    accepted: DataFrame
    rejects: DataFrame  # line, n_fields, reason
    n_rejects: int

    def within(self, limit: int | None) -> Reading:
        if limit is not None and self.n_rejects > limit:
            some = "; ".join(f"{r.reason}: {r.line[:80]}" for r in self.rejects.limit(3).collect())
            raise TooManyRejects(f"{self.n_rejects} lines are rejected, {limit} may be ({some})")
        return self


def _reading(stored: DataFrame, columns: list[str], sep: str, n_columns: int) -> Reading:
    bad = F.col(_LINE).isNotNull()
    # Separators inside quotes don't part fields.
    fields = F.size(F.split(F.regexp_replace(_LINE, '"[^"]*"', ""), f"[{sep}]", -1))
    rejects = stored.where(bad).select(F.col(_LINE).alias("line"), fields.alias("n_fields"),
                                       F.when(fields != n_columns, FIELD_COUNT).otherwise(FIELD_TYPE).alias("reason"))
    return Reading(stored.where(~bad).select(*columns), rejects, rejects.count())


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",", limit: int | None = None) -> Reading:
    """A delimited file with a header line, by its schema."""
    columns = schema.fieldNames()
    parsed = (spark.read.schema(T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())]))
              .option("sep", sep).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).csv(path))
    return _reading(materialize(parsed, "delimited"), columns, sep, len(columns)).within(limit)


def read_extract_checked(spark: SparkSession, path: str | list[str], limit: int | None = None) -> Reading:
    """The extract's hand-over file."""
    return read_delimited(spark, path, EXTRACT_SCHEMA, "|", limit)


def read_working_days_checked(spark: SparkSession, path: str, limit: int | None = None) -> Reading:
    """The working days' CSV, taken by position: its first two columns.  A line is rejected if either is no date or number
    (blank lines aside)."""
    raw = spark.read.text(path)
    names = SCHEMAS["working_days"].fieldNames()
    parts = F.split("value", ",", -1)
    cell = lambda k: F.trim(F.regexp_replace(F.get(parts, F.lit(k)), '^"|"$', ""))
    header = F.lower(cell(0)).rlike("[a-z]{3,}") & cell(1).rlike("[A-Za-z]")
    read = raw.where((F.trim("value") != "") & ~F.coalesce(header, F.lit(False))).select(
        "value", F.to_date(F.try_to_timestamp(cell(0))).alias(names[0]), cell(1).try_cast("int").alias(names[1]), F.size(parts).alias("n"))
    good = F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull()
    stored = materialize(read.select(*names, F.when(~good, F.col("value")).alias(_LINE)), "working_days")
    return _reading(stored, names, ",", 2).within(limit)
