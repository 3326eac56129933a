"""A stored layout in which the attendance joins move nothing and the period prunes folders.

* Episodes are partitioned by treatment month, prescriptions and exposures are
  not (they carry no date); all three are bucketed and sorted by the attendance
  keys, into the same number of buckets.
* The period filter of a run adds the months it spans, so that only their
  folders are listed and read.
* Joins on the attendance keys read both sides bucket by bucket: no exchange, no
  sort.  The exposures' fifth key (the prescription) is compared inside a bucket
  as a residual condition, for Spark co-partitions only by all keys of a join.

Buckets should be at least ``spark.sql.shuffle.partitions``; below it Spark prefers to shuffle.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..operators.episodes import ATTEND_KEYS
from ..plans.calendar import in_period
from ..plans.params import DEFAULT, RunParams
from .tables import SCHEMAS, Inputs

MONTH = "treatment_month"
BUCKETED = ("at_episodes", "at_prescriptions", "at_exposures")


class StoredLayout:
    """The three attendance tables under ``folder``, registered in the session's catalog under ``prefix``."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, prefix: str | None = None):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self.prefix = prefix or f"attendance_{uuid.uuid4().hex[:12]}"

    def name(self, table: str) -> str:
        return f"{self.prefix}_{table}"

    def write(self, inp: Inputs) -> None:
        for table in BUCKETED:
            df: DataFrame = getattr(inp, table)
            if table == "at_episodes":
                df = df.withColumn(MONTH, F.date_format("treatmentstartdate", "yyyy-MM"))
            # One task a bucket writes its file of each month, so there is one file a bucket and month.
            writer = (df.repartition(self.buckets, *ATTEND_KEYS).write.format("parquet").option("path", f"{self.folder}/{table}")
                      .bucketBy(self.buckets, *ATTEND_KEYS).sortBy(*ATTEND_KEYS))
            (writer.partitionBy(MONTH) if table == "at_episodes" else writer).saveAsTable(self.name(table))

    def inputs(self, inp: Inputs, params: RunParams = DEFAULT) -> Inputs:
        """``inp`` with the stored tables in place of its own; episodes of the period's months only."""
        stored = {t: self.spark.table(self.name(t)) for t in BUCKETED}
        first, last = (d.strftime("%Y-%m") for d in (params.chunks[0].start, params.chunks[-1].end))
        stored["at_episodes"] = stored["at_episodes"].where(F.col(MONTH).between(first, last))
        return replace(inp, **{t: df.select(*SCHEMAS[t].fieldNames()) for t, df in stored.items()})

    def drop(self) -> None:
        """Forgets the tables (their files stay under the folder)."""
        for table in BUCKETED:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")


def _same(left: Column, right: Column) -> Column:
    """Equality that isn't taken as a key of the join."""
    return (left <= right) & (left >= right)


def delivered_prescriptions(inp: Inputs, params: RunParams = DEFAULT) -> DataFrame:
    """Episode rows of the period with their prescriptions that were delivered (admitted modality or machine): the joins
    J1 and J2, on the attendance keys alone."""
    e = inp.at_episodes.filter(in_period(F.col("treatmentstartdate"), list(params.chunks)))
    p = inp.at_prescriptions
    x = inp.at_exposures.select(*[F.col(k).alias(f"x_{k}") for k in ATTEND_KEYS], F.col("prescriptionid").alias("x_rx"), "machineid")
    on = _same(F.col("prescriptionid"), F.col("x_rx"))
    for k in ATTEND_KEYS:
        on = (F.col(k) == F.col(f"x_{k}")) & on
    qualifies = (F.col("rttreatmentmodality") == fv.RT_MODALITY) | F.col("machineid").isin(*fv.ADMITTED_MACHINES)
    return e.join(p.join(x, on & qualifies, "left_semi"), ATTEND_KEYS)
