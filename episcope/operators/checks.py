"""Checks inside a run: metrics observed while a step is stored, and limits that stop it.

The specification leaves these to the analyst's eyes (each year populated, no
null episode id, look-ups with one row a key).  Here a step's metrics are
computed in the same pass that writes it (``DataFrame.observe``), compared with
their limits before the next step starts, and kept as a report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..plans.calendar import Chunk, chunk_id
from ..session import materialize
from ..sources.tables import Inputs

#: The look-ups and the columns that name one row of each.
LOOKUP_KEYS = {
    "at_patient": "patientid", "nspl": "pcd", "hlthau": "hlthaucd", "lsoa_icb": "lsoa11cd", "imd": "lsoa11_code",
    "rt_networks": "provider_code", "working_days": "calendar_month", "trustsics": "code",
}


class CheckFailed(RuntimeError):
    """A metric of a step is outside its limits; nothing after the step was run."""


@dataclass(frozen=True)
class Check:
    """A metric (an aggregate that gives a number) and its limits."""

    name: str
    metric: Column
    at_least: int | None = None
    at_most: int | None = None

    def passes(self, value: int) -> bool:
        return (self.at_least is None or value >= self.at_least) and (self.at_most is None or value <= self.at_most)


def no_nulls(column: str) -> Check:
    return Check(f"null {column}", F.count_if(F.col(column).isNull()), at_most=0)


def every_chunk(month: Column, chunks: list[Chunk]) -> list[Check]:
    """A row at least in each chunk of the period."""
    return [Check(f"rows of chunk {c.chunk_id}", F.count_if(F.coalesce(chunk_id(month, chunks) == c.chunk_id, F.lit(False))), at_least=1) for c in chunks]


def repeated_keys(lookup: DataFrame, key: str) -> DataFrame:
    """One number: rows of the look-up beyond the first of each key (null keys match nothing and don't count)."""
    return (lookup.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("value")))


class RunChecks:
    """The checks of one run, in order."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.results: list[tuple] = []

    def _judge(self, step: str, values: list[tuple[Check, int]]) -> None:
        self.results += [(step, c.name, int(v), c.at_least, c.at_most, c.passes(int(v))) for c, v in values]
        failed = [f"{c.name} is {v}" for c, v in values if not c.passes(int(v))]
        if failed:
            raise CheckFailed(f"{step}: {'; '.join(failed)}")

    def stored(self, df: DataFrame, step: str, checks: list[Check]) -> DataFrame:
        """Stores a step, with its metrics observed on the way; raises if one is outside its limits."""
        seen = Observation()
        out = materialize(df.observe(seen, *[c.metric.alias(f"m{k}") for k, c in enumerate(checks)]), step)
        self._judge(step, [(c, seen.get[f"m{k}"]) for k, c in enumerate(checks)])
        return out

    def lookups(self, inp: Inputs, keys: dict[str, str] = LOOKUP_KEYS) -> None:
        """Each look-up has one row a key at most."""
        for table, key in keys.items():
            value = repeated_keys(getattr(inp, table), key).first().value
            self._judge(table, [(Check(f"repeated {key}", F.lit(value), at_most=0), value)])

    def report(self) -> DataFrame:
        return self.spark.createDataFrame(self.results, "step string, check string, value long, at_least long, at_most long, passed boolean")
