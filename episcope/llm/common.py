"""Helpers shared by the operators: tables, partition counts, prefix sums."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


_ROOT = str(Path(__file__).resolve().parents[2])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``.  Python workers that share the driver's folders import this package from there
    (elsewhere install it, or pass it with --py-files)."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in path.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{_ROOT}:{path}".rstrip(":")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def quoted(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever their names hold (dots, spaces)."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns whose names (in any case) are in ``names``."""
    gone = {n.lower() for n in names}
    return df.select(*[column for c, column in zip(df.columns, quoted(df)) if c.lower() not in gone])


def text_slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``most`` bytes of text, so that a batch of long texts never stands whole as Python strings."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())).to_numpy(zero_copy_only=False) // most
    start = 0
    for k in range(len(column)):
        if k + 1 == len(column) or ends[k + 1] != ends[start]:
            yield start, k + 1
            start = k + 1


def give_back() -> None:
    """Returns Arrow's unused memory to the system: Python workers outlive their tasks and the executor's limit counts them."""
    pa.default_memory_pool().release_unused()


def prefix_offsets(totals: DataFrame, part: str, value: str, out: str,
                   keys: tuple[str, ...] = (), block: int = 1024) -> DataFrame:
    """``totals`` with ``out``: the sum of ``value`` over smaller ``part``.

    ``totals`` has one row per ``part`` (and ``keys``).  Two levels: first the
    sums of blocks of ``block`` parts, then the parts inside each block, so
    that no window holds more than ``block`` rows, or one row per block.
    """
    k = [F.col(c) for c in keys]
    t = totals.withColumn("__blk", F.floor(F.col(part) / block))
    blocks = t.groupBy(*keys, "__blk").agg(F.sum(value).alias("__sum"))
    over = Window.partitionBy(*k) if keys else Window.partitionBy(F.lit(0))
    before = over.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*k, "__blk", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inner = Window.partitionBy(*k, "__blk").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("__in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return (t.join(blocks, [*keys, "__blk"])
            .withColumn(out, (F.col("__base") + F.col("__in")).cast("long"))
            .drop("__blk", "__base", "__in"))
