"""Publication of the monthly table with a commit record.

The Parquet table and the review file are written aside, the table is checked
against what was computed (rows and checksum), and one manifest names both.
Readers follow the manifest: they never see a month half written, and a failed
run leaves the month before in place.  Months are kept; the latest is the one
committed last.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .io import write_review
from .manifest import CommitError, Manifest, store


def publish_month(published: DataFrame, folder: str, run_date: dt.date | None = None) -> dict:
    """Stores and commits one month; returns its entry {path, rows, checksum, review}."""
    spark = published.sparkSession
    manifest = Manifest(spark, folder)
    stamp = (run_date or dt.date.today()).isoformat()
    entry = store(published, manifest.new_path(f"aggregation{stamp}"))
    stored = spark.read.schema(published.schema).parquet(entry["path"])
    entry["review"] = write_review(stored, manifest.new_path(f"review{stamp}"))
    before = manifest.read()
    manifest.commit({"months": before.get("months", {}) | {stamp: entry}, "latest": stamp, "schema": published.schema.json()})
    return entry


def read_published(spark: SparkSession, folder: str, stamp: str | None = None) -> DataFrame:
    """The published table of ``stamp``, or of the last commit."""
    found = Manifest(spark, folder).read()
    stamp = stamp or found.get("latest")
    if stamp not in found.get("months", {}):
        raise CommitError(f"{folder} has no published month {stamp or ''}".rstrip())
    return spark.read.schema(T.StructType.fromJson(json.loads(found["schema"]))).parquet(found["months"][stamp]["path"])
