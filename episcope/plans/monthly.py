"""The monthly run: extract -> hand-over file -> clean -> publish.

The two stages of the specification are two jobs joined by a file: the
extract is written (pipe-delimited, named by its latest month) and the
aggregation reads that file back, so either job can be rerun on its own and
a failure after the hand-over does not recompute the extract.  Checks stop the
run where the specification relies on the analyst's eyes, lines that don't
parse are kept and counted, and readers of the result follow its manifest.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregate as AG
from ..operators import clean as CL
from ..operators import extract as X
from ..operators.checks import Check, RunChecks, every_chunk, no_nulls
from ..session import release_scratch
from ..sources.io import extract_file_tag, read_extract, write_extract
from ..sources.publication import publish_month
from ..sources.rejects import read_extract_checked, read_working_days_checked
from ..sources.tables import Inputs, read_inputs
from .params import DEFAULT, RunParams


def checked_extract_rows(inp: Inputs, params: RunParams = DEFAULT, checks: RunChecks | None = None) -> DataFrame:
    """The extract's distinct rows, stored; the run stops on a null episode id or month, an empty chunk of the period, or a
    look-up with two rows a key."""
    rows = X.labelled_rows(inp, params).distinct()
    checks = checks or RunChecks(rows.sparkSession)
    checks.lookups(inp)
    month = F.to_date(F.concat("CALENDAR_MONTH", F.lit("/01")), "yyyy/MM/dd")
    return checks.stored(rows, "extract_rows", [
        Check("rows", F.count(F.lit(1)), at_least=1), no_nulls("RADIOTHERAPYEPISODEID"), no_nulls("CALENDAR_MONTH"),
        *every_chunk(month, list(params.chunks))])


def run_extract(inp: Inputs, out_folder: str, params: RunParams = DEFAULT, fmt: str = "csv") -> str:
    rows = checked_extract_rows(inp, params)
    return write_extract(X.recounted(rows), out_folder, fmt, tag=extract_file_tag(rows))


def run_aggregation(spark: SparkSession, extract_path: str, inp: Inputs, out_folder: str,
                    params: RunParams = DEFAULT, fmt: str = "csv", run_date: dt.date | None = None,
                    working_days_csv: str | None = None, reject_limit: int | None = 0) -> dict:
    """Working days come from the CSV file where one is named, else from the input table.  More than ``reject_limit``
    lines that don't parse stop the run (None: they are left out)."""
    days = read_working_days_checked(spark, working_days_csv, reject_limit).accepted if working_days_csv else inp.working_days
    rows = read_extract_checked(spark, extract_path, reject_limit).accepted if fmt == "csv" else read_extract(spark, extract_path, fmt)
    entry = publish_month(AG.publish(CL.clean(rows, days, params)), out_folder, run_date)
    return {"parquet": entry["path"], "csv": entry["review"]}


def monthly_run(spark: SparkSession, inp: Inputs, out_folder: str, params: RunParams = DEFAULT,
                run_date: dt.date | None = None, working_days_csv: str | None = None) -> dict:
    """Both stages; intermediate tables are released at the end."""
    extract_path = run_extract(inp, out_folder, params)
    paths = run_aggregation(spark, extract_path, inp, out_folder, params, run_date=run_date, working_days_csv=working_days_csv)
    release_scratch(spark)
    return {"extract": extract_path, **paths}


def monthly_run_from(spark: SparkSession, tables_folder: str, out_folder: str, params: RunParams = DEFAULT,
                     run_date: dt.date | None = None, working_days_csv: str | None = None) -> dict:
    """The monthly run over a folder of input tables (``sources.tables.read_inputs``)."""
    return monthly_run(spark, read_inputs(spark, tables_folder), out_folder, params, run_date, working_days_csv)
