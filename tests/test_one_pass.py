"""Chunked and refreshed runs join the attendance tables once for all chunks they compute; the joins on an attendance move each table once."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from episcope.catalog import QUERIES
from episcope.operators import aggregate as AG
from episcope.operators import episodes as EPI
from episcope.plans import refresh
from episcope.plans.chunked import ChunkedExtract
from episcope.plans.refresh import MonthlyState
from episcope.session import materialize
from episcope.sources.fixtures import load_inputs
from episcope.sources.tables import Inputs


@pytest.fixture(scope="module")
def inp(spark):
    """Every fortieth patient's attendances, stored."""
    whole = load_inputs(spark, SF_SMALL)
    few = {n: getattr(whole, n).where("patientid % 40 = 1") for n in ("at_episodes", "at_prescriptions", "at_exposures")}
    return Inputs(**{n: materialize(df, n) for n, df in vars(replace(whole, **few)).items()})


def counted(monkeypatch, module, name):
    calls, real = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *args, **kwargs: (calls.append(name), real(*args, **kwargs))[1])
    return calls


def test_a_refresh_is_one_pass(spark, inp, tmp_path, monkeypatch):
    """a pass over the tables and a count for each chunk and year made the refresh slow."""
    passes, labels, counts = (counted(monkeypatch, m, n) for m, n in ((EPI, "core_rows"), (refresh.X, "labelled_rows"), (AG, "count_units")))
    done = MonthlyState(spark, str(tmp_path)).update(inp)
    assert len(done["chunks"]) == 5 and len(done["years"]) == 6
    assert (len(passes), len(labels), len(counts)) == (1, 1, 1)


def test_a_chunked_run_joins_the_attendances_once(spark, inp, tmp_path, monkeypatch):
    """each start of the run joins them for the chunks that are not finished; F2: the bound query once."""
    passes = counted(monkeypatch, EPI, "core_rows")

    def stop(chunk):
        if chunk.chunk_id == 4:
            raise RuntimeError("connection lost")

    with pytest.raises(RuntimeError):
        ChunkedExtract(spark, str(tmp_path), allow_empty=True).run(inp, before=stop)
    assert len(passes) == 1
    assert ChunkedExtract(spark, str(tmp_path), allow_empty=True).run(inp) == [4, 5] and len(passes) == 2
    passes.clear()
    QUERIES["chunked_equals_single"](spark, SF_SMALL)
    assert len(passes) == 1


ROWS = [(a, p, e, n) for a in (1, 2, None) for p in ("R1H", "RYR", None) for e in ("E1", "E2") for n in (7, 8)]
KEYS = "attendid long, orgcodeprovider string, radiotherapyepisodeid string, patientid long"


def test_joins_on_the_attendance_compare_every_key(spark):
    """Attendance ids repeat across providers, episodes and patients, and any key may be null."""
    e = spark.createDataFrame([(*r, k) for k, r in enumerate(ROWS)], KEYS + ", e int")
    p = spark.createDataFrame([(*r, f"RX{x}", m, k) for k, r in enumerate(ROWS[::2] + ROWS[:3]) for x, m in ((1, "05"), (2, "06"))],
                              KEYS + ", prescriptionid string, rttreatmentmodality string, dose int")
    x = spark.createDataFrame([(*r, rx, m) for k, r in enumerate(ROWS) for rx, m in (("RX1", None), ("RX2", "RA7OT1887" if k % 3 else "M1"), (None, "RA7OT1887"))],
                              KEYS + ", prescriptionid string, machineid string")
    plain = (p.join(x, EPI.RX_KEYS).where((F.col("rttreatmentmodality") == "05") | F.col("machineid").isin("RA7OT1887"))
             .select(p.columns).distinct())
    got = EPI.admitted(p, x)
    assert sorted(map(str, got.distinct().collect())) == sorted(map(str, plain.collect())) and got.count() == got.distinct().count() > 0
    rows = EPI.with_prescriptions(e, p.drop("prescriptionid"))
    wanted = e.join(p.drop("prescriptionid"), EPI.ATTEND_KEYS).select(rows.columns)
    assert sorted(map(str, rows.collect())) == sorted(map(str, wanted.collect())) != []


def test_each_attendance_table_moves_once(spark):
    """F4 to F21: prescriptions moved five times, by ever other lists of keys."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = EPI.core_rows(load_inputs(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    by_attendance = [m for m in moved if "attendid" in m]
    # The prescriptions' repeats, the exposures and the episodes by attendance; the episodes' repeats by all their columns.
    assert len(by_attendance) == 4 and sum("prescriptionid" in m for m in by_attendance) == 0, by_attendance
