"""F5 to F20: from the attendances to the units every row moves once by patient and once by episode, and is the same row as before."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from episcope.functions import fixed_values as fv
from episcope.operators import address as AD
from episcope.operators import aggregate as AG
from episcope.operators import clean as CL
from episcope.operators import episodes as EPI
from episcope.operators import extract as X
from episcope.operators.cells import ATTRIBUTES, UNIT_COLUMNS, cells
from episcope.plans.specs import all_specs
from episcope.sources.fixtures import load_inputs, render, view_dependencies


def moves(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|RoundRobin)[pP]artitioning\(([^)]*)\)", plan)


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def inp(spark):
    return load_inputs(spark, SF_SMALL)


def test_the_extract_and_its_units_move_by_episode_once(spark, inp):
    cleaned = CL.clean(X.extract(inp), inp.working_days)
    moved = moves(cleaned.select(*UNIT_COLUMNS, "WORKING_DAYS").distinct())
    assert len(moved) == 1 and moved[0].startswith(EPI.EP), moved


def test_core_rows_and_addresses_move_by_patient_once(spark, inp):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = moves(EPI.addressed_rows(inp))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    by_patient = [m for m in moved if m.startswith("patientid")]
    # The rows with the addresses, the patients, and the reduction of the addresses to days.
    assert sorted(m.count("#") for m in by_patient) == [1, 1, 2], by_patient


def test_duplicates_leave_the_episodes_where_they_are(spark, inp):
    assert not [m for m in moves(EPI.qualifying_episodes(inp)) if m.startswith(EPI.EP)]


def test_group_rows_of_an_episode_are_counted_in_place(spark, inp):
    cleaned = CL.clean(X.extract(inp), inp.working_days)
    cleaned = cleaned.select(*UNIT_COLUMNS)
    specs = [s for s in all_specs() if s[0] == fv.PERIOD_MONTH]
    _, several = cells(cleaned, fv.PERIOD_MONTH)
    counted = AG.spec_rows(several, specs, fv.PERIOD_MONTH, "RADIOTHERAPYEPISODEID", spread=False).groupBy(*AG.NARROW_KEYS).agg(F.countDistinct("RADIOTHERAPYEPISODEID"))
    moved = moves(counted)
    assert [m.split("#")[0].lower() for m in moved] == ["spec_id", EPI.EP] and "RoundRobin" not in str(moved), moved


@pytest.mark.parametrize("name", ["at_episodes", "at_prescriptions", "at_exposures"])
def test_attendance_views_are_their_templates(spark, inp, name):
    """Repeated lines and orders, and nulls in every column."""
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(300)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    holes = [F.when((F.col("l_orderkey") + i) % 9 != 0, F.col(c)).alias(c) if c != "l_orderkey" else F.col(c) for i, c in enumerate(lines.columns)]
    lines = lines.unionByName(lines.limit(40)).unionByName(lines.select(*holes))
    orders = orders.unionByName(orders.limit(50)).unionByName(orders.limit(60).withColumn("o_custkey", F.lit(None).cast("bigint")))
    from episcope.sources.fixtures import attendances
    got = attendances(spark, name, {"lineitem": lines, "orders": orders})
    frames = {"orders": orders, "lineitem": lines}
    frames["ep0"] = spark.sql(render("ep0", "spark", lambda n: "{" + n + "}"), orders=orders)
    want = spark.sql(render(name, "spark", lambda n: "{" + n + "}"), **{d: frames[d] for d in set(view_dependencies(name))})
    assert got.schema == want.schema or [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert rows(got) == rows(want) and got.count() > 0


def test_rows_keep_their_number_and_nulls_beside_addresses(spark):
    day = dt.date(2020, 1, 5)
    r = spark.createDataFrame([(1, day, "a"), (1, day, "a"), (None, day, "b"), (2, None, "c"), (2, day, "d"), (3, day, "e")],
                              "patientid long, treatmentstartdate date, k string")
    geo = spark.createDataFrame(
        [(10, 1, day, "N", "1"), (9, 1, day, "S", None), (9, 1, day, "N", None), (8, 1, dt.date(2030, 1, 1), "X", "2"), (7, None, day, "Y", "3"),
         (6, 2, None, "U", "4"), (None, 2, None, "V", "5")],
        "addressid long, patientid long, dateofaddress date, icb_hb string, imd19_quintile_lsoas string")
    got = AD.with_best_address(r, geo, "2019-01-01", "2024-05-31").select("k", "a_id", "a_icb", "a_imd")
    assert Counter(map(tuple, got.collect())) == Counter(
        {("a", 9, "N", None): 2, ("b", None, None, None): 1, ("c", None, None, None): 1, ("d", 6, "U", "4"): 1, ("e", None, None, None): 1})


def test_units_with_nulls_and_repeated_rows(spark):
    blank = dict.fromkeys(UNIT_COLUMNS)
    made = []
    for n, (e, y, m, c, i) in enumerate([("E1", 2020, 1, "a", "x"), ("E1", 2020, 2, "a", "x"), ("E2", 2020, 1, None, "x"), ("E2", 2020, 1, "a", "x"),
                                         ("E3", 2020, 3, None, None), ("E4", 2020, None, "a", "x"), (None, 2020, 1, "a", "x"), ("E5", None, None, "b", None),
                                         ("E6", 2021, 5, "b", "x"), ("E6", 2020, 5, "a", "x")]):
        made += [{**blank, UNIT_COLUMNS[0]: e, "EPI_YEAR": y, "EPI_MONTH": m, "CANCERTYPE": c, "ICB": i}] * (1 + n % 3)
    schema = ", ".join(f"{c} {'int' if c.startswith('EPI_') else 'string'}" for c in UNIT_COLUMNS)
    units = spark.createDataFrame([tuple(r[c] for c in UNIT_COLUMNS) for r in made], schema)
    for period, keys in ((fv.PERIOD_YEAR, ["EPI_YEAR"]), (fv.PERIOD_MONTH, ["EPI_YEAR", "EPI_MONTH"])):
        single, several = cells(units, period)
        of_unit = {}
        for r in made:
            if r[UNIT_COLUMNS[0]] is not None:
                of_unit.setdefault((r[UNIT_COLUMNS[0]], *[r[k] for k in keys]), set()).add(tuple(r[a] for a in ATTRIBUTES))
        want = Counter((*u[1:], *next(iter(v))) for u, v in of_unit.items() if len(v) == 1)
        assert {tuple(r)[:-1]: r.n for r in single.select(*keys, *ATTRIBUTES, "n").collect()} == want
        rest = several.select(UNIT_COLUMNS[0], *keys, *ATTRIBUTES)
        assert Counter(map(tuple, rest.collect())) == Counter((*u, *a) for u, v in of_unit.items() if len(v) > 1 for a in v)
