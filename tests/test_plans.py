"""Plan shape of the main stages: built-in operators only, no cross or
nested-loop joins, no Python evaluation, and no window operator over rows
(every per-group value is a map-side aggregate joined back; the only window
runs over a patient's distinct days); bounds on exchanges and scans."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
from episcope.operators import aggregate as AG
from episcope.operators import clean as CL
from episcope.operators import episodes as EPI
from episcope.functions import fixed_values as fv
from episcope.operators import extract as X
from episcope.operators.cells import cells, units
from episcope.plans.specs import all_specs
from episcope.sources.fixtures import load_inputs
from episcope.sources.tables import SCHEMAS, read_inputs

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
             "ArrowEvalPython"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _tree(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("stage", ["episode_rows", "labelled_rows", "published"])
def test_main_stage_plans(spark, stage):
    inp = load_inputs(spark, SF_SMALL)
    if stage == "episode_rows":
        df = EPI.episode_rows(inp)
    elif stage == "labelled_rows":
        df = X.labelled_rows(inp)
    else:
        df = AG.publish(CL.clean(X.extract(inp), inp.working_days))
    plan = _plan(df)
    for word in FORBIDDEN:
        assert word not in plan, (stage, word)
    assert stage != "episode_rows" or "Window " not in plan


def test_labelled_rows_exchanges_and_address_scans(spark):
    inp = load_inputs(spark, SF_SMALL)
    plan = _tree(X.labelled_rows(inp))
    assert plan.count("Exchange hashpartitioning") < 15
    # The growing tables (attendances from lineitem, addresses from events) are read in stored steps before.
    assert "/lineitem.parquet" not in plan and "/events.parquet" not in plan


def test_explode_has_the_configured_tasks(spark):
    inp = load_inputs(spark, SF_SMALL)
    cleaned = CL.clean(X.extract(inp), inp.working_days)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        single, _ = cells(units(cleaned), fv.PERIOD_MONTH)
        assert "RoundRobinPartitioning(2000)" in _tree(AG.spec_rows(single, all_specs(), fv.PERIOD_MONTH, "n"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_mirrored_specs_are_counted_once():
    specs = all_specs()
    pairs = AG.mirrored(specs)
    assert len(pairs) == 6
    for a, b in pairs.items():
        assert (specs[a][2].prim_lvl, specs[a][2].lvl_2) == (specs[b][2].lvl_2, specs[b][2].prim_lvl)


def test_filters_reach_the_episode_scan(spark, tmp_path):
    """Over stored tables read by the typed reader."""
    inp = load_inputs(spark, SF_SMALL)
    for name in SCHEMAS:
        getattr(inp, name).write.parquet(str(tmp_path / name))
    plan = _plan(EPI.qualifying_episodes(read_inputs(spark, str(tmp_path))))
    assert "GreaterThanOrEqual(treatmentstartdate,2019-01-01)" in plan
    assert "LessThanOrEqual(treatmentstartdate,2024-05-31)" in plan
