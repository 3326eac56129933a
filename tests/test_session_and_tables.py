"""Scratch tables, the shared-folder rule, and the typed table reader."""

import datetime as dt

import pytest
from conftest import SF_SMALL

from episcope import session as S
from episcope.functions import classify as C
from episcope.operators import extract as X
from episcope.plans.monthly import monthly_run_from
from episcope.sources.fixtures import load_inputs
from episcope.sources.tables import SCHEMAS, read_inputs, read_table, typed
from pyspark.sql import functions as F


class _Cluster:
    """A session on a cluster without a shared folder."""

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

        @staticmethod
        def getConf():
            return {}


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    _Cluster.sparkContext.master = master
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_Cluster)


def test_scratch_is_released(spark):
    S.release_scratch(spark)
    df = S.materialize(spark.range(5), "few")
    path = S._WRITTEN[-1]
    assert df.count() == 5 and S.release_scratch(spark) == 1
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_empty_text_is_null_spaces_stay_and_timestamps_are_dates(spark):
    raw = spark.sql("""select 1L attendid, 'E1' radiotherapyepisodeid, 7 patientid, ' ' orgcodeprovider,
        timestamp'2024-05-31 10:00:00' treatmentstartdate, '' radiotherapyintent, 'C341' radiotherapydiagnosisicd, 9 extra""")
    row = typed(raw, SCHEMAS["at_episodes"]).first()
    assert row.orgcodeprovider == " " and row.radiotherapyintent is None
    assert row.treatmentstartdate == dt.date(2024, 5, 31) and "extra" not in row.asDict()


def test_a_blank_region_is_unknown_not_lung(spark):
    raw = spark.createDataFrame([("",), ("P",), (None,), ("O",)], "rttreatmentregion string")
    rows = raw.select(F.when(F.col("rttreatmentregion") != "", F.col("rttreatmentregion")).alias("r"))
    got = [r[0] for r in rows.select(C.tumour_group(F.lit("C341"), F.col("r"))).collect()]
    assert got == ["OTHER ICD CODES", "LUNG", "OTHER ICD CODES", "OTHER ICD CODES"]


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="machineid"):
        typed(spark.range(1), SCHEMAS["at_exposures"])


def test_monthly_run_from_a_folder_with_a_working_days_file(spark, tmp_path):
    inp = load_inputs(spark, SF_SMALL)
    for name in SCHEMAS:
        getattr(inp, name).write.parquet(str(tmp_path / "tables" / name))
    days = inp.working_days.selectExpr("date_format(calendar_month, 'yyyy-MM-dd') as month", "working_days as days", "'x' as note")
    days.write.option("header", True).csv(str(tmp_path / "days"))
    read = read_table(spark, "working_days", str(tmp_path / "days"), "csv")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, inp.working_days.collect()))
    out = monthly_run_from(spark, str(tmp_path / "tables"), str(tmp_path / "out"), run_date=dt.date(2024, 7, 1),
                           working_days_csv=str(tmp_path / "days"))
    stored = spark.read.parquet(out["parquet"])
    csv = spark.read.option("header", True).csv(out["csv"])
    assert stored.count() == csv.count() > 0
    assert X.extract(read_inputs(spark, str(tmp_path / "tables"))).count() == X.extract(inp).count()
