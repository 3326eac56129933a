"""Hand-over files, the monthly run, and the pair-free chunk counts."""

import datetime as dt
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from episcope.functions import fixed_values as fv
from episcope.operators import aggregate as AG
from episcope.operators import clean as CL
from episcope.operators import episodes as EPI
from episcope.operators import extract as X
from episcope.plans.monthly import monthly_run
from episcope.sources.fixtures import load_inputs
from episcope.sources.publication import read_published
from episcope.sources.io import read_extract, write_extract


def _rows(df, cols=None):
    cols = sorted(cols or df.columns)
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_extract_file_roundtrip(spark):
    ext = X.extract(load_inputs(spark, SF_SMALL))
    folder = tempfile.mkdtemp(prefix="episcope-test-")
    path = write_extract(ext, folder)
    assert path.endswith("extract_" + ext.agg(F.max("CALENDAR_MONTH")).first()[0][5:7]
                         + ext.agg(F.max("CALENDAR_MONTH")).first()[0][0:4])
    back = read_extract(spark, path)
    assert back.schema["SEX"].dataType.typeName() == "integer"
    assert _rows(back) == _rows(ext)


def test_monthly_run_equals_published(spark):
    inp = load_inputs(spark, SF_SMALL)
    folder = tempfile.mkdtemp(prefix="episcope-test-")
    out = monthly_run(spark, inp, folder, run_date=dt.date(2024, 6, 1))
    assert "/aggregation2024-06-01-" in out["parquet"]
    published = spark.read.parquet(out["parquet"])
    direct = AG.publish(CL.clean(X.extract(inp), inp.working_days))
    assert _rows(published) == _rows(direct)
    assert _rows(read_published(spark, folder)) == _rows(direct)
    csv = spark.read.option("header", True).csv(out["csv"])
    assert csv.count() == direct.count()


def test_chunk_counts_match_joined_rows(spark):
    inp = load_inputs(spark, SF_SMALL)
    e = EPI.qualifying_episodes(inp)
    p = EPI.admitted_prescriptions(inp, e)
    joined = e.join(p, EPI.ATTEND_KEYS, "inner").withColumn(
        "chunk_id", F.expr(" ".join(
            ["CASE"] + [f"WHEN treatmentstartdate BETWEEN DATE'{c.start}' AND DATE'{c.end}' THEN {c.chunk_id}"
                        for c in EPI.DEFAULT.chunks] + ["END"])))
    brute = joined.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.countDistinct(EPI.EP).alias("n_episodes"))
    assert _rows(EPI.chunk_counts(inp)) == _rows(brute)


def test_unchunked_windows_differ_only_by_chunk_edges(spark):
    """Without the chunk key the per-episode values span New Year; the
    extract keeps the same episodes."""
    from episcope.plans.params import RunParams
    inp = load_inputs(spark, SF_SMALL)
    a = X.extract(inp).select("RADIOTHERAPYEPISODEID").distinct()
    b = X.extract(inp, RunParams(chunked=False)).select("RADIOTHERAPYEPISODEID").distinct()
    assert _rows(a) == _rows(b)
