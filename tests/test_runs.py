"""The monthly run's machinery: what fails stops, what is finished stays, what is committed is whole."""

import datetime as dt
import json
import os
import re
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from episcope.functions import classify as C
from episcope.functions import fixed_values as fv
from episcope.functions.rule_index import ANY, Rule, RuleIndex, schedule_rules, with_schedule
from episcope.operators import checks as K
from episcope.operators import episodes as EPI
from episcope.operators import extract as X
from episcope.plans.calendar import chunk_id
from episcope.plans.chunked import ChunkedExtract, EmptyChunk, chunk_params, chunk_rows, of_chunks
from episcope.plans.params import DEFAULT, RunParams
from episcope.plans.refresh import MonthlyState, chunk_fingerprints
from episcope.session import materialize
from episcope.sources import rejects as R
from episcope.sources.fixtures import load_inputs
from episcope.sources.io import REVIEW_ORDER, write_extract, write_published
from episcope.sources.layout import StoredLayout, delivered_prescriptions
from episcope.sources.manifest import CommitError, Manifest, store
from episcope.sources.publication import publish_month, read_published
from episcope.sources.tables import Inputs


@pytest.fixture(scope="module")
def inp(spark):
    return Inputs(**{n: materialize(df, n) for n, df in vars(load_inputs(spark, SF_SMALL)).items()})


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert a.select(columns).exceptAll(b.select(columns)).count() == 0 and b.select(columns).exceptAll(a.select(columns)).count() == 0


# -- manifests and publication ------------------------------------------------

def test_manifest_versions(spark, tmp_path):
    m = Manifest(spark, str(tmp_path / "m"))
    assert m.read() == {} and m.versions() == []
    assert (m.commit({"a": 1}), m.commit({"a": 2})) == (1, 2)
    assert m.read() == {"a": 2} and m.read(1) == {"a": 1}
    late = Manifest(spark, str(tmp_path / "m"))
    late.versions = lambda: [1]  # a writer that looked before version 2 was there
    with pytest.raises(CommitError):
        late.commit({"a": 3})
    assert m.read() == {"a": 2} and not [f for f in os.listdir(tmp_path / "m/_manifests") if "json" not in f and not f.startswith(".")]


def test_a_reader_never_sees_a_half_written_month(spark, tmp_path):
    folder = str(tmp_path / "p")
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("activity_month"), F.lit(2024).alias("activity_year"),
                                 F.lit("x").alias("geo_lvl"), F.lit("m").alias("period"), F.lit("t").alias("prim_lvl"))
    with pytest.raises(CommitError):
        read_published(spark, folder)
    publish_month(df, folder, dt.date(2024, 5, 1))
    failing = df.withColumn("id", F.when(F.col("id") == 90, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        publish_month(failing, folder, dt.date(2024, 6, 1))
    same(read_published(spark, folder), df)
    with pytest.raises(CommitError):
        read_published(spark, folder, "2024-06-01")
    publish_month(df.where("id < 7"), folder, dt.date(2024, 6, 1))
    assert read_published(spark, folder).count() == 7 and read_published(spark, folder, "2024-05-01").count() == 100
    swept = Manifest(spark, folder).sweep()  # what the failed run left
    assert swept >= 1 and read_published(spark, folder, "2024-05-01").count() == 100


def test_a_table_that_is_not_stored_as_computed_is_no_commit(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    write = DataFrameWriter.parquet

    def lossy(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
        os.remove(os.path.join(path, parts[-1]))

    monkeypatch.setattr(DataFrameWriter, "parquet", lossy)
    with pytest.raises(CommitError, match="rows were written"):
        store(spark.range(0, 100, 1, 4).toDF("id"), str(tmp_path / "t"))


def test_review_file_is_in_order(spark, tmp_path):
    """O2: read part by part, line by line, not only counted."""
    rows = [(2019 + k % 4, k % 13, f"g{k % 3}", f"p{k % 2}", f"l{k % 5}", k) for k in range(500)]
    df = spark.createDataFrame(rows, "activity_year int, activity_month int, geo_lvl string, period string, prim_lvl string, n int").repartition(5)
    path = write_published(df, str(tmp_path), dt.date(2024, 1, 1))["csv"]
    lines = []
    for part in sorted(f for f in os.listdir(path) if f.startswith("part-")):
        with open(os.path.join(path, part)) as f:
            head, *body = [x.rstrip("\n").split(",") for x in f]
        lines += [tuple(int(r[head.index(c)]) if c.startswith("activity") else r[head.index(c)] for c in REVIEW_ORDER) for r in body]
    assert len(lines) == 500 and lines == sorted(lines)


# -- restart --------------------------------------------------------------------

def test_a_stopped_run_goes_on_where_it_was(spark, inp, tmp_path):
    run = ChunkedExtract(spark, str(tmp_path), allow_empty=True)

    def stop(chunk):
        if chunk.chunk_id == 4:
            raise RuntimeError("connection lost")

    with pytest.raises(RuntimeError, match="connection lost"):
        run.run(inp, before=stop)
    with pytest.raises(RuntimeError, match="not finished: \\[4, 5\\]"):
        run.extract()
    kept = {s: p["path"] for s, p in run.finished().items()}
    asked = []
    assert ChunkedExtract(spark, str(tmp_path), allow_empty=True).run(inp, before=lambda c: asked.append(c.chunk_id)) == [4, 5]
    assert asked == [4, 5] and {s: run.finished()[s]["path"] for s in kept} == kept
    same(run.extract(), X.extract(inp))
    run.discard(2)
    assert run.run(inp) == [2] and run.run(inp) == []
    same(run.extract(), X.extract(inp))


def test_an_empty_chunk_stops_the_run(spark, inp, tmp_path):
    gap = replace(inp, at_episodes=inp.at_episodes.where("year(treatmentstartdate) <> 2020"))
    with pytest.raises(EmptyChunk, match="2020-01-01"):
        ChunkedExtract(spark, str(tmp_path)).run(gap)


# -- refresh --------------------------------------------------------------------

def test_refresh_redoes_only_what_changed(spark, inp, tmp_path):
    import __spark_entry__ as E

    state = MonthlyState(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        state.published(inp.working_days)
    before = RunParams(period_end="2024-04-30", complete_month_cutoff="2024-03-01", working_day_cutoff="2024-03-01")
    # The new month brings episodes of its own only, so no old row turns into a duplicate.
    new = (inp.at_episodes.groupBy("radiotherapyepisodeid").agg(F.min("treatmentstartdate").alias("first"), F.countDistinct("patientid").alias("n"))
           .where("first >= '2024-05-01' and n = 1").select("radiotherapyepisodeid"))
    known = replace(inp, at_episodes=materialize(inp.at_episodes.join(new, "radiotherapyepisodeid", "left_anti").select(inp.at_episodes.columns), "known"))
    first = state.update(known, before)
    assert first["chunks"] == [c.chunk_id for c in before.chunks] and state.update(known, before) == {"chunks": [], "years": []}
    assert new.count() > 0
    done = state.update(inp)
    assert done["chunks"] == [5] and done["years"] == [2023, 2024]
    same(state.published(inp.working_days), E.queries()["published_table"](spark, SF_SMALL))
    assert state.update(inp) == {"chunks": [], "years": []}
    assert state.update(inp, also=(2,)) == {"chunks": [2], "years": [2020]}


def test_a_late_duplicate_touches_its_old_chunk(spark, inp):
    """A new row elsewhere can make an old episode a duplicate, which drops it from its chunk."""
    row = inp.at_episodes.where("year(treatmentstartdate) = 2019").orderBy("attendid").limit(1)
    late = row.withColumn("patientid", F.col("patientid") + 1_000_000).withColumn("treatmentstartdate", F.lit("2024-05-02").cast("date"))
    more = replace(inp, at_episodes=inp.at_episodes.unionByName(late))
    prints = [{(r.chunk_id, r.source): (r.rows, r.checksum) for r in chunk_fingerprints(i).collect()} for i in (inp, more)]
    changed = {k for k in prints[0].keys() | prints[1].keys() if prints[0].get(k) != prints[1].get(k)}
    assert (1, "episodes") in changed and (5, "episodes") in changed and not any(c in (2, 3, 4) for c, _ in changed)


def test_fingerprints_move_hashes_and_equal_the_joined_rows(spark, inp):
    """Of prescriptions and exposures only the hashes of keys and row move; null keys belong to no chunk, repeated rows count each."""
    rx, ex = inp.at_prescriptions, inp.at_exposures
    null = F.lit(None).cast("string")
    odd = replace(inp, at_prescriptions=rx.unionByName(rx.limit(50)).unionByName(rx.limit(20).withColumn("orgcodeprovider", null)),
                  at_episodes=inp.at_episodes.unionByName(inp.at_episodes.limit(30)).unionByName(inp.at_episodes.limit(9).withColumn("orgcodeprovider", null)))
    got = chunk_fingerprints(odd)
    date, chunks = F.col("treatmentstartdate"), list(DEFAULT.chunks)
    attendances = odd.at_episodes.select(*EPI.ATTEND_KEYS, chunk_id(date, chunks).alias("chunk_id")).where("chunk_id is not null").distinct()
    for name, df in (("prescriptions", odd.at_prescriptions), ("exposures", ex)):
        joined = df.join(attendances, EPI.ATTEND_KEYS)
        row = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
        same(got.where(F.col("source") == name).select("chunk_id", "rows", "checksum"),
             joined.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("checksum")))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = chunk_fingerprints(inp)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = [m.split("#")[0] for m in re.findall(r"Exchange hashpartitioning\(([^,]*),", plan)]
    assert sorted(moved) == sorted(["chunk_id", EPI.EP, EPI.EP, "key", "key"]), moved


def test_only_episodes_of_changed_chunks_move(spark, inp, monkeypatch):
    """Chunks are cut out of the episodes ahead of the joins, with duplicates found among all episodes, and their rows are the same."""
    seen = []
    real = EPI.addressed_rows
    monkeypatch.setattr(EPI, "addressed_rows", lambda i, *a: seen.append(i.at_episodes) or real(i, *a))
    some = [DEFAULT.chunks[1], DEFAULT.chunks[4]]
    got = chunk_rows(inp, some)
    same(got, of_chunks(real(inp), some))
    days = seen[0].agg(F.count_if(chunk_id(F.col("treatmentstartdate"), list(DEFAULT.chunks)).isin(2, 5)), F.count(F.lit(1))).first()
    assert 0 < days[0] == days[1] < inp.at_episodes.count()


# -- checks -----------------------------------------------------------------------

def test_planted_faults_stop_the_run(spark, inp):
    run = K.RunChecks(spark)
    rows = spark.createDataFrame([("E1", "2019/05"), (None, "2020/05")], "RADIOTHERAPYEPISODEID string, CALENDAR_MONTH string")
    with pytest.raises(K.CheckFailed, match="null RADIOTHERAPYEPISODEID is 1"):
        run.stored(rows, "extract_rows", [K.no_nulls("RADIOTHERAPYEPISODEID")])
    month = F.to_date(F.concat("CALENDAR_MONTH", F.lit("/01")), "yyyy/MM/dd")
    with pytest.raises(K.CheckFailed, match="rows of chunk 3 is 0"):
        run.stored(rows, "chunks", K.every_chunk(month, list(DEFAULT.chunks)))
    twice = replace(inp, nspl=inp.nspl.unionByName(inp.nspl.limit(2)))
    with pytest.raises(K.CheckFailed, match="repeated pcd is 2"):
        run.lookups(twice)
    report = run.report().where("not passed").collect()
    assert {(r.step, r.value) for r in report} >= {("extract_rows", 1), ("chunks", 0), ("nspl", 2)}
    run.lookups(inp)


# -- rejects ----------------------------------------------------------------------

def test_bad_lines_are_kept_and_counted_and_good_ones_unchanged(spark, inp, tmp_path):
    extract = materialize(X.extract(inp), "x")
    path = write_extract(extract, str(tmp_path))
    head = "|".join(X.EXTRACT_COLUMNS)
    cells = ["RH1", "England", '"A | B"', "n", "o", "c", "2020/01", "LUNG", "RADICAL", "f", "a", "e", "en", "1", "Male", "1", "icb", "E1", "d", "g", "1"]
    bad = ["|".join(cells[:-3]), "|".join([*cells, "more"]), "|".join([*cells[:-1], "many"]), "|".join([*cells[:13], "m", *cells[14:]])]
    with open(f"{path}/part-planted.csv", "w") as f:
        f.write("\n".join([head, "|".join(cells), *bad]) + "\n")
    read = R.read_extract_checked(spark, path)
    assert read.n_rejects == 4 and read.accepted.count() == extract.count() + 1
    assert sorted((r.reason, r.n_fields) for r in read.rejects.collect()) == [
        (R.FIELD_COUNT, 18), (R.FIELD_COUNT, 22), (R.FIELD_TYPE, 21), (R.FIELD_TYPE, 21)]
    same(read.accepted.where("PROVIDER_NAME is null or PROVIDER_NAME <> 'A | B'"), extract)
    assert {r.line for r in read.rejects.collect()} == set(bad)
    R.read_extract_checked(spark, path, limit=4)
    with pytest.raises(R.TooManyRejects, match="4 lines are rejected, 3 may be"):
        R.read_extract_checked(spark, path, limit=3)


def test_working_days_file(spark, tmp_path):
    file = tmp_path / "days.csv"
    file.write_text('Month,Working days,Note\n2020-01-01,22,ok\n"2020-02-01","20",\n\n2020-13-01,20,\n2020-03-01,twenty,\n2020-04-01\n')
    read = R.read_working_days_checked(spark, str(file))
    assert sorted((str(r.calendar_month), r.working_days) for r in read.accepted.collect()) == [("2020-01-01", 22), ("2020-02-01", 20)]
    assert read.n_rejects == 3
    with pytest.raises(R.TooManyRejects):
        R.read_working_days_checked(spark, str(file), limit=0)


# -- the rule index -----------------------------------------------------------------

def test_rule_index_equals_the_case_chains_on_every_boundary(spark):
    doses = {d + e for _, lo, hi, *_ in [b[:3] + ("",) for b in fv.SCHEDULE_BOXES + fv.SCHEDULE_GROUP_OVERRIDES] for d in (lo, hi)
             for e in (Decimal("-0.001"), Decimal(0), Decimal("0.001"))} | {Decimal(0), Decimal("500")}
    fractions = {f + e for b in fv.SCHEDULE_BOXES + fv.SCHEDULE_GROUP_OVERRIDES for f in b[3:5] for e in (-1, 0, 1)} | {0, 1, 5, 6, 10, 11, 12, 99}
    tumours = sorted({b[0] for b in fv.SCHEDULE_BOXES}) + ["OTHER", None]
    grid = (spark.createDataFrame([(t,) for t in tumours], "cancertype string")
            .crossJoin(spark.createDataFrame([(1,), (2,), (3,), (None,)], "min_intent int"))
            .crossJoin(spark.createDataFrame([(d,) for d in sorted(doses)] + [(None,)], "max_dose decimal(8,3)"))
            .crossJoin(spark.createDataFrame([(f,) for f in sorted(fractions)] + [(None,)], "max_fractions int")))
    args = ("cancertype", "min_intent", "max_dose", "max_fractions")
    both = with_schedule(grid).withColumn("label", C.schedule_label(*args)).withColumn("grp", C.schedule_group(*args))
    assert both.where("schedule_label <> label or schedule_group <> grp").count() == 0
    assert both.where(f"schedule_label <> '{fv.SCHEDULE_OTHER}'").select("schedule_label").distinct().count() > 40


def test_rules_are_data(spark):
    index = RuleIndex.of([Rule(2, "LUNG", Decimal(10), None, 1, 3, "wide"), Rule(2, "LUNG", Decimal(12), Decimal(14), 2, 2, "late"),
                          Rule(2, "LUNG", Decimal(13), Decimal(13), 1, 1, None, True), Rule(1, ANY, None, None, 4, None, "many")])
    rows = spark.createDataFrame([("LUNG", 2, Decimal(d), f) for d, f in ((9, 1), (10, 1), (12, 2), (13, 1), (900, 3), (900, 4))] + [("X", 1, None, 40)],
                                 "cancertype string, min_intent int, max_dose decimal(8,3), max_fractions int")
    got = {(r.max_dose, r.max_fractions): (r.schedule_label, r.schedule_group) for r in with_schedule(rows, index).collect()}
    inside, outside = fv.SCHEDULE_GROUP_INSIDE, fv.SCHEDULE_GROUP_OUTSIDE
    assert got == {(Decimal(9), 1): ("other", outside), (Decimal(10), 1): ("wide", inside), (Decimal(12), 2): ("wide", inside),
                   (Decimal(13), 1): ("wide", outside), (Decimal(900), 3): ("wide", inside), (Decimal(900), 4): ("other", outside),
                   (None, 40): ("many", fv.SCHEDULE_GROUP_PALLIATIVE)}
    assert len(RuleIndex.of(schedule_rules()).cells) < 3000


# -- the stored layout --------------------------------------------------------------

def test_stored_layout_joins_without_exchange_and_prunes_months(spark, inp, tmp_path):
    layout = StoredLayout(spark, str(tmp_path), 16)
    layout.write(inp)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        df = delivered_prescriptions(layout.inputs(inp, RunParams(period_start="2021-01-01", period_end="2021-06-30")),
                                     RunParams(period_start="2021-01-01", period_end="2021-06-30"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert "PartitionFilters: [isnotnull(treatment_month" in plan and "SelectedBucketsCount: 16 out of 16" in plan
        want = delivered_prescriptions(inp, RunParams(period_start="2021-01-01", period_end="2021-06-30"))
        same(df, want)
        assert df.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        layout.drop()


def test_chunk_params_keep_the_cut_offs():
    p = RunParams(complete_month_cutoff="2023-01-01")
    c = chunk_params(p.chunks[1], p)
    assert c.complete_month_cutoff == "2023-01-01" and (c.period_start, c.period_end) == ("2020-01-01", "2020-12-31")
    assert json.loads(json.dumps({"end": p.chunks[1].end.isoformat()}))["end"] == c.period_end
