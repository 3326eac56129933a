"""op2, op3 and op5 against their SQL, on the awkward texts."""

from collections import Counter

import duckdb
import pytest

from episcope.llm.catalog import ORACLE_SQL, QUERIES
from samples import documents, folder, patterned


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    rows = documents() + [(3000 + k, t) for k, t in enumerate(patterned(1 << 13, space=" "))]
    rows += [(3010, "tab\tand\x0bfeed\x0c" * 30), (3011, "nul-free \x1c\x1f " * 30), (3012, "ÀÉ Straße " * 40)]
    return folder(spark, tmp_path_factory.mktemp("awkward"), [(i, t, "en", "s", len(t or "")) for i, t in rows])


@pytest.mark.parametrize("name", ["op2_minhash_near_dedup", "op3_suffix_dedup", "op5_substring_dedup"])
def test_query_equals_its_sql(spark, awkward, name):
    found = QUERIES[name](spark, awkward)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{awkward}/documents.parquet/*.parquet')")
    got = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(found.columns)
    want = Counter(got.fetchall())
    assert Counter(map(tuple, found.select(*columns).collect())) == want
    assert len(want) > 100
