"""Every registered query equals its DuckDB oracle on the smallest driver data
(same comparison as scripts/check_oracle.py: columns, types, sorted values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import SPARK_TO_DUCK, TABLES, key, norm  # noqa: E402

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
              for f in df.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    assert {c: stypes[c].replace(" ", "") for c in dcols} == {c: dtypes[c].replace(" ", "") for c in dcols}
    order = sorted(dcols)
    si, di = [df.columns.index(c) for c in order], [dcols.index(c) for c in order]
    sr = sorted([tuple(norm(r[i]) for i in si) for r in srows], key=key)
    dr = sorted([tuple(norm(r[i]) for i in di) for r in drows], key=key)
    assert sr == dr
