import os

import pytest

import __spark_entry__ as entry
from tessera.plans import catalog

SF = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and catalog.FLAGSHIP in entry.queries()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got = catalog.QUERIES[name](spark, SF)
    rows = [tuple(r[c] for c in sorted(got.columns)) for r in got.collect()]
    assert rows
    if name in catalog.ORACLES:
        q = con.execute(catalog.ORACLES[name])
        names = [d[0] for d in q.description]
        want = [tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)) for r in q.fetchall()]
        assert sorted(names) == sorted(got.columns)
        plain = lambda v: repr(float(v)) if isinstance(v, (int, float)) or hasattr(v, "as_tuple") else str(v)
        assert sorted(tuple(map(plain, r)) for r in rows) == sorted(tuple(map(plain, r)) for r in want)
