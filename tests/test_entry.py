import math

import duckdb
import pytest

import __spark_entry__ as E
from kestrel.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_contract(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["theyear", "orders", "amount"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_against_duckdb_sf0001(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    cols = sorted(df.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    drows = sorted(tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in res.fetchall())
    assert srows == drows


@pytest.mark.parametrize("key", ["tumbling_counts", "sliding_counts", "star_sales", "hour_flow", "offset_resume"])
def test_results_do_not_depend_on_session_time_zone(spark, key):
    def run():
        df = E.queries()[key](spark, SF)
        cols = sorted(df.columns)
        return sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert run() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_readme_maps_every_registered_query():
    import os
    readme = open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")).read()
    missing = [k for k in E.queries() if k not in readme]
    assert not missing, missing
