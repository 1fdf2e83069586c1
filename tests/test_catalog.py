"""Every registered query against its DuckDB counterpart on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tradebars.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(x):
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return str(bool(x))
    if hasattr(x, "year"):
        return str(pd.Timestamp(x))
    try:
        return f"{float(x):.6f}"
    except (TypeError, ValueError):
        return str(x)


@pytest.mark.skipif(not Path(DATA).exists(), reason="the test tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, DATA).toPandas()
    want = duck.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = lambda d: sorted(tuple(map(plain, r)) for r in d[columns].itertuples(index=False))
    assert rows(got) == rows(want)


def test_entry_does_without_the_corpus_queries():
    import __spark_entry__ as entry

    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
