"""Every registered query with an oracle agrees with DuckDB on the smallest tables."""
import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

SLOW = {"smote", "balance_counts", "csv_roundtrip"}


def canon(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return str(int(v)) if v.is_integer() and abs(v) < 2 ** 53 else repr(v)
    if hasattr(v, "item"):
        return canon(v.item())
    return str(v)


def norm(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(canon(x) for x in r) for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _names():
    import __spark_entry__ as entry
    return [n for n in entry.oracle_sql() if n not in SLOW]


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as entry
    a = entry.queries()[name](spark, SF_SMALL).toPandas()
    b = con.execute(entry.oracle_sql()[name]).df()
    assert norm(a) == norm(b)


def test_every_query_has_a_builder(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.count() >= 0 and "spend" in df.columns
