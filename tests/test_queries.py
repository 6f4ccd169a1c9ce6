"""Every query with SQL against DuckDB on the same Parquet files."""

import os

import duckdb
import pytest

from stratum.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


def rows(frame):
    """Rows as text, columns by name, in order; floats to 6 places."""
    frame = frame[sorted(frame.columns)]
    say = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(say, r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(name, spark, sf, duck):
    got, want = QUERIES[name](spark, sf).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_without_sql(name, spark, sf):
    """Estimates: whole, non-negative; noise: finite."""
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got)
    if "syn" in got:
        assert (got["syn"] >= 0).all()
        per_level = got.groupby("geolevel")["syn"].sum()
        assert per_level.nunique() == 1  # every level holds the same persons
    else:
        assert got["v"].notna().all()
