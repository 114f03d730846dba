"""Every query with an oracle SQL matches DuckDB on the smallest tables."""
import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_CHECK, SF_SMALL

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


# Oracles that encode a data-dependent decision taken at the gate scale
# (e.g. events.user_id has > 20 distinct values only from sf0.01 on).
AT_CHECK_SCALE = {"frequency_encode"}


def _con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def cons():
    return {SF_SMALL: _con(SF_SMALL), SF_CHECK: _con(SF_CHECK)}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, cons, name):
    sf = SF_CHECK if name in AT_CHECK_SCALE else SF_SMALL
    got = E.queries()[name](spark, sf).toPandas()
    exp = cons[sf].execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _rows(got) == _rows(exp)


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["available"] is True
    assert rows[0]["date_column"] == "o_orderdate" and rows[0]["metric_column"] == "o_totalprice"
