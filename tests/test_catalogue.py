"""Every registered query with SQL against DuckDB on the small tables."""

import os

import pandas as pd
import pytest

from chronolith.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the small tables are not here")


def _plain(value):
    if value is None or (not isinstance(value, list | dict | str) and pd.isna(value)):
        return None
    if isinstance(value, float) or str(type(value)).find("Decimal") >= 0:
        return int(value) if value == int(value) else float(value)
    return value.item() if hasattr(value, "item") else value


def _rows(frame: pd.DataFrame) -> list[str]:
    return sorted(repr(tuple(map(_plain, row))) for row in frame[sorted(frame.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{DATA}/{name}')")
    return con


# fits a full 30-day calendar, which the smallest table does not have
SPARSE = {"quality_folds"}


@pytest.mark.parametrize("name", sorted(catalogue.SQL.keys() - SPARSE))
def test_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    want = duck.execute(catalogue.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_flagship_and_registry(spark):
    assert catalogue.flagship(spark, DATA).count() > 0
    assert catalogue.SQL.keys() <= catalogue.QUERIES.keys()
