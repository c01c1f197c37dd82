"""Every query with an SQL twin, compared on the smallest test tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from shelfcast.catalog.oracles import ORACLES
from shelfcast.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("part", "orders", "lineitem", "events")
KEYS = ("window_id", "goods_id", "sku_id", "data_date", "l_orderkey", "l_linenumber", "level")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def ordered(pdf):
    columns = sorted(pdf.columns)
    keys = [k for k in KEYS if k in columns] + [c for c in columns if c not in KEYS]
    text = [c for c in columns if c == "feature"]
    plain = pdf[columns].astype({c: float for c in columns if c not in text})
    return plain.sort_values(keys).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    want = duck.execute(ORACLES[name]).df()
    pd.testing.assert_frame_equal(ordered(got), ordered(want), check_exact=True)


def test_entry_points_list_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_oracles_name_existing_queries():
    assert set(ORACLES) <= set(QUERIES)
    without = {"ols_week_forecast", "ols_day_forecast", "gbt_week_forecast", "select_by_importance"}
    assert set(QUERIES) - set(ORACLES) == without
