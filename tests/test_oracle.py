"""Registered queries against their DuckDB oracles on the tiny tables."""

import hashlib

import duckdb
import pandas as pd
import pytest

from conftest import SF_TINY

import __spark_entry__ as E

FAST = ["sales_fiscal_dates", "entity_id_normalize", "panel_grid", "panel_grid_sparse", "panel_lags",
        "panel_rolling", "calendar_features", "national_features", "static_shares", "weather_features",
        "acreage_prior_year", "county_names", "economic_join", "panel_full", "holdout_metrics",
        "county_accuracy", "extend_external", "forecast_recursive_linear", "forecast_chunk",
        "importance_all_levels", "future_fill", "demand_spikes", "table_profile",
        "missing_weather", "forecast_known_or_model", "scenario_what_if", "model_registry",
        "latest_approved_model", "national_serving"]


def canon(df):
    cols = sorted(df.columns)
    rows = sorted("|".join("" if pd.isna(v) else str(v) for v in r)
                  for r in df[cols].itertuples(index=False, name=None))
    return len(df), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_TINY}/{t}.parquet')")
    return con


def test_every_query_has_a_callable():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_TINY).toPandas()
    dd = duck.execute(E.oracle_sql()[name]).df()
    assert canon(sp) == canon(dd)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
