"""Serving features, series extension, guardrail and the recursive fold."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import forecast as FC
from panelcast.operators.scoring import LinearModel


def test_extend_series_seasonal_mean_else_last_known(spark):
    # January has two real values (mean), February one (falls back to last known)
    rows = [("F", "A", dt.date(2020, 1, 1), 10.0), ("F", "A", dt.date(2020, 2, 1), 3.0),
            ("F", "A", dt.date(2021, 1, 1), 20.0)]
    ext = spark.createDataFrame(rows, "Family string, FIPS string, date date, x double")
    out = FC.extend_external(ext, ["x"], dt.date(2022, 2, 1)).filter("is_extended").orderBy("date").collect()
    got = [(r["date"], r["x"]) for r in out]
    assert got[0] == (dt.date(2021, 2, 1), 20.0)      # Feb: 1 real value -> last known
    assert got[11] == (dt.date(2022, 1, 1), 15.0)     # Jan: mean of two real Januaries
    assert got[12] == (dt.date(2022, 2, 1), 15.0)     # Feb: last known (an extended value)


def test_serving_derivatives_fallbacks(spark):
    rows = [("F", "A", dt.date(2020, m, 1), float(m)) for m in range(1, 6)]
    ext = spark.createDataFrame(rows, "Family string, FIPS string, date date, c double")
    out = FC.serving_derivatives(ext, ["c"]).orderBy("date").collect()
    assert [r["c_lag1"] for r in out] == [1.0, 1.0, 2.0, 3.0, 4.0]
    assert [r["c_chg3m"] for r in out] == [0.0, 0.0, 0.0, 3.0, 3.0]


@pytest.mark.parametrize("max_qty,raw,expected", [(None, 500.0, 500.0), (0.0, 500.0, 500.0),
                                                  (100.0, 500.0, 115.0), (100.0, -5.0, 0.0),
                                                  (-10.0, 5.0, -11.5)])
def test_guardrail(spark, max_qty, raw, expected):
    df = spark.createDataFrame([(max_qty, raw)], "m double, p double")
    got = df.select(FC.clip(F.col("p"), FC.guardrail_hi(F.col("m")))).first()[0]
    assert got == pytest.approx(expected)


def test_recursive_features_partial_windows(spark):
    df = spark.createDataFrame([([4.0, 6.0],)], "h array<double>")
    r = df.select(*[c.alias(k) for k, c in FC.recursive_features(F.col("h"), F.lit(2.0)).items()]).first()
    assert r["fips_lag_1"] == 6.0 and r["fips_lag_3"] == 0.0
    assert r["fips_rollmean_12"] == 5.0
    assert r["fips_rollstd_3"] == pytest.approx(np.std([4.0, 6.0], ddof=1))
    one = spark.createDataFrame([([4.0],)], "h array<double>").select(
        FC.recursive_features(F.col("h"), F.lit(0.0))["fips_rollstd_3"]).first()[0]
    assert one == 0.0


def test_fold_matches_python_loop(spark):
    model = LinearModel("t", {"fips_lag_1": 0.5, "fips_rollmean_3": 0.4, "x": 1.0, "returns_lag_1": 2.0}, 1.0)
    h0 = [10.0, 20.0, 30.0]
    state = spark.createDataFrame([("F", "A", h0, dt.date(2020, 3, 1), 1.5)],
                                  "Family string, FIPS string, h array<double>, last_date date, last_returns double")
    xs = [2.0, -50.0, 3.0]
    his = [None, 10.0, None]
    rows = spark.createDataFrame([("F", "A", dt.date(2020, 4 + i, 1), xs[i], his[i]) for i in range(3)],
                                 "Family string, FIPS string, date date, x double, _hi double")
    got = FC.forecast_linear(state, rows, {"r": model}, start=dt.date(2020, 1, 1), end=dt.date(2021, 1, 1))
    got = [r["Predicted_QTY"] for r in got.orderBy("date").collect()]
    h, ret, exp = list(h0), 1.5, []
    for i in range(3):
        raw = 1.0 + 0.5 * h[-1] + 0.4 * np.mean(h[-3:]) + xs[i] + 2.0 * ret
        p = max(raw, 0.0) if his[i] is None else min(max(raw, 0.0), his[i])
        exp.append(p)
        h.append(p)
        ret = 0.0
    assert got == pytest.approx(exp)


def test_known_or_forecast_sources(spark):
    import datetime as dt
    from panelcast.operators import forecast as FCX
    d = dt.date
    targets = spark.createDataFrame([("F", "00001", d(2024, m, 1)) for m in (1, 2, 3, 4)],
                                    "Family string, FIPS string, date date")
    hist = spark.createDataFrame([("F", "00001", d(2024, 1, 1), 5.0)],   # February missing
                                 "Family string, FIPS string, date date, Sales_QTY double")
    fc = spark.createDataFrame([("F", "00001", "champion", d(2024, 4, 1), 7.5)],
                               "Family string, FIPS string, ModelRole string, date date, Predicted_QTY double")
    out = {(r["date"].month): r for r in FCX.known_or_forecast(
        targets, hist, fc, ["champion"], d(2024, 3, 1)).collect()}
    assert (out[1]["Predicted_QTY"], out[1]["feature_source"]) == (5.0, "historical_actual")
    assert out[2]["Predicted_QTY"] is None and out[2]["feature_source"] == "no_history_row_for_target"
    assert out[3]["feature_source"] == "no_history_row_for_target"
    assert (out[4]["Predicted_QTY"], out[4]["feature_source"]) == (7.5, "model_forecast_recursive_guardrailed")
