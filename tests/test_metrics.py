"""Accuracy metrics edge cases and the quality gate."""

import datetime as dt

import pytest

from panelcast.operators import metrics as M

SCHEMA = ("FIPS string, County_Name string, State string, date date, Actual_QTY double, "
          "Predicted_QTY double, Family string, ModelRole string, ModelName string")


def rows(vals, fips="A"):
    return [(fips, "n", "s", dt.date(2024, i + 1, 1), a, p, "F", "champion", "m")
            for i, (a, p) in enumerate(vals)]


def test_constant_actuals_sst_zero(spark):
    exact = spark.createDataFrame(rows([(5.0, 5.0), (5.0, 5.0)]), SCHEMA)
    off = spark.createDataFrame(rows([(5.0, 4.0), (5.0, 6.0)]), SCHEMA)
    assert M.national_metrics(exact).first()["r2"] == 1.0
    assert M.national_metrics(off).first()["r2"] == 0.0


def test_metrics_values(spark):
    df = spark.createDataFrame(rows([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)]), SCHEMA)
    r = M.national_metrics(df).first()
    assert r["r2"] == pytest.approx(1 - 2 / 8)
    assert r["rmse"] == pytest.approx((2 / 3) ** 0.5)
    assert r["wmape"] == pytest.approx(2 / 9)
    assert r["n_months"] == 3


def test_national_metrics_sum_months_first(spark):
    df = spark.createDataFrame(rows([(1.0, 0.0), (3.0, 4.0)], "A") + rows([(1.0, 2.0), (3.0, 2.0)], "B"), SCHEMA)
    r = M.national_metrics(df).first()
    assert r["r2"] == 1.0  # monthly totals match exactly though rows do not


def test_wmape_null_when_no_volume(spark):
    df = spark.createDataFrame(rows([(0.0, 1.0), (0.0, 2.0)]), SCHEMA)
    assert M.national_metrics(df).first()["wmape"] is None


def test_entity_accuracy_skips_zero_total_and_single_rows(spark):
    df = spark.createDataFrame(rows([(0.0, 1.0), (0.0, 2.0)], "Z") + rows([(4.0, 4.0)], "ONE")
                               + rows([(10.0, 9.0), (20.0, 21.0)], "OK"), SCHEMA)
    out = M.entity_accuracy(df).collect()
    assert [r["FIPS"] for r in out] == ["OK"]
    assert out[0]["Volume_Tier"] == "Low" and out[0]["R2"] == pytest.approx(0.96)


def test_quality_gate_thresholds(spark):
    df = spark.createDataFrame([("a", 0.893, 8415.0), ("b", 0.65, 25000.0)], "k string, r2 double, rmse double")
    got = {r["k"]: r["approved"] for r in M.quality_gate(df).collect()}
    assert got == {"a": True, "b": False}


def test_latest_approved_picks_newest_approved_and_reports_missing(spark):
    import datetime as dt
    from panelcast.operators import metrics as MM
    d = dt.date
    reg = spark.createDataFrame([
        ("f_champion", "v1", d(2024, 1, 1), True), ("f_champion", "v2", d(2024, 2, 1), True),
        ("f_champion", "v3", d(2024, 3, 1), False),   # newer but not approved
        ("o_champion", "v1", d(2024, 1, 1), False)],   # nothing approved
        "group string, version string, created date, approved boolean")
    out = {r["group"]: r for r in MM.latest_approved(reg).collect()}
    assert out["f_champion"]["version"] == "v2" and out["f_champion"]["has_approved"]
    assert out["o_champion"]["version"] is None and not out["o_champion"]["has_approved"]
