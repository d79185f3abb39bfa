"""Panel invariants and window traps on hand-made fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import panel as P
from panelcast.operators import static as S


def months(n, start=(2020, 1)):
    y, m = start
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out


@pytest.fixture
def sales(spark):
    rows = []
    # entity A: 4 months of sales; entity B: all-zero months; entity C only in the middle
    for i, d in enumerate(months(4)):
        rows.append(("A", "S1", "X", d, float(i + 1), 0.0))
    rows.append(("B", "S1", "X", months(1)[0], 0.0, 0.0))
    rows.append(("B", "S1", "X", months(4)[3], 0.0, 0.0))
    rows.append(("C", "S2", "X", months(3)[2], 5.0, 1.0))
    return spark.createDataFrame(rows, "FIPS string, State string, Family string, date date, "
                                       "`Sales QTY` double, `Returns/Credits QTY` double")


def test_grid_is_dense_and_zero_filled(spark, sales):
    p = P.monthly_panel(sales)
    assert p.count() == 3 * 4
    c = p.filter("FIPS = 'C'").orderBy("date").select("Sales_QTY").collect()
    assert [r[0] for r in c] == [0.0, 0.0, 5.0, 0.0]


def test_short_series_rolling_needs_full_window(spark, sales):
    p = P.add_rolling(P.add_lags(P.monthly_panel(sales)))
    a = p.filter("FIPS = 'A'").orderBy("date").collect()
    assert [r["fips_lag_1"] for r in a] == [None, 1.0, 2.0, 3.0]
    assert [r["fips_lag_12"] for r in a] == [None] * 4
    assert [r["fips_rollmean_3"] for r in a] == [None, None, None, 2.0]
    assert a[3]["fips_rollstd_3"] == pytest.approx(1.0)
    assert all(r["fips_rollmean_6"] is None for r in a)


def test_static_shares_zero_totals_and_sum(spark, sales):
    p = P.monthly_panel(sales)
    sh = S.static_shares(p, dt.date(2020, 4, 1)).collect()
    by = {r["FIPS"]: r for r in sh}
    assert by["B"]["county_alltime_share"] == 0.0 and by["B"]["county_is_sparse"] == 1
    assert sum(r["county_alltime_share"] for r in sh) == pytest.approx(1.0)
    assert by["A"]["county_active_months"] == 4.0


def test_static_shares_all_zero_family(spark):
    df = spark.createDataFrame([("Z", "S", "Q", dt.date(2020, 1, 1), 0.0, 0.0)],
                               "FIPS string, State string, Family string, date date, "
                               "`Sales QTY` double, `Returns/Credits QTY` double")
    r = S.static_shares(P.monthly_panel(df), dt.date(2020, 1, 1)).first()
    assert (r["county_alltime_share"], r["state_share"], r["county_is_sparse"]) == (0.0, 0.0, 1)


def test_features_are_leakage_safe(spark, sales):
    """Changing sales at month t must not change any lag/rolling feature at month t."""
    base = P.add_rolling(P.add_lags(P.monthly_panel(sales)))
    bumped_sales = sales.withColumn("Sales QTY", F.when((F.col("FIPS") == "A") & (F.col("date") == dt.date(2020, 3, 1)),
                                                        F.lit(100.0)).otherwise(F.col("Sales QTY")))
    bumped = P.add_rolling(P.add_lags(P.monthly_panel(bumped_sales)))
    cols = [c for c in base.columns if c.startswith("fips_")]
    a = base.filter("FIPS = 'A' AND date <= '2020-03-01'").orderBy("date").select(cols).collect()
    b = bumped.filter("FIPS = 'A' AND date <= '2020-03-01'").orderBy("date").select(cols).collect()
    assert a == b


def test_national_features_are_row_based(spark, sales):
    nat = P.national_features(P.national_series(sales)).orderBy("date").collect()
    assert [r["national_lag_1"] for r in nat] == [None, 1.0, 2.0, 8.0]
    assert nat[3]["national_rollmean_3"] == pytest.approx((1.0 + 2.0 + 8.0) / 3)
