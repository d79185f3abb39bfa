"""The panel's rows are not sorted for its lookups, and inputs of a pivot are worked out once."""

import datetime as dt
import re

from panelcast.operators import assemble as A
from panelcast.operators import panel as P
from panelcast.sources import bindings as B


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sales(spark):
    rows = [("O", f"{e:05d}", "TEXAS", dt.date(2020, m, 1), float(e + m), 1.0) for e in (1, 2) for m in (1, 2, 4)]
    return spark.createDataFrame(rows, "Family string, FIPS string, State string, date date, `Sales QTY` double, `Returns/Credits QTY` double")


def without_broadcasts(spark, make):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return make()
    finally:
        spark.conf.set(key, before)


def test_grid_is_hashed_not_sorted(spark):
    def run():
        grid = P.monthly_panel(sales(spark), combine_first=False)
        assert "SortMergeJoin" not in plan(grid)
        return {(r.FIPS, r.date.month): r.Sales_QTY for r in grid.collect()}

    assert without_broadcasts(spark, run) == {(f"{e:05d}", m): float(e + m) if m != 3 else 0.0 for e in (1, 2) for m in (1, 2, 3, 4)}


def test_lookups_leave_the_panel_unsorted(spark):
    s = sales(spark)
    month = dt.date(2020, 2, 1)
    weather = spark.createDataFrame([("00001", month, 5.0)], "FIPS string, date date, PRCP double")
    acreage = spark.createDataFrame([("TEXAS", 2020, "00002", 7.0)], "State string, Year int, FIPS string, CORN_Acres_prior_year double")
    econ = spark.createDataFrame([(month, 3.0)], "date date, CPI_AllUrban double")
    names = spark.createDataFrame([("00001", "One")], "FIPS string, County_Name string")

    def run():
        monthly = P.monthly_panel(s, combine_first=False)
        inner = P.internal_features(monthly, P.national_series(s))
        made = A.assemble(inner, weather, acreage, econ, names, P.family_months(s), dt.date(2020, 3, 1), monthly=monthly)
        sorted_for = {re.sub(r"#\d+", "", keys) for keys in re.findall(r"SortMergeJoin \[([^]]*)\]", plan(made))}
        assert sorted_for <= {"date", "Family, FIPS"}  # the calendar's series, and one row per entity
        return {(r.FIPS, r.date.month): r for r in made.collect()}

    rows = without_broadcasts(spark, run)
    assert len(rows) == 8
    assert [rows["00001", m].PRCP for m in (1, 2)] == [None, 5.0]
    assert {rows["00002", m].CORN_Acres_prior_year for m in range(1, 5)} == {7.0}
    assert (rows["00001", 3].County_Name, rows["00002", 3].County_Name) == ("One", None)
    assert abs(rows["00001", 1].county_alltime_share - 5 / 12) < 1e-12


def test_series_are_written_before_they_become_columns(spark, tmp_path):
    month = dt.datetime(2020, 2, 3)
    orders = [(1000.0, month, "1-URGENT"), (3000.0, month, "1-URGENT"), (5000.0, dt.datetime(2020, 3, 1), "5-LOW")]
    spark.createDataFrame(orders, "o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    macro = B.economic_macro(spark, str(tmp_path))
    assert "orders.parquet" not in " ".join(macro.inputFiles())
    found = {r.date.month: (r.CPI_AllUrban, r.Orders_5_LOW) for r in macro.collect()}
    assert found == {2: (2.0, None), 3: (None, 5.0)}
