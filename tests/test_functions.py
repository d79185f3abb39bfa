"""Scalar expressions against the hand-made inputs (fixtures for each trap)."""

import datetime as dt

from pyspark.sql import functions as F

from panelcast.functions import calendar, features, fiscal, ids, tiers, weather


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_normalize_id_pads_strips_and_never_truncates(spark):
    df = spark.createDataFrame([("1234",), ("12345",), ("1234.0",), (" 12.0 ",), ("7",), ("123456",),
                                ("1.05.0",), (None,)], "v string")
    got = [r[0] for r in df.select(ids.normalize_id(F.col("v"))).collect()]
    assert got == ["01234", "12345", "01234", "00012", "00007", "123456", "01.05", None]


def test_normalize_numeric_id(spark):
    assert one(spark, ids.normalize_id(F.col("v")), 1234, "v int") == "01234"


def test_null_id_is_rejected(spark):
    assert one(spark, ids.id_error(F.col("v")), None) == "id is required"
    assert one(spark, ids.id_error(F.col("v")), "17") is None


def test_calendar_features_march(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 1),)], "d date")
    r = df.select(*[c.alias(k) for k, c in calendar.calendar_columns(F.col("d")).items()]).first()
    assert (r["calendar_month"], r["quarter"], r["is_planting_season"], r["is_harvest_season"]) == (3, 1, 1, 0)
    assert r["fiscal_month_idx"] == 6


def test_fiscal_index_uses_positive_modulo(spark):
    df = spark.range(1, 13).select(calendar.fiscal_month_index(F.col("id").cast("int")).alias("f"))
    assert [r[0] for r in df.collect()] == [4, 5, 6, 7, 8, 9, 10, 11, 12, 1, 2, 3]


def test_growing_season_proxy_never_negative(spark):
    df = spark.createDataFrame([(dt.date(2024, m, 1),) for m in range(1, 13)], "d date")
    vals = [r[0] for r in df.select(calendar.calendar_columns(F.col("d"))["growing_season_proxy"]).collect()]
    assert min(vals) == 0.0 and max(vals) > 0.9


def test_fiscal_labels(spark):
    df = spark.createDataFrame([("F2014", "OCTOBER"), ("F2014", "MARCH"), ("F2014", "march"),
                                ("X", "MARCH"), ("F2014", "SMARCH")], "y string, m string")
    got = [r[0] for r in df.select(fiscal.fiscal_to_date(F.col("y"), F.col("m"))).collect()]
    assert got == [dt.date(2013, 10, 1), dt.date(2014, 3, 1), None, None, None]
    up = [r[0] for r in df.select(fiscal.fiscal_to_date(F.col("y"), F.col("m"), case_sensitive=False)).collect()]
    assert up[2] == dt.date(2014, 3, 1)


def test_tolerant_number(spark):
    df = spark.createDataFrame([("1,200",), ("(D)",), (None,), ("12",)], "v string")
    assert [r[0] for r in df.select(weather.tolerant_number(F.col("v"))).collect()] == [1200.0, None, None, 12.0]


def test_weather_proxies_keep_nulls(spark):
    df = spark.createDataFrame([(None, 80.0, None), (60.0, 80.0, 50.0), (40.0, None, None)],
                               "tavg double, tmax double, tmin double")
    r = df.select(weather.gdd_proxy(F.col("tavg")).alias("g"),
                  weather.chu_proxy(F.col("tmax"), F.col("tmin")).alias("c"),
                  weather.presence_flag(F.col("tavg")).alias("p")).collect()
    assert r[0]["g"] is None and r[0]["c"] is None and r[0]["p"] == 0.0
    assert r[1]["g"] == 10.0 and r[1]["c"] > 0 and r[1]["p"] == 1.0
    assert r[2]["g"] == 0.0


def test_external_feature_names():
    assert features.outside_features(["fips_lag_1", "CPI_AllUrban", "county_alltime_share", "TAVG"]) == \
        ["CPI_AllUrban", "TAVG"]
    assert features.outside_features(["CPI_AllUrban", "CPI_AllUrban_lag1", "TAVG"], derived=False) == \
        ["CPI_AllUrban", "TAVG"]


def test_panel_projection_keeps_static_and_drops_year():
    cols = ["FIPS", "date", "Year", "b_feat", "a_feat", "Sales_QTY", "Family"]
    out = features.panel_columns(cols)
    assert out == ["FIPS", "Family", "date", "Sales_QTY", "a_feat", "b_feat"]


def test_tiers(spark):
    df = spark.createDataFrame([(5.0, 0.9), (50.0, 0.9), (500.0, 0.9), (5000.0, 0.1), (5000.0, -2.0),
                                (5000.0, 0.5)], "t double, r2 double")
    out = df.select(tiers.volume_tier(F.col("t")).alias("v"), tiers.r2_category(F.col("r2")).alias("c"))
    out = out.select("v", "c", tiers.confidence_tier(F.col("v"), F.col("c")).alias("k")).collect()
    assert [r["v"] for r in out] == ["Near-zero", "Low", "Moderate", "Established", "Established", "Established"]
    assert [r["k"] for r in out] == ["Directional Only (Low Volume)", "Directional Only (Low Volume)",
                                     "High Confidence", "Moderate Confidence", "Low Confidence",
                                     "High Confidence"]


def test_friendly_names(spark):
    df = spark.createDataFrame([("TAVG",), ("new_feature",)], "Feature string")
    got = [r["Friendly_Name"] for r in features.with_friendly_name(df).orderBy("Feature").collect()]
    assert got == ["Average Temperature", "new_feature"]
