"""Request parsing, validation, change resolution."""

import pytest
from pyspark.sql import functions as F

from panelcast.operators import requests as RQ

FEATURES = ["CPI_AllUrban", "TAVG", "fips_lag_1"]


def test_change_resolution(spark):
    df = spark.createDataFrame([('{"CPI": {"type": "percent", "value": 10}, "TAVG": {"type": "absolute", "value": 1},'
                                 ' "OilPrice": {"value": 3}, "Nope": {"value": 1}, "GDD": {"value": 1}}',)], "v string")
    m = df.select(F.from_json("v", "map<string, struct<type:string, value:double>>").alias("m"))
    got = m.select(RQ.resolve_changes(F.col("m"), FEATURES).alias("c")).first()["c"]
    res = {e["key"]: (e["feature"], e["type"]) for e in got}
    assert res["CPI"] == ("CPI_AllUrban", "percent")          # alias
    assert res["TAVG"] == ("TAVG", "absolute")                # raw feature
    assert res["OilPrice"] == (None, "percent")               # alias to a feature the model lacks
    assert res["Nope"][0] is None and res["GDD"][0] is None   # unknown / known unsupported


def test_parse_and_validate(spark):
    raw = spark.createDataFrame([
        ("1", '{"family": "F", "fips": "17", "month": 3, "year": 2025}'),
        ("2", '{"family": "Q", "fips": "17", "month": 3, "year": 2025}'),
        ("3", '{"family": "F", "fips": "17", "month": 13, "year": 2025}'),
        ("4", '{"family": "F", "month": 3, "year": 2025}'),
        ("5", 'not json'),
    ], "request_id string, value string")
    fams = spark.createDataFrame([("F",)], "Family string")
    out = {r["request_id"]: r["error"] for r in RQ.validate(RQ.parse_requests(raw), fams).collect()}
    assert out["1"] is None
    assert out["2"].startswith("unknown family")
    assert out["3"] == "month is a number from 1 to 12"
    assert out["4"].startswith("an entity is named by")
    assert out["5"] == "malformed request"


def test_target_month_is_null_safe(spark):
    df = spark.createDataFrame([(2025, 13), (2025, 2)], "y int, m int")
    got = [r[0] for r in df.select(RQ.target_month(F.col("y"), F.col("m"))).collect()]
    assert got[0] is None and str(got[1]) == "2025-02-01"


def test_request_plans_stay_small(spark):
    from conftest import SF_TINY
    from panelcast.plans import catalog as C

    plans = [C.QUERIES[q](spark, SF_TINY)._jdf.queryExecution().analyzed().toString() for q in ("scenario_what_if", "response_documents")]
    # the requests are resolved, folded and moved in steps of their own: what is left is joined from their tables
    assert max(p.count("Join ") for p in plans) <= 8
