"""Scans read back what the sinks wrote, with ids as text."""

import pytest
from pyspark.sql import functions as F

from panelcast.sources import scans, sinks


def test_delimited_round_trip(spark, tmp_path):
    rows = [("01001", "2024-03-01", "PRCP", 1.5), ("2", "2024-04-01", "TAVG", None), ("x,y", None, "a\"b", -2.0)]
    df = spark.createDataFrame(rows, "FIPS string, date string, datatype string, value double").withColumn("date", F.to_date("date"))
    path = sinks.write_csv(df, str(tmp_path / "weather"))
    got = scans.read_delimited(spark, path, "weather")
    assert got.schema == df.schema
    assert sorted(got.collect(), key=str) == sorted(df.collect(), key=str)


def test_padded_header_and_tabs(spark, tmp_path):
    (tmp_path / "g.tsv").write_text("USPS\tGEOID \t NAME   \nAL\t01001\tAutauga County\nAL\t01003\t\n")
    got = scans.read_delimited(spark, str(tmp_path / "g.tsv"), "gazetteer", sep="\t").collect()
    assert [(r.GEOID, r.NAME) for r in got] == [("01001", "Autauga County"), ("01003", None)]
    with pytest.raises(KeyError, match="County"):
        scans.read_delimited(spark, str(tmp_path / "g.tsv"), "county_dimension", sep="\t")


def test_series_and_panel(spark, tmp_path):
    (tmp_path / "m.csv").write_text("date, CPI ,Oil\n2024-03-17,1.5,x\n2024-04-30,,2\n")
    got = scans.read_series(spark, str(tmp_path / "m.csv")).collect()
    assert [(str(r.date), r.CPI, r.Oil) for r in got] == [("2024-03-01", 1.5, None), ("2024-04-01", None, 2.0)]
    panel = spark.createDataFrame([("7", "F", "2024-03-09", True, 1.0, 2.0)], "FIPS string, Family string, date string, flag boolean, b double, a double")
    path = sinks.write_parquet(panel.withColumn("date", F.to_date("date")), str(tmp_path / "p"))
    sinks.write_record(spark, {"features": ["b", "flag", "a"]}, str(tmp_path / "f"))
    features = scans.read_features(spark, str(tmp_path / "f"))
    back = scans.read_panel(spark, path, features)
    assert back.columns[-3:] == ["b", "flag", "a"]
    assert [tuple(map(str, r)) for r in back.collect()] == [("00007", "F", "2024-03-01", "1.0", "1", "2.0")]


def test_documents(spark, tmp_path):
    df = spark.createDataFrame([("f_champion", 0.5, None)], "key string, r2 double, wmape double")
    text = sinks.evaluation_document(df).first()[0]
    assert text == '{"f_champion":{"r2":0.5,"wmape":"N/A"}}'
    (tmp_path / "ok.json").write_text('{"r2": 1}')
    (tmp_path / "bad.json").write_text('{"r2": ')
    paths = {"a": str(tmp_path / "ok.json"), "b": str(tmp_path / "bad.json"), "c": str(tmp_path / "none.json")}
    with pytest.raises(FileNotFoundError, match=r"missing: \['c'\]; unreadable: \['b'\]"):
        sinks.read_metric_documents(spark, paths)
    assert sinks.read_metric_documents(spark, {"a": paths["a"]}).first()["key"] == "a"
