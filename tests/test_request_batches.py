"""A request's answer depends on nothing else in its batch."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from panelcast.operators import forecast as FC
from panelcast.operators import models as MD
from panelcast.operators import requests as RQ
from panelcast.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fi(spark):
    return catalog.forecast_inputs(spark, SF)


def answers(fi, spark, requests):
    raw = spark.createDataFrame([(i, json.dumps(r)) for i, r in requests], "request_id string, value string")
    return [r.asDict(recursive=True) for r in catalog.score_request_table(fi, raw).collect()]


def test_alone_as_in_a_batch(fi, spark):
    fam, fips = fi.static.select("Family", "FIPS").orderBy("Family", "FIPS").first()
    last = fi.tl.last
    base = {"family": fam, "fips": fips}
    past = {"month": last.month, "year": last.year}
    ahead = {"month": str(fi.tl.forecast_end.month), "year": str(fi.tl.forecast_end.year)}
    kinds = {
        "past": base | past,
        "ahead": base | ahead,
        "past_scenario": base | past | {"scenario": True, "feature_changes": {"CPI": {"type": "percent", "value": 10}}},
        "explain": base | ahead | {"explain": True},
        "unknown": {"family": fam, "fips": "99999", "month": 1, "year": 1950},
        "beyond": base | {"month": 2, "year": last.year + 9},
        "far": base | {"month": 1, "year": last.year + 250},
    }
    together = {r["request_id"]: r for r in answers(fi, spark, [*kinds.items(), ("explain", kinds["explain"])])}
    for kind in ("past", "past_scenario"):
        assert answers(fi, spark, [(kind, kinds[kind])]) == [together[kind]]
    alone = together
    assert alone["past"]["feature_source"] == "historical_actual" and alone["past"]["champion_predicted_qty"] is not None
    assert alone["past_scenario"]["champion_predicted_qty"] is not None
    assert alone["unknown"]["feature_source"] == "no_history_row_for_target" and alone["unknown"]["champion_predicted_qty"] is None
    assert alone["beyond"]["champion_predicted_qty"] is not None
    assert alone["far"]["error"] is None and alone["far"]["champion_predicted_qty"] is not None
    assert alone["ahead"]["error"] is None and len(alone["explain"]["feature_importance"]) == 5


def test_equal_requests_are_answered_each_once(fi, spark):
    fam, fips = fi.static.select("Family", "FIPS").orderBy("Family", "FIPS").first()
    one = {"family": fam, "fips": fips, "month": 1, "year": fi.tl.last.year + 1, "explain": True}
    got = answers(fi, spark, [("a", one), ("a", one), ("b", one), ("a", one | {"month": 2})])
    assert sorted((r["request_id"], r["month"]) for r in got) == [("a", 1), ("a", 1), ("a", 2), ("b", 1)]


def test_three_thousand_months_ahead_equals_the_fold_in_columns(fi, spark):
    fam, fips = fi.static.select("Family", "FIPS").orderBy("Family", "FIPS").first()
    target = fi.tl.add_months(fi.tl.last, 3000)
    got = answers(fi, spark, [("x", {"family": fam, "fips": fips, "month": target.month, "year": target.year})])[0]
    one = (F.col("Family") == fam) & (F.col("FIPS") == fips)
    ext = FC.serving_derivatives(FC.extend_external(fi.ext_base.filter(one), fi.ext_cols, target), fi.econ_cols)
    state = fi.state.filter(one)
    rows = FC.serving_rows(FC.horizon_targets(state, target), ext, fi.static, fi.national, fi.bounds)
    want = {r.ModelRole: r.Predicted_QTY for r in FC.forecast_linear(state, rows, catalog.model_spec(), start=target, end=target).collect()}
    assert len(want) == 2
    for role, value in want.items():
        assert got[f"{role}_predicted_qty"] == pytest.approx(value, abs=1e-4)


def test_registry_has_every_full_window(fi, spark):
    months = fi.panel.select(F.months_between(F.max("date"), F.min("date"))).first()[0] + 1
    runs = catalog.model_registry(fi, catalog.panel(spark, SF)).groupBy("group").count().collect()
    assert runs and all(r["count"] == int(months) - 11 for r in runs)


def test_fitted_models_answer_alone_as_in_a_batch(fi, spark):
    """What-ifs of the trees move by the ridge; the ridge's own by itself."""
    models = MD.fit_all(fi.panel, fi.features, {k: (replace(v, trees=5) if v != "ridge" else v) for k, v in MD.LEARNERS.items()})
    (fam, fips), (fam2, fips2) = fi.static.select("Family", "FIPS").orderBy("FIPS", "Family").limit(2).collect()
    month = fi.tl.add_months(fi.tl.last, 4)
    base = {"family": fam, "fips": fips, "month": month.month, "year": month.year}
    change = {"scenario": True, "feature_changes": {"TAVG": {"type": "absolute", "value": 3.0}}}
    asked = [("plain", base), ("none", base | {"scenario": True, "feature_changes": {}}), ("up", base | change),
             ("other", base | {"family": fam2, "fips": fips2, "explain": True})]

    def score(some):
        raw = spark.createDataFrame([(i, json.dumps(r)) for i, r in some], "request_id string, value string")
        return {r.request_id: r.asDict(recursive=True) for r in catalog.score_request_table(fi, raw, models).collect()}

    together = score(asked)
    assert score(asked[2:3])["up"] == together["up"] and score(asked[3:])["other"] == together["other"]
    assert {together["plain"][f"{r}_model"] for r in models.roles} == {models.models[fam, r][0] for r in models.roles}
    for role in models.roles:
        assert together["none"][f"{role}_predicted_qty"] == pytest.approx(together["plain"][f"{role}_predicted_qty"], abs=1e-4)
    coef = models.models[fam, "challenger"][1].coef[models.features.index("TAVG")]
    hi = fi.rows(spark.createDataFrame([(fam, fips, month)], "Family string, FIPS string, date date")).first()["_hi"]
    for role in models.roles:
        free = together["plain"][f"{role}_predicted_qty"]
        if 0 < free < (hi or 1e18):
            want = min(max(free + 3.0 * coef, 0.0), hi or 1e18)
            assert together["up"][f"{role}_predicted_qty"] == pytest.approx(want, abs=2e-4)
    assert len(together["other"]["feature_importance"]) == 5


def test_documents_leave_out_what_was_not_asked_for(fi, spark):
    fam, fips = fi.static.select("Family", "FIPS").orderBy("Family", "FIPS").first()
    month = fi.tl.add_months(fi.tl.last, 2)
    base = {"family": fam, "fips": fips, "month": month.month, "year": month.year}
    raw = spark.createDataFrame([(i, json.dumps(r)) for i, r in [
        ("plain", base), ("explain", base | {"explain": True}), ("bad", base | {"month": 13}),
        ("scenario", base | {"scenario": True, "feature_changes": {"TAVG": {"value": 5}, "Nope": {"value": 1}}})]], "request_id string, value string")
    models = catalog.spec_models(fi)
    docs = {r.request_id: json.loads(r.document) for r in RQ.response_documents(catalog.score_request_table(fi, raw, models), models.roles).collect()}
    always = {"family", "fips", "month", "year", "features_found", "county_data_quality", "county_active_months", "champion", "challenger"}
    assert set(docs["plain"]) == always | {"feature_source"}
    assert set(docs["plain"]["champion"]) == {"model_name", "predicted_qty"}
    assert set(docs["explain"]) == always | {"feature_source", "feature_importance", "external_factors_share_pct"}
    assert [set(d) for d in docs["explain"]["feature_importance"]] == [{"feature", "shap_value"}] * 5
    assert set(docs["scenario"]) == always | {"scenario_features", "unsupported_feature_changes"}
    assert docs["scenario"]["unsupported_feature_changes"] == ["Nope"]
    assert set(docs["scenario"]["scenario_features"]["TAVG"]) == {"before", "after", "type", "value"}
    assert set(docs["bad"]) == {"family", "fips", "month", "year", "error"}
