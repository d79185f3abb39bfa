"""Entities whose history ends before the panel does are attributed at the forecast start too."""

import copy

import pytest
from pyspark.sql import functions as F

from panelcast.operators import forecast as FC
from panelcast.plans import catalog

SF = "/root/testdata/sf0.001"


def test_attribution_from_the_recursion_state(spark):
    fi = copy.copy(catalog.forecast_inputs(spark, SF))
    fam, fips = fi.state.select("Family", "FIPS").orderBy("Family", "FIPS").first()
    one = (F.col("Family") == fam) & (F.col("FIPS") == fips)
    before = fi.contributed().filter(one).count()
    cut = F.add_months(F.lit(fi.tl.last).cast("date"), -2)
    fi.history = fi.history.filter(one & (F.col("date") <= cut))
    fi.state = FC.history_state(fi.history)
    rows = fi.contributed().collect()
    assert len(rows) == before == 2
    got = {(r.ModelRole, f): v for r in rows for f, v in zip(fi.features, r.vals)}
    preds = {(r.ModelRole.lower(), r.date): r.Predicted_QTY for r in FC.forecast_linear(
        fi.state, fi.rows(FC.horizon_targets(fi.state, fi.tl.last)), catalog.model_spec(), start=fi.tl.first, end=fi.tl.last).collect()}
    for role, m in catalog.model_spec().items():
        assert got[role, "fips_lag_1"] == pytest.approx(m.coefs.get("fips_lag_1", 0.0) * preds[role, fi.tl.last])
        assert got[role, "returns_lag_1"] == 0.0
