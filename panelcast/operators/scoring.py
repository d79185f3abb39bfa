"""Linear scorers: a model given as an intercept plus a coefficient per feature.

A fitted linear model (ridge in scaled space, folded back to raw features)
and the deterministic baselines used by the registered pipeline are both
expressed this way, so scoring, attribution and the recursive forecast stay
plain column arithmetic inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearModel:
    name: str
    coefs: dict[str, float]
    intercept: float = 0.0
    features: tuple[str, ...] = field(default=())

    @property
    def feature_list(self) -> list[str]:
        return list(self.features) if self.features else sorted(self.coefs)

    def score(self, value=None) -> Column:
        """``intercept + sum(coef * coalesce(x, 0))`` (missing -> 0 before scoring)."""
        value = value or (lambda f: F.coalesce(F.col(f), F.lit(0.0)))
        expr = F.lit(float(self.intercept))
        for f in sorted(self.coefs):
            if self.coefs[f] != 0.0:
                expr = expr + F.lit(float(self.coefs[f])) * value(f)
        return expr

    def contributions(self, value=None) -> dict[str, Column]:
        """Per-feature attribution ``coef * x`` (E1)."""
        value = value or (lambda f: F.coalesce(F.col(f), F.lit(0.0)))
        return {f: F.lit(float(c)) * value(f) for f, c in sorted(self.coefs.items())}

    def sql(self, alias: str = "") -> str:
        """Same scorer as a SQL expression (oracle)."""
        pre = f"{alias}." if alias else ""
        terms = [repr(float(self.intercept))]
        for f in sorted(self.coefs):
            if self.coefs[f] != 0.0:
                terms.append(f"{float(self.coefs[f])!r} * coalesce({pre}{f}, 0.0)")
        return "(" + " + ".join(terms) + ")"


# Deterministic model artifacts of the registered pipeline (champion and
# challenger per family). They play the part of a fitted model file so every
# downstream table has an exact SQL oracle; pyspark.ml models plug in the same way.
CHAMPION = LinearModel("LinearBlend", {
    "fips_lag_12": 0.45, "fips_lag_1": 0.25, "fips_rollmean_3": 0.2,
    "CPI_AllUrban": 0.05, "TAVG": 0.02, "Precip_Anomaly": -0.1,
    "CORN_Acres_prior_year": 0.0001, "county_alltime_share": 10.0,
})
CHALLENGER = LinearModel("LinearSensitivity", {
    "fips_lag_12": 0.7, "fips_rollmean_12": 0.3, "CPI_AllUrban": 0.1,
    "Corn_Price_USDPerMT": 0.01, "WTI_Oil_Price": 0.05, "TAVG": 0.05,
    "Precip_Anomaly": -0.05, "CORN_Acres_prior_year": 0.0002,
})
MODEL_SPEC = {"champion": CHAMPION, "challenger": CHALLENGER}
# The what-if sensitivity model: the other roles' scenario deltas come from it.
SENSITIVITY_ROLE = "challenger"
