"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and oracle SQL.

Every query reads the shared tables (through :mod:`panelcast.sources.bindings`)
and runs its operator over the whole data. ``ORACLES[name]`` is the DuckDB
statement computing the same result; queries without one get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.features import REGISTRY, model_features, series_behind
from panelcast.operators import assemble as A
from panelcast.operators import attribution as AT
from panelcast.operators import reporting as R
from panelcast.operators import forecast as FC
from panelcast.operators import lookups as L
from panelcast.operators import metrics as M
from panelcast.operators.scoring import MODEL_SPEC
from panelcast.operators import external as X
from panelcast.operators import panel as P
from panelcast.operators import static as S
from panelcast.plans.common import fin, rounded, rsql, timeline
from panelcast.plans.oracle_sql import sql_with
from panelcast.session import materialize
from panelcast.sources import bindings as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- shared builders

# Stage outputs of one application, like the files a batch pipeline writes
# between steps: built (and checkpointed) once per input folder, then read by
# every later query of the same Spark application.
_STAGES: dict[tuple, object] = {}


def stage(spark: SparkSession, sf: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    if key not in _STAGES:
        _STAGES[key] = build()
    return _STAGES[key]


def clear_stages() -> None:
    _STAGES.clear()


def sales(spark: SparkSession, sf: str, sparse: bool = False) -> DataFrame:
    """Parsed sales rows, materialised: every later step reads them several times.

    The binding already aggregated line items to one row per (family,
    entity, month), so the panel shuffles these rows by entity directly.
    """
    def build():
        raw = B.raw_sales_sparse(spark, sf) if sparse else B.raw_sales(spark, sf)
        return materialize(P.load_raw(raw))
    return stage(spark, sf, "sales_sparse" if sparse else "sales", build)


def panel(spark: SparkSession, sf: str, sparse: bool = False) -> DataFrame:
    return P.monthly_panel(sales(spark, sf, sparse), combine_first=False)


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """The dense monthly panel, materialised: features, shares and their totals all read it."""
    return stage(spark, sf, "monthly", lambda: materialize(panel(spark, sf), "monthly"))


def internal(spark: SparkSession, sf: str, s: DataFrame | None = None) -> DataFrame:
    s = s if s is not None else sales(spark, sf)
    return P.internal_features(monthly(spark, sf).repartition("FIPS"), P.national_series(s))


# ---------------------------------------------------------------- stage 1: panel

@register("sales_fiscal_dates", fin(sql_with("sales", """SELECT Family, "Year", "Month", fy, m, calendar_year, date,
  count(*) AS n_rows, sum("Sales QTY") AS sales_qty, sum("Returns/Credits QTY") AS returns_qty
FROM sales GROUP BY ALL"""), doubles=["sales_qty", "returns_qty"]))
def q_sales_fiscal_dates(spark, sf):
    s = sales(spark, sf)
    return rounded(s.groupBy("Family", "Year", "Month", "fy", "m", "calendar_year", "date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("Sales QTY").alias("sales_qty"),
        F.sum("Returns/Credits QTY").alias("returns_qty")))


@register("entity_id_normalize", sql_with("raw_sales", """SELECT DISTINCT FIPS AS FIPS_raw,
  CASE WHEN length(s) < 5 THEN lpad(s, 5, '0') ELSE s END AS FIPS
FROM (SELECT FIPS, regexp_replace(trim(FIPS), '\\.0$', '') AS s FROM raw_sales) x"""))
def q_entity_id_normalize(spark, sf):
    from panelcast.functions.ids import normalize_id
    raw = B.raw_sales(spark, sf).select(F.col("FIPS").alias("FIPS_raw")).distinct()
    return raw.withColumn("FIPS", normalize_id(F.col("FIPS_raw")))


@register("sales_rejects", sql_with("sales", """SELECT reason, n_rejected, n_rows FROM (
  SELECT count(*) AS n_rows, count(*) FILTER (WHERE FIPS IS NULL OR trim(FIPS) = '') AS entity_id,
         count(*) FILTER (WHERE date IS NULL) AS "month" FROM sales) c
UNPIVOT (n_rejected FOR reason IN (entity_id, "month"))"""))
def q_sales_rejects(spark, sf):
    return P.rejects(sales(spark, sf))


@register("panel_grid", fin(sql_with("panel", "SELECT * FROM panel"),
                             doubles=["Sales_QTY", "Returns_QTY"]))
def q_panel_grid(spark, sf):
    return rounded(panel(spark, sf))


@register("panel_grid_sparse", fin(sql_with("sp_panel", "SELECT * FROM sp_panel"),
                                   doubles=["Sales_QTY", "Returns_QTY"]))
def q_panel_grid_sparse(spark, sf):
    return rounded(panel(spark, sf, sparse=True))


_LAGS = ["fips_lag_1", "fips_lag_2", "fips_lag_3", "fips_lag_6", "fips_lag_12", "returns_lag_1"]
_ROLLS = [f"fips_roll{s}_{k}" for k in (3, 6, 12) for s in ("mean", "std")]
_CAL_D = ["month_sin", "month_cos", "fiscal_sin", "fiscal_cos", "growing_season_proxy"]
_CAL_I = ["calendar_month", "quarter", "fiscal_month_idx", "is_planting_season",
          "is_application_season", "is_harvest_season", "is_dormant_season", "time_idx"]
_NAT = ["national_lag_1", "national_lag_12", "national_rollmean_3"]


@register("panel_lags", fin(sql_with("internal", "SELECT Family, FIPS, date, "
                                     + ", ".join(_LAGS) + " FROM internal"), doubles=_LAGS))
def q_panel_lags(spark, sf):
    return rounded(internal(spark, sf).select("Family", "FIPS", "date", *_LAGS))


@register("panel_rolling", fin(sql_with("internal", "SELECT Family, FIPS, date, "
                                        + rsql(*_ROLLS) + " FROM internal")))
def q_panel_rolling(spark, sf):
    return rounded(internal(spark, sf).select("Family", "FIPS", "date", *_ROLLS))


@register("calendar_features", fin(sql_with("internal", "SELECT Family, FIPS, date, "
                                            + ", ".join(_CAL_I) + ", " + rsql(*_CAL_D)
                                            + " FROM internal")))
def q_calendar_features(spark, sf):
    return rounded(internal(spark, sf).select("Family", "FIPS", "date", *_CAL_I, *_CAL_D))


@register("national_features", fin(sql_with("national_feats", "SELECT Family, date, "
                                            + rsql(*_NAT) + " FROM national_feats")))
def q_national_features(spark, sf):
    return rounded(P.national_features(P.national_series(sales(spark, sf))))


_STATIC = ["county_alltime_share", "county_recent_share", "state_share", "county_active_months"]


@register("static_shares", fin(sql_with("static", "SELECT Family, FIPS, State, county_is_sparse, "
                                        + rsql(*_STATIC, digits=9) + " FROM static"), dates=()))
def q_static_shares(spark, sf):
    s = sales(spark, sf)
    tl = stage(spark, sf, "timeline", lambda: timeline(s))
    sh = S.static_shares(P.monthly_panel(s), tl.train_cutoff)
    return rounded(sh, 9)


# ---------------------------------------------------------------- stage 2: external tables

_WEATHER = ["PRCP", "TAVG", "TMAX", "TMIN", "GDD_proxy", "CHU_proxy", "Precip_Anomaly",
            "has_temperature_data"]
# columns of the test tables whose rounding the checks fix; the queries take crops and series as found
_CROPS = ["CORN", "COTTON", "SOYBEANS", "WHEAT", "MEDIUM", "LARGE"]
_ACRES = [f"{c}_Acres_prior_year" for c in _CROPS]
_ECON = ["CPI_AllUrban", "Fertilizer_PPI", "WTI_Oil_Price", "Cotton_Price_USCentsPerLb", "Corn_Price_USDPerMT",
         "Soybeans_Price_USDPerMT", "Wheat_Price_USDPerMT", "Orders_4_NOT_SPECIFIED", "Orders_5_LOW", "Medium_Price", "Large_Price"]
_ECON_CHG = [f"{c}_{s}" for c in _ECON for s in ("lag1", "chg3m")]


def weather(spark, sf):
    return X.weather_features(B.weather_long(spark, sf))


def acreage(spark, sf, s=None):
    s = s if s is not None else sales(spark, sf)
    # states x years x crops, written once: the crops are looked up before they become columns
    return X.acreage_prior_year(materialize(B.acreage_long(spark, sf), "acreage"), P.entity_state_years(s))


def names(spark, sf):
    return X.entity_names(B.county_dimension(spark, sf), B.gazetteer(spark, sf))


def econ(spark, sf):
    return X.economic(B.economic_macro(spark, sf), B.crop_prices(spark, sf))


def full_panel(spark, sf, cutoff=None):
    """The assembled feature panel (stage 1 output), materialised once per cutoff."""
    s = sales(spark, sf)
    cutoff = cutoff or stage(spark, sf, "timeline", lambda: timeline(s)).train_cutoff

    def build():
        inner = internal(spark, sf, s)
        return materialize(A.assemble(inner, weather(spark, sf), acreage(spark, sf, s),
                                      econ(spark, sf), names(spark, sf), P.family_months(s), cutoff,
                                      monthly=monthly(spark, sf)))
    return stage(spark, sf, f"panel@{cutoff}", build)


@register("shares_by_month", fin(sql_with("shares_any", "SELECT * FROM shares_any"), digits=9, dates=("as_of",), doubles=_STATIC))
def q_shares_by_month(spark, sf):
    """Static shares as of every month of the panel."""
    return rounded(S.shares_by_month(monthly(spark, sf)), 9)


@register("weather_pivot", fin(sql_with("wpiv", "SELECT * FROM wpiv"),
                               doubles=["PRCP", "TAVG", "TMAX", "TMIN"]))
def q_weather_pivot(spark, sf):
    return rounded(X.weather_pivot(B.weather_long(spark, sf)))


@register("weather_features", fin(sql_with("weather", "SELECT * FROM weather"), doubles=_WEATHER))
def q_weather_features(spark, sf):
    return rounded(weather(spark, sf))


@register("acreage_prior_year", fin(sql_with("acreage", "SELECT * FROM acreage"),
                                    doubles=_ACRES, dates=()))
def q_acreage_prior_year(spark, sf):
    return rounded(acreage(spark, sf))


@register("county_names", sql_with("names", "SELECT * FROM names"))
def q_county_names(spark, sf):
    return names(spark, sf)


@register("economic_join", fin(sql_with("econ", "SELECT * FROM econ"), doubles=_ECON))
def q_economic_join(spark, sf):
    return rounded(econ(spark, sf))


@register("economic_changes", fin(sql_with("merged", "SELECT Family, FIPS, date, "
                                           + ", ".join(_ECON + _ECON_CHG) + " FROM merged"),
                                  doubles=_ECON + _ECON_CHG))
def q_economic_changes(spark, sf):
    fp = full_panel(spark, sf)
    series = [f.name for f in REGISTRY.model(fp.columns) if f.group == "series"]
    return rounded(fp.select("Family", "FIPS", "date", *series))


_FULL_D = (["Sales_QTY", "Returns_QTY"] + _CAL_D + _LAGS + _ROLLS + _NAT + _WEATHER + _ACRES
           + _ECON + _ECON_CHG + _STATIC)


@register("panel_full", fin(sql_with("full_panel", "SELECT * FROM full_panel"),
                            doubles=_FULL_D))
def q_panel_full(spark, sf):
    return rounded(full_panel(spark, sf))


# ---------------------------------------------------------------- stage 3: holdout + metrics

def model_spec(family: str | None = None) -> dict:
    """(family, role) -> model; the same two linear artifacts serve both families."""
    return MODEL_SPEC


def holdout(spark, sf):
    """(timeline, train, val, validation predictions for every role)."""
    s = sales(spark, sf)
    tl = stage(spark, sf, "timeline", lambda: timeline(s))
    fp = full_panel(spark, sf, tl.train_cutoff)
    train, val = M.split(fp, tl.train_cutoff, tl.val_start, tl.val_end)
    roles = F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), F.lit(m.name).alias("name"),
                 F.greatest(m.score(), F.lit(0.0)).alias("pred"))
        for role, m in model_spec().items()])).alias("r")
    preds = val.select("FIPS", "County_Name", "State", "date", "Family",
                       F.col("Sales_QTY").alias("Actual_QTY"), roles).select(
        "FIPS", "County_Name", "State", "date", "Actual_QTY",
        F.col("r.pred").alias("Predicted_QTY"), "Family",
        F.col("r.role").alias("ModelRole"), F.col("r.name").alias("ModelName"))
    return tl, train, val, preds


@register("split_counts")
def q_split_counts(spark, sf):
    tl, train, val, _ = holdout(spark, sf)
    t = train.groupBy("Family").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    v = val.groupBy("Family").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return rounded(t.withColumn("split", F.lit("train")).unionByName(
        v.withColumn("split", F.lit("validation"))))


ORACLES["split_counts"] = fin(sql_with(["train", "val"], """SELECT Family, count(*) AS n_rows,
  min(date) AS first_date, max(date) AS last_date, 'train' AS split FROM train GROUP BY Family
UNION ALL
SELECT Family, count(*), min(date), max(date), 'validation' FROM val GROUP BY Family"""),
    dates=["first_date", "last_date"])

_PRED_D = ["Actual_QTY", "Predicted_QTY"]


@register("validation_predictions", fin(sql_with("val_pred", "SELECT * FROM val_pred"), doubles=_PRED_D))
def q_validation_predictions(spark, sf):
    return rounded(holdout(spark, sf)[3])


_MET = ["r2", "rmse", "mae", "wmape"]


@register("holdout_metrics", fin(sql_with("eval_records", "SELECT * FROM eval_records"),
                                 doubles=_MET, dates=()))
def q_holdout_metrics(spark, sf):
    tl, train, val, preds = holdout(spark, sf)
    met = M.national_metrics(preds)
    return rounded(M.evaluation_records(met, train, val, cutoff=tl.train_cutoff,
                                        val_start=tl.val_start, val_end=tl.val_end))


@register("county_accuracy", fin(sql_with("entity_acc", "SELECT * FROM entity_acc"),
                                 doubles=["R2", "WMAPE", "Actual_Total"], dates=()))
def q_county_accuracy(spark, sf):
    return rounded(M.entity_accuracy(holdout(spark, sf)[3]))


@register("metrics_rollup", fin(sql_with("eval_records", """SELECT lower(Family) || '_' || ModelRole AS key,
  ModelName AS model_type, r2, rmse, mae, wmape, train_size, val_size,
  coalesce(train_cutoff, 'N/A') AS train_cutoff, coalesce(val_start, 'N/A') AS val_start,
  coalesce(val_end, 'N/A') AS val_end FROM eval_records"""), doubles=_MET, dates=()))
def q_metrics_rollup(spark, sf):
    tl, train, val, preds = holdout(spark, sf)
    rec = M.evaluation_records(M.national_metrics(preds), train, val, cutoff=tl.train_cutoff,
                               val_start=tl.val_start, val_end=tl.val_end)
    return rounded(M.metrics_rollup(rec))


@register("quality_gate", fin(sql_with("nat_metrics", """SELECT Family, ModelRole, ModelName, r2,
  coalesce(r2 >= 0.7, false) AS approved FROM nat_metrics"""), doubles=["r2"], dates=()))
def q_quality_gate(spark, sf):
    preds = holdout(spark, sf)[3]
    return rounded(M.quality_gate(M.national_metrics(preds)).select(
        "Family", "ModelRole", "ModelName", "r2", "approved"))


def model_registry(fi, monthly: DataFrame) -> DataFrame:
    """One version per (family, role) and monthly run: national metrics of its holdout + gate.

    There is a run for every month that ends twelve months of the panel; it
    validates those, with the static shares of ``monthly`` as of the month before them. Each panel row is fanned out to the runs whose window holds
    it (twelve at most), so all runs are scored in one aggregation.
    """
    first, last = F.lit(fi.tl.first).cast("date"), F.lit(fi.tl.last).cast("date")
    runs = F.filter(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.add_months("date", k)),
                    lambda e: (e <= last) & (F.add_months(e, -11) >= first))
    rows = fi.panel.select("*", F.explode(runs).alias("run_end")).withColumn("as_of", F.add_months("run_end", -12))
    rows = S.with_shares(rows, S.shares_by_month(monthly), ["Family", "FIPS", "State", "as_of"])
    roles = F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), F.lit(m.name).alias("name"),
                 F.greatest(m.score(), F.lit(0.0)).alias("pred"))
        for role, m in model_spec().items()])).alias("r")
    preds = rows.select("run_end", "date", "Family", F.col("Sales_QTY").alias("Actual_QTY"), roles).select(
        "run_end", "date", "Family", "Actual_QTY", F.col("r.pred").alias("Predicted_QTY"),
        F.col("r.role").alias("ModelRole"), F.col("r.name").alias("ModelName"))
    met = M.quality_gate(M.national_metrics(preds, by=("run_end", "Family", "ModelRole", "ModelName")))
    return met.select(F.concat(F.lower("Family"), F.lit("_"), "ModelRole").alias("group"),
                      F.date_format("run_end", "yyyy-MM-dd").alias("version"),
                      F.col("run_end").alias("created"), "ModelName", "r2", "approved")


@register("model_registry", fin(sql_with(["registry"], "SELECT * FROM registry"),
                                doubles=["r2"], dates=("created",)))
def q_model_registry(spark, sf):
    return rounded(model_registry(forecast_inputs(spark, sf), monthly(spark, sf)))


@register("latest_approved_model", fin(sql_with(["registry"], """SELECT g."group", b.version, b.created,
  b.ModelName, b.r2, b.created IS NOT NULL AS has_approved
FROM (SELECT DISTINCT "group" FROM registry) g
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY created DESC) AS rn
                          FROM registry WHERE approved) a WHERE rn = 1) b ON g."group" = b."group"
"""),
    doubles=["r2"], dates=("created",)))
def q_latest_approved_model(spark, sf):
    return rounded(M.latest_approved(model_registry(forecast_inputs(spark, sf), monthly(spark, sf))))


# ---------------------------------------------------------------- stage 4: lookups + forecast

def static_lookup(spark, sf) -> DataFrame:
    """Names and static shares of every entity as of the last month, which is what serving knows."""
    def build():
        s = sales(spark, sf)
        tl = stage(spark, sf, "timeline", lambda: timeline(s))
        shares = S.static_shares(monthly(spark, sf), tl.last)
        return materialize(L.entity_static(full_panel(spark, sf, tl.train_cutoff), shares))
    return stage(spark, sf, "static_lookup", build)


class ForecastInputs:
    """Everything the batch forecast needs, derived once from the full panel."""

    def __init__(self, spark, sf):
        s = sales(spark, sf)
        self._arrays = None
        self.tl = tl = stage(spark, sf, "timeline", lambda: timeline(s))
        self.panel = fp = full_panel(spark, sf, tl.train_cutoff)
        self.features = feats = model_features(fp.columns)
        # The serving lookups (M8) are written once, like the lookup files of
        # the source, and every forecast / request / reporting plan reads them.
        self.history = materialize(L.trailing_history(fp))
        self.state = materialize(FC.history_state(self.history))
        ext = L.external_lookup(fp, feats)
        avail = [c for c in ext.columns if c not in ("Family", "FIPS", "date")]
        self.ext_cols = cols = series_behind(avail, feats)
        self.econ_cols = [c for c in cols if f"{c}_lag1" in feats or f"{c}_chg3m" in feats]
        self.ext_base = ext.select("Family", "FIPS", "date", *cols)
        extended = FC.extend_external(self.ext_base, cols, tl.forecast_end)
        self.ext = materialize(FC.serving_derivatives(extended, self.econ_cols))
        self.static = static_lookup(spark, sf)
        self.national = materialize(FC.national_frozen(L.national_trailing(fp)))
        self.bounds = materialize(L.guardrail_bounds(fp))

    def rows(self, targets):
        return FC.serving_rows(targets, self.ext, self.static, self.national, self.bounds)

    def named(self, fc: DataFrame) -> DataFrame:
        """Forecast rows in the chunk's columns."""
        names = self.static.select("Family", "FIPS", "County_Name", "State")
        return fc.join(names, ["Family", "FIPS"], "left").select(
            "FIPS", "County_Name", "State", "date", "Predicted_QTY", "Family",
            F.initcap("ModelRole").alias("ModelRole"), "ModelName")

    def forecast(self):
        targets = FC.horizon_targets(self.state, self.tl.forecast_end)
        return self.named(FC.forecast_linear(self.state, self.rows(targets), model_spec(),
                                             start=self.tl.forecast_start, end=self.tl.forecast_end))

    # ---- attribution at the first forecast month
    def first_month_x(self, models=None):
        """Feature rows of every entity and role at the first forecast month (history not yet extended).

        An entity whose history ends earlier is taken from its recursion state: for each
        role, its history goes on with that role's predictions up to the month before.
        """
        keys = ["Family", "FIPS"]
        start = F.lit(self.tl.forecast_start).cast("date")
        due = F.add_months("last_date", 1)
        rec = FC.recursive_features(F.col("h"), F.col("last_returns"))
        now = self.state.filter(due == start).select(*keys, start.alias("date"), *[c.alias(f) for f, c in rec.items()])
        rows = models.with_roles(now) if models else AT.with_roles(now, model_spec())
        # entities that end with the panel have no months to fold: only late ones cost a fold
        late = self.state.filter(due < start)
        rec = FC.recursive_features(F.concat("h", "preds"), F.lit(0.0))
        months = self.rows(FC.horizon_targets(late, self.tl.last))
        folded = models.fold(late, months) if models else FC.fold_linear(late, months, model_spec())
        rows = rows.unionByName(folded.select(*keys, start.alias("date"), *[c.alias(f) for f, c in rec.items()], "ModelRole", "ModelName"))
        fixed = self.rows(self.state.filter(due <= start).select(*keys, start.alias("date")))
        return rows.join(fixed, [*keys, "date"])

    def contributed(self):
        return AT.contributions(self.first_month_x(), ["Family", "FIPS", "date"], model_spec(), self.features)

    def arrays(self):
        """Ranked drivers of every entity and role, written once: chunk and importance tables read them."""
        if self._arrays is None:
            self._arrays = materialize(AT.ranked_arrays(self.contributed(), ["Family", "FIPS", "date"], self.features))
        return self._arrays

    def ranked(self):
        return AT.rank_external(self.arrays(), ["Family", "FIPS", "date"])

    def with_drivers(self, fc: DataFrame, arrays: DataFrame) -> DataFrame:
        """Forecast chunk: all months; the first one carries share and Top-5 drivers."""
        wide = AT.top_k_wide(arrays, ["Family", "FIPS", "date"]).withColumn("ModelRole", F.initcap("ModelRole")).drop("ModelName")
        j = fc.join(wide, ["Family", "FIPS", "date", "ModelRole"], "left")
        return j.withColumns({
            "External_Factors_Share_Pct": F.coalesce("External_Factors_Share_Pct", F.lit(0.0)),
            **{f"Top{i}_Feature": F.coalesce(f"Top{i}_Feature", F.lit("")) for i in range(1, 6)},
            **{f"Top{i}_SHAP": F.coalesce(f"Top{i}_SHAP", F.lit(0.0)) for i in range(1, 6)}})

    def chunk(self):
        return self.with_drivers(self.forecast(), self.arrays())

    def county_importance(self):
        names = self.static.select("Family", "FIPS", "County_Name", "State")
        return AT.county_importance(self.ranked(), names)

    def of_top_volume(self, df: DataFrame) -> DataFrame:
        """The rows of the top-volume entities (top-n ids per family: bounded by n x families)."""
        return df.join(F.broadcast(AT.top_volume_entities(self.history)), ["Family", "FIPS"], "left_semi")

    def national_importance(self):
        return AT.global_importance_linear(self.of_top_volume(self.first_month_x()), model_spec(), self.features)


def forecast_inputs(spark, sf) -> ForecastInputs:
    return stage(spark, sf, "forecast_inputs", lambda: ForecastInputs(spark, sf))


def reporting_inputs(spark, sf):
    """Forecast inputs plus the materialised forecast chunk (stage 3 output)."""
    def build():
        fi = forecast_inputs(spark, sf)
        fi.chunk_df = materialize(fi.chunk())
        return fi
    return stage(spark, sf, "reporting_inputs", build)


def validation_of(fi):
    _, _, preds = holdout_from(fi)
    return preds


def holdout_from(fi):
    train, val = M.split(fi.panel, fi.tl.train_cutoff, fi.tl.val_start, fi.tl.val_end)
    roles = F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), F.lit(m.name).alias("name"),
                 F.greatest(m.score(), F.lit(0.0)).alias("pred"))
        for role, m in model_spec().items()])).alias("r")
    preds = val.select("FIPS", "County_Name", "State", "date", "Family",
                       F.col("Sales_QTY").alias("Actual_QTY"), roles).select(
        "FIPS", "County_Name", "State", "date", "Actual_QTY",
        F.col("r.pred").alias("Predicted_QTY"), "Family",
        F.col("r.role").alias("ModelRole"), F.col("r.name").alias("ModelName"))
    return train, val, preds


def fact_of(spark, sf, fi):
    val = validation_of(fi)
    lookup = R.external_weather_lookup(fi.panel)
    weather = R.universal_weather(lookup)
    hist = R.historical_rows(sales(spark, sf), val)
    return R.fact_table(hist, R.validation_rows(val), R.forecast_rows(fi.chunk_df), weather,
                        fi.static, fi.bounds)


from panelcast.plans import oracle_sql as O  # noqa: E402


def _fc_oracle() -> str:
    """The recursive forecast in DuckDB, in the chunk shape."""
    body = O.FORECAST_SQL.replace("WITH RECURSIVE ", "", 1)
    ctes = sql_with(["state", "steps", "static_l", "tl"], "SELECT 1")
    ctes = ctes[len("WITH "):ctes.rindex("\nSELECT 1")]
    final = body[body.index("\nSELECT Family, FIPS, ModelRole"):]
    rec_def = body[:body.index("\nSELECT Family, FIPS, ModelRole")]
    inner = f"WITH RECURSIVE {ctes},\n{rec_def},\nfc AS ({final})\n"
    return inner + """SELECT fc.FIPS, s.County_Name, s.State, fc.date, fc.Predicted_QTY, fc.Family,
  upper(substr(fc.ModelRole, 1, 1)) || lower(substr(fc.ModelRole, 2)) AS ModelRole, fc.ModelName
FROM fc LEFT JOIN static_l s ON fc.Family = s.Family AND fc.FIPS = s.FIPS"""


_EXT_BASE = O.EXT_BASE
_EXT_DER = [f"{c}_{k}" for c in O.ECON for k in ("lag1", "chg3m")]


@register("trailing_history", fin(sql_with("hist", "SELECT * FROM hist"),
                                  doubles=["Sales_QTY", "Returns_QTY"]))
def q_trailing_history(spark, sf):
    return rounded(L.trailing_history(full_panel(spark, sf)))


@register("guardrail_bounds", fin(sql_with("bounds", "SELECT * FROM bounds"), doubles=["max_qty"],
                                  dates=()))
def q_guardrail_bounds(spark, sf):
    return rounded(L.guardrail_bounds(full_panel(spark, sf)))


@register("entity_static", fin(sql_with("static_l", "SELECT * FROM static_l"), digits=9, dates=(),
                               doubles=["county_alltime_share", "county_recent_share", "state_share",
                                        "county_active_months"]))
def q_entity_static(spark, sf):
    return rounded(static_lookup(spark, sf), 9)


@register("national_serving", fin(sql_with("nat_f", "SELECT * FROM nat_f"),
                                  dates=("base_date", "national_last_date"),
                                  doubles=["national_lag_1", "national_lag_12", "national_rollmean_3"]))
def q_national_serving(spark, sf):
    return rounded(FC.national_frozen(L.national_trailing(full_panel(spark, sf))))


@register("extend_external", fin(sql_with("ext_s", "SELECT Family, FIPS, date, "
                                         + ", ".join(_EXT_BASE + _EXT_DER)
                                         + " FROM ext_s WHERE is_extended"),
                                 doubles=_EXT_BASE + _EXT_DER))
def q_extend_external(spark, sf):
    fi = forecast_inputs(spark, sf)
    base = [c for c in fi.ext_cols if not c.endswith(("_lag1", "_chg3m"))]
    deriv = [f"{c}_{k}" for c in fi.econ_cols for k in ("lag1", "chg3m")]
    return rounded(fi.ext.filter("is_extended").select("Family", "FIPS", "date", *base, *deriv))


@register("forecast_recursive_linear", fin(_fc_oracle(), doubles=["Predicted_QTY"]))
def q_forecast_recursive_linear(spark, sf):
    return rounded(forecast_inputs(spark, sf).forecast())


@register("forecast_known_or_model", fin(sql_with(["state", "hist", "fc", "tl"], """SELECT t.Family, t.FIPS,
  t.date, t.ModelRole,
  CASE WHEN t.date <= tl.last_month AND h.Sales_QTY IS NOT NULL THEN h.Sales_QTY ELSE f.Predicted_QTY END
    AS Predicted_QTY,
  CASE WHEN t.date <= tl.last_month AND h.Sales_QTY IS NOT NULL THEN 'historical_actual'
       WHEN f.Predicted_QTY IS NOT NULL THEN 'model_forecast_recursive_guardrailed'
       ELSE 'no_history_row_for_target' END AS feature_source
FROM (SELECT g.Family, g.FIPS, CAST(g.d AS DATE) AS date, r.ModelRole FROM (
        SELECT s.Family, s.FIPS, unnest(generate_series(CAST(s.last_date - INTERVAL 23 MONTH AS TIMESTAMP),
               CAST(tl.fc_end AS TIMESTAMP), INTERVAL 1 MONTH)) AS d FROM state s, tl) g,
      (SELECT DISTINCT ModelRole FROM fc) r) t
CROSS JOIN tl
LEFT JOIN hist h ON t.Family = h.Family AND t.FIPS = h.FIPS AND t.date = h.date
LEFT JOIN fc f ON t.Family = f.Family AND t.FIPS = f.FIPS AND t.ModelRole = f.ModelRole AND t.date = f.date"""),
    doubles=["Predicted_QTY"]))
def q_forecast_known_or_model(spark, sf):
    """Every visible history month and the whole horizon, per role: actual if known, else forecast."""
    fi = forecast_inputs(spark, sf)
    months = F.sequence(F.add_months("last_date", -23), F.lit(fi.tl.forecast_end).cast("date"),
                        F.expr("INTERVAL 1 MONTH"))
    targets = fi.state.select("Family", "FIPS", F.explode(months).alias("date"))
    fc = FC.forecast_linear(fi.state, fi.rows(FC.horizon_targets(fi.state, fi.tl.forecast_end)),
                            model_spec(), start=fi.tl.forecast_start, end=fi.tl.forecast_end)
    return rounded(FC.known_or_forecast(targets, fi.history, fc, list(model_spec()), fi.tl.last))


# ---------------------------------------------------------------- stage 5: reporting

_TOPS = [f"Top{i}_{k}" for i in range(1, 6) for k in ("Feature", "SHAP")]
_TOP_D = [f"Top{i}_SHAP" for i in range(1, 6)]
_LOOKUP_D = list(R.EXTERNAL_LOOKUP_COLUMNS)
_FACT_D = (["Actual_QTY", "Predicted_QTY", "External_Factors_Share_Pct"] + _TOP_D + _LOOKUP_D
           + ["county_alltime_share", "county_recent_share", "state_share", "county_active_months",
              "max_qty"])


@register("forecast_chunk", fin(sql_with("chunk", "SELECT * FROM chunk"), doubles=["Predicted_QTY", "External_Factors_Share_Pct"] + _TOP_D))
def q_forecast_chunk(spark, sf):
    return rounded(reporting_inputs(spark, sf).chunk_df)


@register("linear_attribution", fin(sql_with("ranked", 'SELECT Family, FIPS, ModelRole, ModelName, Feature, SHAP_Value, External_Factors_Share_Pct, CAST("Rank" AS INTEGER) AS "Rank" FROM ranked'), doubles=["SHAP_Value", "External_Factors_Share_Pct"], dates=()))
def q_linear_attribution(spark, sf):
    fi = forecast_inputs(spark, sf)
    return rounded(fi.ranked().drop("date"))


@register("top5_drivers", fin(sql_with("wide", "SELECT * FROM wide"), doubles=["External_Factors_Share_Pct"] + _TOP_D))
def q_top5_drivers(spark, sf):
    fi = forecast_inputs(spark, sf)
    return rounded(AT.top_k_wide(fi.arrays(), ["Family", "FIPS", "date"]))


@register("importance_global", fin(sql_with("imp_national", "SELECT * FROM imp_national"), doubles=["SHAP_Value"], dates=()))
def q_importance_global(spark, sf):
    return rounded(forecast_inputs(spark, sf).national_importance())


@register("importance_state", fin(sql_with("imp_state", "SELECT * FROM imp_state"), doubles=["SHAP_Value"], dates=()))
def q_importance_state(spark, sf):
    fi = reporting_inputs(spark, sf)
    return rounded(AT.state_importance(fi.county_importance(), fi.chunk_df, fi.tl.forecast_start))


@register("importance_all_levels", fin(sql_with(["imp_national", "imp_county", "imp_state"], "SELECT * REPLACE (CAST(\"Rank\" AS DOUBLE) AS \"Rank\") FROM (SELECT * FROM imp_national UNION ALL SELECT * FROM imp_county UNION ALL SELECT * FROM imp_state) u"), doubles=["SHAP_Value", "Rank"], dates=()))
def q_importance_all_levels(spark, sf):
    fi = reporting_inputs(spark, sf)
    county = fi.county_importance()
    state = AT.state_importance(county, fi.chunk_df, fi.tl.forecast_start)
    out = AT.all_levels(fi.national_importance(), county, state)
    # Rank is null on National / State rows: presented as double on both sides
    return rounded(out.withColumn("Rank", F.col("Rank").cast("double")))


@register("weather_universal", fin(sql_with("uweather", "SELECT * FROM uweather"), doubles=_LOOKUP_D))
def q_weather_universal(spark, sf):
    fp = forecast_inputs(spark, sf).panel
    return rounded(R.universal_weather(R.external_weather_lookup(fp)))


@register("missing_weather", sql_with(["uweather", "full_panel"], """SELECT n_entities, n_missing,
  round(n_missing * 100.0 / n_entities, 1) + 0.0 AS pct_missing FROM
  (SELECT count(*) AS n_entities FROM (SELECT DISTINCT FIPS FROM full_panel WHERE Family = 'O') e) a,
  (SELECT count(*) AS n_missing FROM (SELECT DISTINCT FIPS FROM full_panel WHERE Family = 'O') e
   WHERE FIPS NOT IN (SELECT FIPS FROM uweather WHERE TAVG IS NOT NULL)) b"""))
def q_missing_weather(spark, sf):
    fp = forecast_inputs(spark, sf).panel
    w = R.universal_weather(R.external_weather_lookup(fp))
    return rounded(R.missing_weather(w, fp.filter(F.col("Family") == "O")))


@register("fact_table", fin(sql_with("fact_full", "SELECT * FROM fact_full"), doubles=_FACT_D))
def q_fact_table(spark, sf):
    fi = reporting_inputs(spark, sf)
    return rounded(fact_of(spark, sf, fi))


@register("fact_grain_check", sql_with("fact_full", """SELECT count(*) AS n_keys,
  count(*) FILTER (WHERE c > 1) AS n_duplicated, max(c) AS max_rows_per_key FROM (
  SELECT FIPS, date, Family, ModelRole, DataType, count(*) AS c FROM fact_full GROUP BY ALL) g"""))
def q_fact_grain_check(spark, sf):
    fi = reporting_inputs(spark, sf)
    return R.grain_check(fact_of(spark, sf, fi))


@register("future_fill", fin(sql_with("ff", "SELECT * FROM ff"), doubles=[c for c in _FACT_D if c != "has_temperature_data"]))
def q_future_fill(spark, sf):
    fi = reporting_inputs(spark, sf)
    return rounded(R.fill_future(fact_of(spark, sf, fi), fi.tl.last))


@register("national_table", fin(sql_with(["sales", "chunk"], """SELECT date, Family, sum("Sales QTY") AS Sales_QTY,
  'Historical' AS DataType, CAST(NULL AS VARCHAR) AS ModelRole FROM sales GROUP BY date, Family
UNION ALL
SELECT date, Family, sum(Predicted_QTY), 'Forecast', ModelRole FROM chunk GROUP BY date, Family, ModelRole"""),
    doubles=["Sales_QTY"]))
def q_national_table(spark, sf):
    fi = reporting_inputs(spark, sf)
    return rounded(R.national_table(sales(spark, sf), fi.chunk_df))


@register("demand_spikes", fin(sql_with("chunk", """SELECT FIPS, County_Name, State, Family, ModelRole, ModelName,
  strftime(date, '%Y-%m-%d') AS Spike_Month, round(prev, 2) AS Baseline_Before_Spike,
  round(Predicted_QTY, 2) AS Predicted_At_Spike, round(chg, 2) AS Absolute_Increase,
  CASE WHEN prev > 0.5 THEN round(chg / prev * 100, 1) END AS Percentage_Increase
FROM (SELECT *, row_number() OVER (PARTITION BY FIPS, Family, ModelRole ORDER BY round(chg, 9) DESC, date ASC) AS rn
      FROM (SELECT *, lag(Predicted_QTY) OVER w AS prev, Predicted_QTY - lag(Predicted_QTY) OVER w AS chg
            FROM chunk WINDOW w AS (PARTITION BY FIPS, Family, ModelRole ORDER BY date)) a
      WHERE chg IS NOT NULL) b WHERE rn = 1"""), dates=(),
    doubles=["Baseline_Before_Spike", "Predicted_At_Spike", "Absolute_Increase", "Percentage_Increase"]))
def q_demand_spikes(spark, sf):
    return rounded(R.demand_spikes(reporting_inputs(spark, sf).chunk_df))


@register("importance_long", fin(sql_with("chunk", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT FIPS, County_Name, State, date, Family, ModelRole, ModelName, External_Factors_Share_Pct, "
    f"CAST({i} AS INTEGER) AS \"Rank\", Top{i}_Feature AS Feature, Top{i}_SHAP AS SHAP_Value FROM chunk"
    for i in range(1, 6)) + ") u WHERE Feature IS NOT NULL AND Feature <> ''"),
    doubles=["External_Factors_Share_Pct", "SHAP_Value"]))
def q_importance_long(spark, sf):
    fi = reporting_inputs(spark, sf)
    return rounded(R.importance_long(R.forecast_rows(fi.chunk_df)))


@register("table_profile", fin(sql_with("null_profile", "SELECT * FROM null_profile"), doubles=["null_pct"], dates=()))
def q_table_profile(spark, sf):
    fi = reporting_inputs(spark, sf)
    return rounded(R.null_profile(R.fill_future(fact_of(spark, sf, fi), fi.tl.last)))


@register("fact_summary", fin(sql_with("fact_full", """SELECT count(*) AS n_rows, count(DISTINCT FIPS) AS n_fips,
  count(DISTINCT date) AS n_dates, count(DISTINCT Family) AS n_families, min(date) AS first_date,
  max(date) AS last_date FROM fact_full"""), dates=["first_date", "last_date"]))
def q_fact_summary(spark, sf):
    fi = reporting_inputs(spark, sf)
    return rounded(R.table_summary(fact_of(spark, sf, fi)))


@register("friendly_names", sql_with("ranked", "SELECT DISTINCT Feature, " + O._FRIENDLY + " AS Friendly_Name FROM ranked"))
def q_friendly_names(spark, sf):
    from panelcast.functions.features import with_friendly_name
    fi = forecast_inputs(spark, sf)
    feats = fi.ranked().select("Feature").distinct()
    return with_friendly_name(feats)


# ---------------------------------------------------------------- stage 6: requests

from panelcast.operators import requests as RQ  # noqa: E402
from panelcast.operators.served import ServedModels  # noqa: E402
from panelcast.operators.scoring import SENSITIVITY_ROLE  # noqa: E402

# Fixed what-if payload of the generated scenario requests: an alias with a
# percent change, a raw feature with an absolute change, a default-type alias,
# a known-unsupported key and an unknown key.
SCENARIO_CHANGES = {"CPI": {"type": "percent", "value": 10.0},
                    "TAVG": {"type": "absolute", "value": -2.0},
                    "OilPrice": {"value": 5.0},
                    "CORN_Acreage": {"type": "percent", "value": -20.0},
                    "GDD": {"type": "percent", "value": 3.0},
                    "RainfallIndex": {"type": "absolute", "value": 1.0}}


def families_of(fi: ForecastInputs) -> list[str]:
    return sorted(r[0] for r in fi.static.select("Family").distinct().collect())


def generated_requests(fi: ForecastInputs) -> DataFrame:
    """Request texts derived from every entity of the static lookup (seven kinds each)."""
    import json
    st = fi.static
    start = F.lit(fi.tl.forecast_start).cast("date")
    last = F.lit(fi.tl.last).cast("date")
    plain_id = F.col("FIPS").cast("long").cast("string")
    kinds = {
        "forecast": (F.add_months(start, 2), {"fips": plain_id}),
        "historical": (F.add_months(last, -2), {"fips": F.concat(plain_id, F.lit(".0"))}),
        "by_name": (start, {"county_name": F.lower("County_Name"), "state": F.col("State")}),
        "scenario": (F.add_months(start, 5), {"fips": F.col("FIPS"), "scenario": F.lit(True)}),
        "explain": (start, {"fips": F.col("FIPS"), "explain": F.lit(True)}),
        "bad_month": (start, {"fips": F.col("FIPS")}),
        "unknown_id": (F.add_months(start, 1), {"fips": (F.col("FIPS").cast("long") + 1000000).cast("string")}),
    }
    parts = []
    for kind, (target, fields) in kinds.items():
        month = F.lit(13) if kind == "bad_month" else F.month(target)
        body = F.struct(F.col("Family").alias("family"), *[c.alias(k) for k, c in fields.items()],
                        month.alias("month"), F.year(target).alias("year"))
        text = F.to_json(body)
        if kind == "scenario":
            text = F.concat(F.regexp_replace(text, r"\}$", ""),
                            F.lit(', "feature_changes": ' + json.dumps(SCENARIO_CHANGES) + "}"))
        parts.append(st.select(F.concat_ws("-", "Family", "FIPS", F.lit(kind)).alias("request_id"),
                               text.alias("value")))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def resolved_requests(fi: ForecastInputs, raw: DataFrame) -> DataFrame:
    req = RQ.parse_requests(raw)
    fams = fi.static.select("Family").distinct()
    return RQ.with_static(RQ.resolve_entity(RQ.validate(req, fams), fi.static), fi.static)


def scored_requests(fi: ForecastInputs, req: DataFrame, models=None, keep=materialize) -> tuple[DataFrame, object]:
    """Per (request, role) scores of resolved requests, and the serving-row builder."""
    models = models or spec_models(fi)
    # only entities that are asked for beyond the forecast's end are extended further, each to its own month
    end = F.lit(fi.tl.forecast_end).cast("date")
    far = (req.filter(F.col("error").isNull()).groupBy("Family", "FIPS")
           .agg(F.max(RQ.target_month(F.col("year"), F.col("month"))).alias("until")).filter(F.col("until") > end))
    far = keep(far, "request_horizons")
    base = fi.ext_base.join(far, ["Family", "FIPS"], "left_semi")
    more = FC.serving_derivatives(FC.extend_external(base, fi.ext_cols, far), fi.econ_cols).filter(F.col("date") > end)
    more = keep(more, "request_externals")
    ext = fi.ext.unionByName(more)

    def rows_for(targets):
        return FC.serving_rows(targets, ext, fi.static, fi.national, fi.bounds)

    scored = RQ.score_requests(req, state=fi.state, history=fi.history, rows_for=rows_for, national=fi.national, models=models,
                               last_actual=fi.tl.last, sensitivity_role=SENSITIVITY_ROLE, keep=keep)
    return scored, rows_for


def spec_models(fi: ForecastInputs) -> ServedModels:
    return ServedModels.linear(fi.features, families_of(fi), model_spec())


def score_request_table(fi: ForecastInputs, raw: DataFrame, models=None, keep=materialize) -> DataFrame:
    """R7: parse, validate, resolve, score both roles, explain; one row per request.

    The resolved requests and the tables made from them are written once: one plan over all of it, with the
    requests resolved anew at each use, takes the driver more than a gigabyte to plan.
    """
    models = models or spec_models(fi)
    req = keep(resolved_requests(fi, raw), "requests")
    scored, rows_for = scored_requests(fi, req, models, keep)
    scored = keep(scored, "request_scores")
    explained = RQ.explain_requests(req, state=fi.state, rows_for=rows_for, models=models.only("champion"))
    return RQ.assemble_response(req, scored, keep(explained, "request_drivers"), models.roles)


@register("request_scoring")
def q_request_scoring(spark, sf):
    fi = forecast_inputs(spark, sf)
    return rounded(score_request_table(fi, generated_requests(fi)))


def _scenario_oracle() -> str:
    """What-if of every entity at the sixth forecast month, in DuckDB.

    History at the target is the recursion state one step earlier (fc_rec);
    the fixed payload is resolved here (alias, else raw feature, else
    unsupported); the shift uses the sensitivity model's coefficients.
    """
    from panelcast.functions.features import FEATURE_CHANGE_MAP, KNOWN_UNSUPPORTED
    feats = O.FEATURES
    applied, unsupported = {}, []
    for key, ch in SCENARIO_CHANGES.items():
        target = FEATURE_CHANGE_MAP.get(key) or (key if key not in KNOWN_UNSUPPORTED else None)
        if target in feats:
            applied[target] = (ch.get("type", "percent"), float(ch.get("value", 0.0)))
        else:
            unsupported.append(key)
    sens = MODEL_SPEC[SENSITIVITY_ROLE]

    def before(f):
        return f"coalesce(CAST(x.{f} AS DOUBLE), 0.0)"

    def after(f):
        kind, v = applied[f]
        return f"({before(f)} * (1 + {v!r} / 100.0))" if kind == "percent" else f"({before(f)} + {v!r})"

    shift = " + ".join(f"{float(sens.coefs.get(f, 0.0))!r} * ({after(f)} - {before(f)})" for f in applied) or "0.0"
    base = "CASE " + " ".join(f"WHEN x.ModelRole = '{r}' THEN {m.sql('x')}" for r, m in MODEL_SPEC.items()) + " END"
    raw = f"({base} + {shift})"
    pred = f"round(CASE WHEN x._hi IS NULL THEN greatest({raw}, 0.0) ELSE least(greatest({raw}, 0.0), x._hi) END, 4)"
    unsup = ",".join(sorted(unsupported))
    rows = "\nUNION ALL\n".join(
        f"SELECT x.Family, x.FIPS, x.ModelRole, x.ModelName, '{f}' AS Feature, {before(f)} AS before, "
        f"{after(f)} AS after, '{applied[f][0]}' AS change_type, {applied[f][1]!r} AS change_value, "
        f"{pred} AS predicted_qty, '{unsup}' AS unsupported FROM sc_x x" for f in applied)
    return sql_with(["sc_x"], rows)


@register("scenario_what_if", fin(_scenario_oracle(),
                                  doubles=["before", "after", "change_value", "predicted_qty"], dates=()))
def q_scenario_what_if(spark, sf):
    """X16 / X17 / M10 / R4: the fixed what-if payload for every entity, six months ahead."""
    fi = forecast_inputs(spark, sf)
    raw = generated_requests(fi).filter(F.col("request_id").endswith("-scenario"))
    scored, _ = scored_requests(fi, materialize(resolved_requests(fi, raw), "requests"))
    sc = scored.filter(F.col("scenario"))
    return rounded(sc.select(
        "Family", "FIPS", "ModelRole", "ModelName", "predicted_qty",
        F.concat_ws(",", F.array_sort("unsupported_feature_changes")).alias("unsupported"),
        F.explode("scenario_features").alias("Feature", "_c")).select(
        "Family", "FIPS", "ModelRole", "ModelName", "Feature", F.col("_c.before").alias("before"),
        F.col("_c.after").alias("after"), F.col("_c.type").alias("change_type"),
        F.col("_c.value").alias("change_value"), "predicted_qty", "unsupported"))


# ---------------------------------------------------------------- stage 2b: fitted models

from panelcast.operators import models as MD  # noqa: E402

def fitted_ridge(spark, sf) -> dict[str, "MD.LinearModel"]:
    """Ridge per family, fitted on the training window in one pass (one k x k solve each)."""
    def build():
        fi = forecast_inputs(spark, sf)
        train, _ = M.split(fi.panel, fi.tl.train_cutoff, fi.tl.val_start, fi.tl.val_end)
        fams = [r[0] for r in fi.panel.select("Family").distinct().collect()]  # family dimension
        return {f: m for f, (m, _) in MD.fit_ridges(train, fi.features, sorted(fams)).items()}
    return stage(spark, sf, "ridge", build)


@register("ridge_holdout", fin(sql_with("ridge_records", "SELECT * FROM ridge_records"), doubles=_MET, dates=(), digits=4))
def q_ridge_holdout(spark, sf):
    fi = forecast_inputs(spark, sf)
    train, val = M.split(fi.panel, fi.tl.train_cutoff, fi.tl.val_start, fi.tl.val_end)
    parts = []
    for fam, m in fitted_ridge(spark, sf).items():
        v = val.filter(F.col("Family") == fam)
        parts.append(M.holdout_predictions(v, m.score(), family_role="challenger", model_name=m.name))
    preds = parts[0]
    for p_ in parts[1:]:
        preds = preds.unionByName(p_)
    met = M.national_metrics(preds)
    return rounded(M.evaluation_records(met, train, val, cutoff=fi.tl.train_cutoff,
                                        val_start=fi.tl.val_start, val_end=fi.tl.val_end), 4)


@register("ridge_coefficients", sql_with("ridge_coef", "SELECT Family, Feature, CAST(printf('%.5e', coef) AS DOUBLE) + 0.0 AS coef FROM ridge_coef"))
def q_ridge_coefficients(spark, sf):
    rows = [(fam, f, float(c)) for fam, m in fitted_ridge(spark, sf).items()
            for f, c in sorted(m.coefs.items())]
    rows += [(fam, "(intercept)", float(m.intercept)) for fam, m in fitted_ridge(spark, sf).items()]
    table = spark.createDataFrame(rows, "Family string, Feature string, coef double")
    # six significant digits: coefficients differ by many orders of magnitude
    return table.withColumn("coef", F.format_string("%.5e", "coef").cast("double") + F.lit(0.0))


@register("ridge_forecast", fin(sql_with("ridge_fc", "SELECT * FROM ridge_fc"), doubles=["Predicted_QTY"], digits=3))
def q_ridge_forecast(spark, sf):
    """Recursive forecast with the fitted ridge of each family (one fold per family)."""
    fi = forecast_inputs(spark, sf)
    targets = FC.horizon_targets(fi.state, fi.tl.forecast_end)
    rows = fi.rows(targets)
    out = None
    for fam, m in fitted_ridge(spark, sf).items():
        st = fi.state.filter(F.col("Family") == fam)
        fc = FC.forecast_linear(st, rows.filter(F.col("Family") == fam), {"challenger": m},
                                start=fi.tl.forecast_start, end=fi.tl.forecast_end)
        out = fc if out is None else out.unionByName(fc)
    return rounded(out, 3)


# ---------------------------------------------------------------- stage 3b: fitted models served

from panelcast.operators.bundles import load_bundles, write_bundles  # noqa: E402
from panelcast.session import shared_path  # noqa: E402


def fitted(spark, sf, *roles: str, refit: bool = True) -> ServedModels:
    """The fitted models of the given roles (default: all), read back from their bundles.

    With ``refit`` they are fitted to all months (what is served), else to the training months. Models of
    one call grow in the same passes over the data; each set is fitted once per application.
    """
    roles = roles or ("champion", "challenger")

    def build():
        fi = forecast_inputs(spark, sf)
        learners = MD.named_learners(families_of(fi), roles)
        train, _ = M.split(fi.panel, fi.tl.train_cutoff, fi.tl.val_start, fi.tl.val_end)
        cutoff = fi.tl.last if refit else fi.tl.train_cutoff
        # what is served knows the shares as of the last month: the refit learns from the same ones
        if refit:  # written once: quantiles, means, blocks and products all read it
            full = S.with_shares(fi.panel, fi.static, ["Family", "FIPS", "State"])
            train = materialize(full.select("Family", "FIPS", "date", "Sales_QTY", *fi.features), "training")
        models = MD.fit_all(train, fi.features, learners)
        root = write_bundles(spark, models, shared_path(spark, "bundles"), cutoff)
        return load_bundles(spark, root, list(learners))
    return stage(spark, sf, f"fitted-{'-'.join(roles)}-{refit}", build)


def fitted_predictions(spark, sf, *roles: str) -> DataFrame:
    """Holdout predictions of the models fitted to the training months."""
    fi = forecast_inputs(spark, sf)
    _, val = M.split(fi.panel, fi.tl.train_cutoff, fi.tl.val_start, fi.tl.val_end)
    models = fitted(spark, sf, *roles, refit=False)
    raw = models.predict(models.with_roles(val))
    return raw.select("FIPS", "County_Name", "State", "date", F.col("Sales_QTY").alias("Actual_QTY"),
                      F.greatest("raw", F.lit(0.0)).alias("Predicted_QTY"), "Family", "ModelRole", "ModelName")


@register("gbt_holdout")
def q_gbt_holdout(spark, sf):
    """Boosted-tree champions of all families, fitted to the training months: metrics of their holdout."""
    return rounded(M.national_metrics(fitted_predictions(spark, sf, "champion")))


@register("fitted_holdout")
def q_fitted_holdout(spark, sf):
    """All four fitted models: evaluation records of the holdout, with the quality gate."""
    fi = forecast_inputs(spark, sf)
    train, val = M.split(fi.panel, fi.tl.train_cutoff, fi.tl.val_start, fi.tl.val_end)
    met = M.quality_gate(M.national_metrics(fitted_predictions(spark, sf)))
    return rounded(M.evaluation_records(met, train, val, cutoff=fi.tl.train_cutoff, val_start=fi.tl.val_start, val_end=fi.tl.val_end))


def fitted_forecast(spark, sf, *roles: str) -> DataFrame:
    """24-month recursive forecast of the refitted models, written once per application."""
    def build():
        fi = forecast_inputs(spark, sf)
        fc = fitted(spark, sf, *roles).forecast(fi.state, fi.rows(FC.horizon_targets(fi.state, fi.tl.forecast_end)),
                                                start=fi.tl.forecast_start, end=fi.tl.forecast_end)
        return materialize(fi.named(fc))
    return stage(spark, sf, f"fitted-forecast-{'-'.join(roles)}", build)


def fitted_arrays(spark, sf, *roles: str) -> DataFrame:
    """Contributions of the refitted models for every entity and role at the first forecast month, written once."""
    def build():
        fi, models = forecast_inputs(spark, sf), fitted(spark, sf, *roles)
        return materialize(models.contribute(fi.first_month_x(models), ["Family", "FIPS", "date"]))
    return stage(spark, sf, f"fitted-arrays-{'-'.join(roles)}", build)


def fitted_ranked(spark, sf, *roles: str) -> DataFrame:
    fi = forecast_inputs(spark, sf)
    return AT.ranked_arrays(fitted_arrays(spark, sf, *roles), ["Family", "FIPS", "date"], fi.features)


def fitted_chunk(spark, sf, *roles: str) -> DataFrame:
    """Forecast chunk of the fitted models: all months; the first carries share and Top-5 drivers."""
    return forecast_inputs(spark, sf).with_drivers(fitted_forecast(spark, sf, *roles), fitted_ranked(spark, sf, *roles))


@register("gbt_forecast")
def q_gbt_forecast(spark, sf):
    """24-month recursive forecast of the tree champions: all months of an entity in one task."""
    return rounded(fitted_forecast(spark, sf, "champion"))


@register("gbt_forecast_chunk")
def q_gbt_forecast_chunk(spark, sf):
    return rounded(fitted_chunk(spark, sf, "champion"))


@register("gbt_attribution")
def q_gbt_attribution(spark, sf):
    """Exact tree attribution at the first forecast month: external drivers ranked + share."""
    return rounded(AT.rank_external(fitted_ranked(spark, sf, "champion"), ["Family", "FIPS", "date"]).drop("date"))


@register("gbt_importance_national")
def q_gbt_importance_national(spark, sf):
    """Mean |attribution| of the tree champions over the top-volume entities, with labels and external flags."""
    fi = forecast_inputs(spark, sf)
    sample = fi.of_top_volume(fitted_arrays(spark, sf, "champion"))
    return rounded(AT.global_importance_absolute(sample, fi.features).drop("Rank"))


@register("fitted_importance_levels")
def q_fitted_importance_levels(spark, sf):
    """National, state and county importance of all four fitted models in one table."""
    fi, models = forecast_inputs(spark, sf), fitted(spark, sf)
    arrays, chunk = fitted_arrays(spark, sf), fitted_chunk(spark, sf)
    ranked = AT.rank_external(AT.ranked_arrays(arrays, ["Family", "FIPS", "date"], fi.features), ["Family", "FIPS", "date"])
    county = AT.county_importance(ranked, fi.static.select("Family", "FIPS", "County_Name", "State"))
    national = AT.global_importance_absolute(fi.of_top_volume(arrays), fi.features)
    out = AT.all_levels(national, county, AT.state_importance(county, chunk, fi.tl.forecast_start))
    return rounded(out.withColumn("Rank", F.col("Rank").cast("double")))


@register("fitted_request_scoring")
def q_fitted_request_scoring(spark, sf):
    """The generated requests answered by the refitted models: trees, moved in what-ifs by the ridge."""
    fi = forecast_inputs(spark, sf)
    return rounded(score_request_table(fi, generated_requests(fi), fitted(spark, sf)))


@register("response_documents")
def q_response_documents(spark, sf):
    """The answers to the generated requests as JSON documents."""
    fi = forecast_inputs(spark, sf)
    models = spec_models(fi)
    return RQ.response_documents(score_request_table(fi, generated_requests(fi), models), models.roles)


# ---------------------------------------------------------------- stage 6b: streaming requests

def stream_scorer(spark, sf):
    """The batch scorer used by the streaming job (lookups are static, built once)."""
    fi = forecast_inputs(spark, sf)

    def score(batch):
        return score_request_table(fi, batch, keep=RQ.lazy)
    return score
