"""Serving-time features, external-series extension and the recursive forecast.

The recursion keeps each entity's recent history as an array column and
folds the horizon with ``aggregate``: one row per entity, no self-joins, no
shuffle beyond the entity partitioning. For a linear scorer every feature
that does not depend on the recursion (calendar, static, national, external)
is folded into a per-month offset computed with ordinary joins first.

Serving rules (kept as the source has them, they differ from training):
lags beyond the history are 0; rolling windows accept partial windows and
the std of one value is 0; national features are frozen at the last actual
month (lag 12 falls back to the first value); predicted months carry
returns 0; ``_lag1`` falls back to the current value and ``_chg3m`` to 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import calendar_columns, time_index
from panelcast.operators.scoring import LinearModel

KEYS = ("Family", "FIPS")
MONTH = "date"
GUARDRAIL = 1.15
LAG_RE = "fips_lag_"
#: Months of history that a prediction can see.
VISIBLE = 24


# ------------------------------------------------------------ external series

def extend_external(ext: DataFrame, cols: list[str], until, *, keys=KEYS) -> DataFrame:
    """Extend each entity's external series month by month up to ``until``.

    A future month takes the mean of the *real* values of the same calendar
    month when there are at least two, else the last known value (real or
    already extended), else null. Adds ``is_extended``. ``until`` is a date, or a
    table of keys with a column ``until`` (a month of its own for each entity).
    """
    cm = F.month(MONTH)
    stats = ext.groupBy(*keys, cm.alias("_cm")).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.count(c).alias(f"_n_{c}") for c in cols])
    last = ext.groupBy(*keys).agg(F.max(MONTH).alias("_last"))
    last = last.join(until, list(keys)) if isinstance(until, DataFrame) else last.withColumn("until", F.lit(until).cast("date"))
    fut = (last.filter(F.col("_last") < F.col("until"))
           .select(*keys, F.explode(F.sequence(F.add_months("_last", 1), F.col("until"),
                                               F.expr("INTERVAL 1 MONTH"))).alias(MONTH))
           .withColumn("_cm", cm).join(stats, [*keys, "_cm"], "left")
           .select(*keys, MONTH, *[F.when(F.col(f"_n_{c}") >= 2, F.col(f"_m_{c}")).alias(c)
                                   for c in cols], F.lit(True).alias("is_extended")))
    real = ext.select(*keys, MONTH, *cols, F.lit(False).alias("is_extended"))
    w = Window.partitionBy(*keys).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, 0)
    both = real.unionByName(fut)
    return both.select(*keys, MONTH, *[
        F.when(F.col("is_extended"), F.last(F.col(c), ignorenulls=True).over(w))
        .otherwise(F.col(c)).alias(c) for c in cols], "is_extended")


def serving_derivatives(ext: DataFrame, econ_cols: list[str], *, keys=KEYS) -> DataFrame:
    """``{c}_lag1`` (value a month earlier, else the current one) and
    ``{c}_chg3m`` (change over three months, else 0) on a monthly series."""
    w = Window.partitionBy(*keys).orderBy(MONTH)
    d = F.col(MONTH)
    has1 = F.lag(d, 1).over(w) == F.add_months(d, -1)
    has3 = F.lag(d, 3).over(w) == F.add_months(d, -3)
    out = {}
    for c in econ_cols:
        x = F.col(c)
        out[f"{c}_lag1"] = F.when(F.coalesce(has1, F.lit(False)), F.lag(x, 1).over(w)).otherwise(x)
        out[f"{c}_chg3m"] = F.when(F.coalesce(has3, F.lit(False)) & x.isNotNull(),
                                   x - F.lag(x, 3).over(w)).otherwise(F.lit(0.0))
    return ext.withColumns(out)


# ------------------------------------------------------------ frozen national context

def national_frozen(national: DataFrame) -> DataFrame:
    """National features as seen at serving time: one row per family."""
    w = Window.partitionBy("Family").orderBy(F.col(MONTH).desc())
    w_up = Window.partitionBy("Family").orderBy(MONTH)
    r = (national.withColumn("_rd", F.row_number().over(w))
         .withColumn("_ru", F.row_number().over(w_up)))
    s = F.col("Sales_QTY")
    g = r.groupBy("Family").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col("_rd") == 1, s)).alias("_l1"),
        F.max(F.when(F.col("_rd") == 12, s)).alias("_l12"),
        F.max(F.when(F.col("_ru") == 1, s)).alias("_first"),
        F.avg(F.when(F.col("_rd") <= 3, s)).alias("_m3"),
        F.min(MONTH).alias("base_date"), F.max(MONTH).alias("national_last_date"))
    return g.select("Family", "base_date", "national_last_date",
                    F.coalesce("_l1", F.lit(0.0)).alias("national_lag_1"),
                    F.when(F.col("_n") >= 12, F.col("_l12"))
                    .otherwise(F.coalesce("_first", F.lit(0.0))).alias("national_lag_12"),
                    F.coalesce("_m3", F.lit(0.0)).alias("national_rollmean_3"))


# ------------------------------------------------------------ recursive features on an array

def _arr_mean(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)


def _arr_std(a: Column) -> Column:
    m = _arr_mean(a)
    ss = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
    return F.when(F.size(a) > 1, F.sqrt(ss / (F.size(a) - 1))).otherwise(F.lit(0.0))


def _tail(h: Column, w: int) -> Column:
    return F.slice(h, F.greatest(F.size(h) - w + 1, F.lit(1)), w)


def recursive_features(h: Column, ret: Column) -> dict[str, Column]:
    """Entity-history features from the history array ``h`` (oldest first)."""
    n = F.size(h)
    out = {f"{LAG_RE}{k}": F.when(n >= k, F.element_at(h, -k)).otherwise(F.lit(0.0))
           for k in (1, 2, 3, 6, 12)}
    for w in (3, 6, 12):
        t = _tail(h, w)
        out[f"fips_rollmean_{w}"] = F.when(n >= 1, _arr_mean(t)).otherwise(F.lit(0.0))
        out[f"fips_rollstd_{w}"] = F.when(n >= 1, _arr_std(t)).otherwise(F.lit(0.0))
    out["returns_lag_1"] = ret
    return out


RECURSIVE = ({f"{LAG_RE}{k}" for k in (1, 2, 3, 6, 12)}
             | {f"fips_roll{kind}_{w}" for kind in ("mean", "std") for w in (3, 6, 12)}
             | {"returns_lag_1"})


def guardrail_hi(max_qty: Column) -> Column:
    """Upper bound 1.15 x seasonal max; none when the max is missing or zero."""
    return F.when(max_qty.isNull() | (max_qty == 0), F.lit(None).cast("double")) \
        .otherwise(max_qty * GUARDRAIL)


def clip(pred: Column, hi: Column) -> Column:
    """Clip to [0, hi] like ``np.clip`` (hi < 0 returns hi); no hi -> only >= 0."""
    lo = F.greatest(pred, F.lit(0.0))
    return F.when(hi.isNull(), lo).otherwise(F.least(lo, hi))


# ------------------------------------------------------------ serving rows

def history_state(history: DataFrame) -> DataFrame:
    """(Family, FIPS) -> history array (oldest first), last month, last returns.

    ``history`` is the trailing lookup: at most 24 rows per entity.
    """
    g = history.groupBy(*KEYS).agg(F.sort_array(F.collect_list(
        F.struct(MONTH, "Sales_QTY", "Returns_QTY"))).alias("_rows"))
    return g.select(*KEYS,
                    F.transform("_rows", lambda r: r["Sales_QTY"]).alias("h"),
                    F.element_at("_rows", -1)[MONTH].alias("last_date"),
                    F.element_at("_rows", -1)["Returns_QTY"].alias("last_returns"))


def serving_rows(targets: DataFrame, ext: DataFrame, static: DataFrame, national: DataFrame,
                 bounds: DataFrame, *, base=None) -> DataFrame:
    """All non-recursive features of (Family, FIPS, date) target rows + guardrail bound.

    ``national`` holds one row per family and is broadcast. Unknown entities
    get the default static row (shares 0, sparse 1).
    """
    static_cols = ["county_alltime_share", "county_recent_share", "state_share",
                   "county_active_months", "county_is_sparse"]
    st = static.select(*KEYS, *static_cols)
    rows = (targets.join(ext, [*KEYS, MONTH], "left")
            .join(st, list(KEYS), "left")
            .join(F.broadcast(national), "Family", "left")
            .withColumn("calendar_month", F.month(MONTH).cast("int"))
            .join(bounds, [*KEYS, "calendar_month"], "left"))
    cal = calendar_columns(F.col(MONTH))
    cal.pop("calendar_month")
    # time index base: the family's first panel month unless given
    base_col = F.col("base_date") if base is None else F.lit(base).cast("date")
    return rows.withColumns({
        **cal,
        "time_idx": time_index(F.col(MONTH), base_col),
        "county_alltime_share": F.coalesce("county_alltime_share", F.lit(0.0)),
        "county_recent_share": F.coalesce("county_recent_share", F.lit(0.0)),
        "state_share": F.coalesce("state_share", F.lit(0.0)),
        "county_active_months": F.coalesce("county_active_months", F.lit(0.0)),
        "county_is_sparse": F.coalesce("county_is_sparse", F.lit(1)),
        "_hi": guardrail_hi(F.col("max_qty")),
    })


def fold_linear(state: DataFrame, rows: DataFrame, models: dict[str, LinearModel]) -> DataFrame:
    """The recursion itself: one row per (Family, FIPS, role) with ``steps`` and ``preds`` arrays."""
    return _fold(state, rows, models)


def forecast_linear(state: DataFrame, rows: DataFrame, models: dict[str, LinearModel], *,
                    start, end) -> DataFrame:
    """Recursive, guard-railed forecast of linear models; months in [start, end].

    ``state``: output of :func:`history_state`; ``rows``: serving rows for
    every month after each entity's last history month. ``models`` maps a
    role to its model; all roles run in the same pass (the serving rows are
    built once and fanned out per role). The non-recursive part of each
    model becomes a per-month offset; the fold then walks the months in
    order, appending each clipped prediction to the history array.
    Output: (Family, FIPS, ModelRole, ModelName, date, Predicted_QTY).
    """
    folded = _fold(state, rows, models)
    keys = [*KEYS, "ModelRole", "ModelName"]
    out = folded.select(*keys, F.posexplode("steps").alias("_i", "_s"), "preds").select(
        *keys, F.col("_s")[MONTH].alias(MONTH),
        F.element_at("preds", F.col("_i") + 1).alias("Predicted_QTY"))
    d = F.col(MONTH)
    return out.filter((d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date")))


def _fold(state: DataFrame, rows: DataFrame, models: dict[str, LinearModel]) -> DataFrame:
    rec_feats = sorted({f for m in models.values() for f, c in m.coefs.items()
                        if f in RECURSIVE and c != 0.0})
    per_role = []
    for role, m in models.items():
        fixed = LinearModel(m.name, {f: c for f, c in m.coefs.items() if f not in RECURSIVE},
                            m.intercept)
        per_role.append(F.struct(
            F.lit(role).alias("ModelRole"), F.lit(m.name).alias("ModelName"),
            fixed.score().alias("off"),
            *[F.lit(float(m.coefs.get(f, 0.0))).alias(f"rc_{f}") for f in rec_feats]))
    fanned = rows.select(*KEYS, MONTH, F.col("_hi").alias("hi"),
                         F.explode(F.array(*per_role)).alias("_r"))
    steps = (fanned.groupBy(*KEYS, F.col("_r.ModelRole").alias("ModelRole"),
                            F.col("_r.ModelName").alias("ModelName"))
             .agg(F.sort_array(F.collect_list(F.struct(
                 MONTH, F.col("_r.off").alias("off"), "hi",
                 *[F.col(f"_r.rc_{f}").alias(f"rc_{f}") for f in rec_feats]))).alias("steps")))
    joined = state.join(steps, list(KEYS))

    def step(acc, s):
        feats = recursive_features(acc["h"], acc["ret"])
        raw = s["off"]
        for f in rec_feats:
            raw = raw + s[f"rc_{f}"] * feats[f]
        p = clip(raw, s["hi"])
        # no feature looks back further than the visible history: the state does not grow with the horizon
        return F.struct(_tail(F.concat(acc["h"], F.array(p)), VISIBLE).alias("h"), F.lit(0.0).alias("ret"),
                        F.concat(acc["p"], F.array(p)).alias("p"))

    init = F.struct(F.col("h").alias("h"), F.col("last_returns").alias("ret"),
                    F.array().cast("array<double>").alias("p"))
    keys = [*KEYS, "ModelRole", "ModelName"]
    return joined.select(*keys, "h", "last_date", "last_returns", "steps",
                         F.aggregate("steps", init, step)["p"].alias("preds"))


def horizon_targets(state: DataFrame, end) -> DataFrame:
    """Every month after each entity's last history month up to ``end``.

    ``end`` is a date or a column (a per-entity horizon); nothing when it is
    not after the last history month.
    """
    end_col = end if isinstance(end, Column) else F.lit(end).cast("date")
    first = F.add_months("last_date", 1)
    months = F.when(end_col >= first, F.sequence(first, end_col, F.expr("INTERVAL 1 MONTH"))) \
        .otherwise(F.array().cast("array<date>"))
    return state.select(*KEYS, F.explode(months).alias(MONTH))


def known_or_forecast(targets: DataFrame, history: DataFrame, forecast: DataFrame,
                      roles: list[str], last_actual) -> DataFrame:
    """R3 / F7: per (entity, month, role) the actual when known, else the model forecast.

    A month up to ``last_actual`` with a history row is ``historical_actual``;
    otherwise the recursive forecast of that month
    (``model_forecast_recursive_guardrailed``); a month with neither gets a
    null value and ``no_history_row_for_target`` (the source fails there).
    ``roles`` fan each target out once per model role (a literal array).
    """
    t = targets.select(*KEYS, MONTH, F.explode(F.array(*[F.lit(r) for r in roles])).alias("ModelRole"))
    h = history.select(*KEYS, MONTH, F.col("Sales_QTY").alias("_actual"))
    f = forecast.select(*KEYS, "ModelRole", MONTH, F.col("Predicted_QTY").alias("_pred"))
    j = t.join(h, [*KEYS, MONTH], "left").join(f, [*KEYS, "ModelRole", MONTH], "left")
    known = (F.col(MONTH) <= F.lit(last_actual).cast("date")) & F.col("_actual").isNotNull()
    return j.select(*KEYS, MONTH, "ModelRole",
                    F.when(known, F.col("_actual")).otherwise(F.col("_pred")).alias("Predicted_QTY"),
                    F.when(known, F.lit("historical_actual"))
                    .when(F.col("_pred").isNotNull(), F.lit("model_forecast_recursive_guardrailed"))
                    .otherwise(F.lit("no_history_row_for_target")).alias("feature_source"))
