"""Feature attribution of linear scorers, ranking, shares and importance roll-ups.

Attribution of a linear model is ``coef * x`` per feature (E1). Tree models
plug in through the same long (keys, Feature, SHAP_Value) shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.features import (outside_features,
                                          friendly_name_expr)
from panelcast.operators.scoring import LinearModel

TOP_K = 5
TOP_VOLUME = 30


def with_roles(x: DataFrame, models: dict[str, LinearModel]) -> DataFrame:
    """Rows fanned out to every role, with its model's name."""
    roles = F.array(*[F.struct(F.lit(r).alias("ModelRole"), F.lit(m.name).alias("ModelName")) for r, m in models.items()])
    return x.select("*", F.explode(roles).alias("_r")).select(*x.columns, "_r.ModelRole", "_r.ModelName")


def contributions(x: DataFrame, keys: list[str], models: dict[str, LinearModel], features: list[str]) -> DataFrame:
    """One row per (keys, role) with the value ``coef * coalesce(x, 0)`` of every feature, in feature order.

    ``x`` has a row per (keys, ``ModelRole``). Features the model has no coefficient for contribute 0.
    """
    def values(m: LinearModel) -> Column:
        return F.array(*[F.lit(float(m.coefs.get(f, 0.0))) * F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])

    vals = None
    for role, m in models.items():
        at = F.col("ModelRole") == role
        vals = F.when(at, values(m)) if vals is None else vals.when(at, values(m))
    return x.select(*keys, "ModelRole", "ModelName", vals.alias("vals"))


def contributions_long(contributed: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """One row per (keys, role, feature)."""
    names = F.array(*[F.lit(f) for f in features])
    return contributed.select(*keys, "ModelRole", "ModelName", F.explode(F.arrays_zip(names.alias("Feature"), F.col("vals").alias("v"))).alias("_c")) \
        .select(*keys, "ModelRole", "ModelName", F.col("_c.Feature").alias("Feature"), F.col("_c.v").alias("SHAP_Value"))


def ranked_arrays(contributed: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """External features as an array by |value| descending (ties: feature order), and the external share.

    ``External_Factors_Share_Pct = 100 * sum|external| / sum|all|`` rounded to
    one decimal (0 when all are 0); values are rounded to 2 after ranking. An entity's
    features stay in its row: no shuffle.
    """
    outside = set(outside_features(features))
    at = [i for i, f in enumerate(features) if f in outside]
    vals = F.col("vals")
    # rank on |value| rounded to 9 dp: float noise (1e-16 vs 0) must not reorder ties
    entries = F.array(*[F.struct((F.lit(0.0) - F.round(F.abs(vals[i]), 9)).alias("k"), F.lit(features[i]).alias("Feature"),
                                 vals[i].alias("v")) for i in at]) if at else F.array().cast("array<struct<k:double,Feature:string,v:double>>")

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + F.abs(v))

    held = contributed.select(*keys, "ModelRole", "ModelName", total(vals).alias("_tot"), F.sort_array(entries).alias("_e"))
    outer = F.aggregate("_e", F.lit(0.0), lambda acc, e: acc + F.abs(e["v"]))
    share = F.when(F.col("_tot") > 0, F.round(outer / F.col("_tot") * 100, 1)).otherwise(F.lit(0.0))
    ranked = F.transform("_e", lambda e: F.struct(e["Feature"].alias("Feature"), F.round(e["v"], 2).alias("SHAP_Value")))
    return held.select(*keys, "ModelRole", "ModelName", share.alias("External_Factors_Share_Pct"), ranked.alias("ranked"))


def rank_external(arrays: DataFrame, keys: list[str]) -> DataFrame:
    """One row per external feature, with its rank."""
    return arrays.select(*keys, "ModelRole", "ModelName", "External_Factors_Share_Pct", F.posexplode("ranked").alias("_i", "_e")).select(
        *keys, "ModelRole", "ModelName", F.col("_e.Feature").alias("Feature"), F.col("_e.SHAP_Value").alias("SHAP_Value"),
        "External_Factors_Share_Pct", (F.col("_i") + 1).alias("Rank"))


def top_k_wide(arrays: DataFrame, keys: list[str], k: int = TOP_K) -> DataFrame:
    """``Top{i}_Feature`` / ``Top{i}_SHAP`` columns for ranks 1..k."""
    cells = []
    for i in range(1, k + 1):
        one = F.try_element_at("ranked", F.lit(i))
        cells += [one["Feature"].alias(f"Top{i}_Feature"), one["SHAP_Value"].alias(f"Top{i}_SHAP")]
    return arrays.select(*keys, "ModelRole", "ModelName", "External_Factors_Share_Pct", *cells)


def county_importance(ranked: DataFrame, names: DataFrame) -> DataFrame:
    """County-level long importance rows (external features only) from :func:`rank_external`."""
    r = ranked.join(names, ["Family", "FIPS"], "left")
    return r.select(F.lit("County").alias("Level"), "FIPS", "County_Name", "State", "Family",
                    F.initcap("ModelRole").alias("ModelRole"), "ModelName", "Feature",
                    friendly_name_expr(F.col("Feature")).alias("Friendly_Name"), "SHAP_Value",
                    F.lit(True).alias("Is_External"), F.col("Rank").cast("int").alias("Rank"))


def top_volume_entities(history: DataFrame, n: int = TOP_VOLUME) -> DataFrame:
    """The ``n`` entities with the largest trailing volume per family (ties: id order).

    A per-family top-n: ``row_number`` over a one-row-per-entity aggregate.
    """
    tot = history.groupBy("Family", "FIPS").agg(F.sum("Sales_QTY").alias("_v"))
    w = Window.partitionBy("Family").orderBy(F.col("_v").desc(), F.col("FIPS").asc())
    return tot.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n) \
        .select("Family", "FIPS")


def global_importance_linear(sample: DataFrame, models: dict[str, LinearModel],
                             features: list[str]) -> DataFrame:
    """National importance of linear models: ``|coef * mean(x)|`` over a sample (4 dp).

    ``sample`` holds feature rows (missing -> 0) of the top-volume entities, per ``ModelRole``.
    """
    means = sample.groupBy("Family", "ModelRole", "ModelName").agg(
        *[F.avg(F.coalesce(F.col(f).cast("double"), F.lit(0.0))).alias(f) for f in features])
    each = contributions(means, ["Family"], models, features)
    return national_rows(each.withColumn("vals", F.transform("vals", lambda v: F.round(F.abs(v), 4))), features)


def national_rows(each: DataFrame, features: list[str]) -> DataFrame:
    """Rows of the importance table from one array of values per (Family, role)."""
    disp = outside_features(features, derived=False)
    long = contributions_long(each, ["Family"], features)
    none = [F.lit(None).cast("string").alias(c) for c in ("FIPS", "County_Name", "State")]
    return long.select(F.lit("National").alias("Level"), *none, "Family", F.initcap("ModelRole").alias("ModelRole"), "ModelName", "Feature",
                       friendly_name_expr(F.col("Feature")).alias("Friendly_Name"), "SHAP_Value",
                       F.col("Feature").isin(disp).alias("Is_External"), F.lit(None).cast("int").alias("Rank"))


def global_importance_absolute(contributed: DataFrame, features: list[str]) -> DataFrame:
    """National importance of tree models: mean |value| per feature over the rows given (4 dp).

    The arrays are added up element by element with partial sums, never exploded.
    """
    sums = contributed.groupBy("Family", "ModelRole", "ModelName").agg(
        *[F.avg(F.abs(F.col("vals")[i])).alias(f"_{i}") for i in range(len(features))])
    each = sums.select("Family", "ModelRole", "ModelName", F.array(*[F.round(f"_{i}", 4) for i in range(len(features))]).alias("vals"))
    return national_rows(each, features)


def state_importance(importance: DataFrame, forecast: DataFrame, weight_month) -> DataFrame:
    """Volume-weighted mean of county importance per (State, Family, role, feature).

    Weight = the county's forecast at ``weight_month``; missing or below
    0.01 becomes 0.01, so the denominator is never 0. Rounded to 3.
    """
    county = importance.filter((F.col("Level") == "County") & F.col("State").isNotNull())
    wts = forecast.filter(F.col("date") == F.lit(weight_month).cast("date")).select(
        "FIPS", "Family", "ModelRole", F.col("Predicted_QTY").alias("_w"))
    j = county.join(wts, ["FIPS", "Family", "ModelRole"], "left").withColumn(
        "_w", F.greatest(F.coalesce(F.col("_w"), F.lit(0.01)), F.lit(0.01)))
    g = j.groupBy("State", "Family", "ModelRole", "Feature").agg(
        (F.sum(F.col("SHAP_Value") * F.col("_w")) / F.sum("_w")).alias("_v"),
        F.min("ModelName").alias("ModelName"), F.min("Friendly_Name").alias("Friendly_Name"))
    return g.select(F.lit("State").alias("Level"), F.lit(None).cast("string").alias("FIPS"),
                    F.lit(None).cast("string").alias("County_Name"), "State", "Family",
                    "ModelRole", "ModelName", "Feature", "Friendly_Name",
                    F.round("_v", 3).alias("SHAP_Value"), F.lit(True).alias("Is_External"),
                    F.lit(None).cast("int").alias("Rank"))


# Columns of the importance table, in order.
IMPORTANCE_COLUMNS = ["Level", "FIPS", "County_Name", "State", "Family", "ModelRole", "ModelName",
                      "Feature", "Friendly_Name", "SHAP_Value", "Is_External", "Rank"]


def all_levels(*parts: DataFrame) -> DataFrame:
    out = None
    for p in parts:
        p = p.select(*IMPORTANCE_COLUMNS)
        out = p if out is None else out.unionByName(p)
    return out
