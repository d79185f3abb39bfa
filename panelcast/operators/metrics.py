"""Time split, holdout scoring, accuracy metrics, tiers, roll-up and gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.tiers import confidence_tier, r2_category, volume_tier

MONTH = "date"
R2_THRESHOLD = 0.7


def split(df: DataFrame, cutoff, val_start, val_end) -> tuple[DataFrame, DataFrame]:
    """Train ``date <= cutoff``; validation ``val_start <= date <= val_end`` (inclusive)."""
    d = F.col(MONTH)
    train = df.filter(d <= F.lit(cutoff).cast("date"))
    val = df.filter((d >= F.lit(val_start).cast("date")) & (d <= F.lit(val_end).cast("date")))
    return train, val


def holdout_predictions(val: DataFrame, pred: Column, *, family_role: str, model_name: str,
                        target: str = "Sales_QTY") -> DataFrame:
    """Validation rows with a non-negative prediction, in the exported shape."""
    return val.select(
        "FIPS", "County_Name", "State", MONTH,
        F.col(target).alias("Actual_QTY"),
        F.greatest(pred, F.lit(0.0)).alias("Predicted_QTY"),
        "Family", F.lit(family_role).alias("ModelRole"), F.lit(model_name).alias("ModelName"))


def _r2(sse: Column, sst: Column, n: Column) -> Column:
    """1 - SSE/SST; SST = 0 gives 1 when SSE = 0 else 0; fewer than 2 points -> null."""
    return (F.when(n < 2, F.lit(None).cast("double"))
            .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(1 - sse / sst))


def _moments(a: Column, p: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.sum(a).alias("_sy"),
            F.sum(F.pow(a - p, 2)).alias("_sse"),
            (F.var_pop(a) * F.count(F.lit(1))).alias("_sst"),
            F.sum(F.abs(a - p)).alias("_sabs"), F.sum(F.abs(a)).alias("_say")]


def national_metrics(val: DataFrame, *, by=("Family", "ModelRole", "ModelName"),
                     actual: str = "Actual_QTY", pred: str = "Predicted_QTY") -> DataFrame:
    """Sum actual and predicted per month first, then R2 / RMSE / MAE / WMAPE on the totals.

    Two aggregates: (group, month) then group; both are partial-aggregated,
    the second over one row per month.
    """
    monthly = val.groupBy(*by, MONTH).agg(F.sum(actual).alias("_a"), F.sum(pred).alias("_p"))
    g = monthly.groupBy(*by).agg(*_moments(F.col("_a"), F.col("_p")))
    n = F.col("_n")
    return g.select(*by,
                    _r2(F.col("_sse"), F.col("_sst"), n).alias("r2"),
                    F.sqrt(F.col("_sse") / n).alias("rmse"),
                    (F.col("_sabs") / n).alias("mae"),
                    F.when(F.col("_say") > 0, F.col("_sabs") / F.col("_say")).alias("wmape"),
                    n.cast("int").alias("n_months"))


def entity_accuracy(val: DataFrame, *, keys=("FIPS", "County_Name", "State", "Family", "ModelRole"),
                    actual: str = "Actual_QTY", pred: str = "Predicted_QTY") -> DataFrame:
    """Per-entity R2 / WMAPE / total with volume, R2 and confidence tiers.

    Groups with a null key are dropped (as a pandas group-by does); groups
    with zero total or fewer than two rows are not scored. Tiers read the
    rounded values.
    """
    ok = None
    for k in keys:
        ok = F.col(k).isNotNull() if ok is None else ok & F.col(k).isNotNull()
    g = val.filter(ok).groupBy(*keys).agg(*_moments(F.col(actual), F.col(pred)))
    g = g.filter((F.col("_sy") != 0) & (F.col("_n") >= 2))
    out = g.select(*keys,
                   F.round(_r2(F.col("_sse"), F.col("_sst"), F.col("_n")), 4).alias("R2"),
                   F.round(F.when(F.col("_say") > 0, F.col("_sabs") / F.col("_say")), 4).alias("WMAPE"),
                   F.round(F.col("_sy"), 2).alias("Actual_Total"))
    out = out.withColumn("Volume_Tier", volume_tier(F.col("Actual_Total"))) \
             .withColumn("R2_Category", r2_category(F.col("R2")))
    return out.withColumn("Confidence_Tier", confidence_tier(F.col("Volume_Tier"), F.col("R2_Category")))


def evaluation_records(metrics: DataFrame, train: DataFrame, val: DataFrame, *, cutoff, val_start,
                       val_end, by=("Family", "ModelRole")) -> DataFrame:
    """Metrics + train/validation sizes + window dates, one row per (family, role)."""
    sizes_t = train.groupBy("Family").agg(F.count(F.lit(1)).alias("train_size"))
    sizes_v = val.groupBy("Family").agg(F.count(F.lit(1)).alias("val_size"))
    # one row per family each: bounded by the family count
    return (metrics.join(F.broadcast(sizes_t), "Family", "left")
            .join(F.broadcast(sizes_v), "Family", "left")
            .withColumns({"train_cutoff": F.lit(str(cutoff)), "val_start": F.lit(str(val_start)),
                          "val_end": F.lit(str(val_end))}))


def metrics_rollup(records: DataFrame) -> DataFrame:
    """One row per ``{family}_{role}`` key with the fields of the evaluation summary."""
    return records.select(
        F.concat_ws("_", F.lower("Family"), F.col("ModelRole")).alias("key"),
        F.col("ModelName").alias("model_type"), "r2", "rmse", "mae",
        "wmape",  # null when undefined; rendered as "N/A" in the JSON document
        "train_size", "val_size",
        F.coalesce(*[F.col(c).cast("string") for c in ("train_cutoff", "holdout_cutoff") if c in records.columns],
                   F.lit("N/A")).alias("train_cutoff"),
        F.coalesce(F.col("val_start"), F.lit("N/A")).alias("val_start"),
        F.coalesce(F.col("val_end"), F.lit("N/A")).alias("val_end"))


def quality_gate(metrics: DataFrame, threshold: float = R2_THRESHOLD) -> DataFrame:
    """Mark each (family, role) as approved when r2 >= threshold."""
    return metrics.withColumn("approved", F.coalesce(F.col("r2") >= threshold, F.lit(False)))


def require_keys(found: DataFrame, expected: DataFrame, key: str = "key") -> DataFrame:
    """Expected keys with no record, all listed at once (empty when complete)."""
    return expected.join(found.select(key), key, "left_anti")


def latest_approved(registry: DataFrame, *, group: str = "group", created: str = "created") -> DataFrame:
    """O7: the newest approved version per group; groups with none are reported, not dropped.

    ``registry`` has one row per (group, version) with ``approved``. The
    result has one row per group: the chosen version's columns, or nulls and
    ``has_approved = false`` (the source stops the deployment in that case).
    """
    from pyspark.sql import Window
    w = Window.partitionBy(group).orderBy(F.col(created).desc())
    best = registry.filter(F.col("approved")).withColumn("_rn", F.row_number().over(w)) \
        .filter(F.col("_rn") == 1).drop("_rn", "approved")
    groups = registry.select(group).distinct()
    return groups.join(best, group, "left").withColumn("has_approved", F.col(created).isNotNull())
