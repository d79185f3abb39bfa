"""Serving lookups built from the feature panel (per family, keyed by entity)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.features import outside_features
from panelcast.operators.static import with_shares

KEYS = ("Family", "FIPS")
MONTH = "date"
TRAILING = 24


def trailing_history(panel: DataFrame, n: int = TRAILING) -> DataFrame:
    """The ``n`` latest months per entity (``row_number`` over the entity partition)."""
    w = Window.partitionBy(*KEYS).orderBy(F.col(MONTH).desc())
    return (panel.select(*KEYS, MONTH, "Sales_QTY", "Returns_QTY")
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn"))


def national_trailing(panel: DataFrame) -> DataFrame:
    """Monthly national total per family over the panel rows."""
    return panel.groupBy("Family", MONTH).agg(F.sum("Sales_QTY").alias("Sales_QTY"))


def entity_static(panel: DataFrame, shares: DataFrame) -> DataFrame:
    """Name and state per entity, from its earliest row with a value, with its static ``shares``.

    ``shares`` are as of the month that is served from, not as of the training cut-off of ``panel``.
    """
    names = panel.groupBy(*KEYS).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(MONTH))).alias(c) for c in ("County_Name", "State")])
    return with_shares(names, shares, [*KEYS, "State"])


def external_lookup(panel: DataFrame, features: list[str]) -> DataFrame:
    ext = [c for c in outside_features(features) if c in panel.columns]
    return panel.select(*KEYS, MONTH, *ext)


def guardrail_bounds(panel: DataFrame) -> DataFrame:
    """Largest monthly volume per (entity, calendar month) over the full history."""
    return (panel.groupBy(*KEYS, F.month(MONTH).cast("int").alias("calendar_month"))
            .agg(F.max("Sales_QTY").alias("max_qty")))
