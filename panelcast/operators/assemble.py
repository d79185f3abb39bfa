"""Assemble the full feature panel (internal + external + static + names)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.features import panel_columns
from panelcast.operators.external import economic_changes
from panelcast.operators.static import add_static_shares

MONTH = "date"


def assemble(internal: DataFrame, weather: DataFrame, acreage: DataFrame, econ: DataFrame,
             names: DataFrame, months: DataFrame, cutoff, monthly: DataFrame | None = None) -> DataFrame:
    """Left-join every external table onto the internal panel, add static shares and names.

    ``monthly`` is the dense monthly panel that ``internal`` was made of: the shares are
    taken from it, not from the joined frame. ``months`` lists the months of each family: the series of these have one row per
    family and month (bounded by the calendar) and are broadcast; the other tables are per entity and join on the panel's entity partitioning.
    These are hashed within their partition (an entity has a row per month, year or family): the panel's wide rows stream past and are never sorted.
    """
    d = internal.join(weather.hint("shuffle_hash"), ["FIPS", MONTH], "left")
    d = d.withColumn("Year", F.year(MONTH))
    d = d.join(acreage.drop("State").hint("shuffle_hash"), ["FIPS", "Year"], "left")
    d = d.join(F.broadcast(economic_changes(econ, months)), ["Family", MONTH], "left")
    d = add_static_shares(d, cutoff, monthly=monthly)
    d = d.join(names.hint("shuffle_hash"), "FIPS", "left")
    return d.select(*panel_columns(d.columns))
