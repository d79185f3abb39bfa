"""External feature tables: weather, crop acreage, entity names, economic series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import month_start
from panelcast.functions.weather import chu_proxy, gdd_proxy, presence_flag, tolerant_number

ENTITY, MONTH = "FIPS", "date"
WEATHER_TYPES = ["PRCP", "TAVG", "TMAX", "TMIN"]
WEATHER_KEEP = ["FIPS", "date", "PRCP", "TAVG", "TMAX", "TMIN", "GDD_proxy", "CHU_proxy",
                "Precip_Anomaly", "has_temperature_data"]

# Manual entity-name overrides (id -> name), applied as an upsert.
MANUAL_NAMES = {
    "09001": "Fairfield County", "09003": "Hartford County", "09005": "Litchfield County",
    "09007": "Middlesex County", "09009": "New Haven County", "09011": "New London County",
    "09013": "Tolland County", "09015": "Windham County",
    "12025": "Dade County",
}


def zfill_id(c, width: int = 5):
    """Pad to ``width`` with zeros, never truncating (no ``.0`` handling)."""
    s = F.trim(c.cast("string"))
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def _first(value: str, order_col: str | None):
    """The first value by a source ordinal; without one the smallest, so that it never depends on task order."""
    if order_col:
        return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order_col)))
    return F.min(F.col(value))


def weather_pivot(long: DataFrame, *, types=WEATHER_TYPES, order_col: str | None = None) -> DataFrame:
    """(FIPS, date, datatype, value) -> one column per datatype, first value wins.

    Grouped on the raw date, then truncated to month (as the source does):
    two readings in one month stay two rows.
    """
    # partial aggregates first: raw readings of a hot entity never meet in one task
    df = long.withColumn(ENTITY, zfill_id(F.col(ENTITY)))
    piv = df.groupBy(ENTITY, MONTH).pivot("datatype", list(types)).agg(_first("value", order_col))
    return piv.withColumn(MONTH, month_start(F.col(MONTH)))


def weather_features(long: DataFrame, **kw) -> DataFrame:
    """Pivot + growing-degree / heat-unit proxies + precipitation anomaly + presence flag.

    The precipitation normal is the mean per (entity, calendar month) over
    all years: a window partitioned by entity and month (a few rows each).
    """
    p = weather_pivot(long, **kw)
    normal = F.avg("PRCP").over(Window.partitionBy(ENTITY, F.month(MONTH)))
    out = p.withColumns({
        "GDD_proxy": gdd_proxy(F.col("TAVG")),
        "CHU_proxy": chu_proxy(F.col("TMAX"), F.col("TMIN")),
        "Precip_Anomaly": F.col("PRCP") - normal,
        "has_temperature_data": presence_flag(F.col("TAVG")),
    })
    return out.select(*WEATHER_KEEP)


def acreage_prior_year(long: DataFrame, entity_state_year: DataFrame, *,
                       commodities: list[str] | None = None, order_col: str | None = None) -> DataFrame:
    """Survey acreage -> ``{crop}_Acres_prior_year`` per (FIPS, State, Year).

    Keeps AREA PLANTED rows whose text parses as a number, pivots crops,
    lags one row per state ordered by year (a missing year shifts the lag,
    like the source) and left-joins onto the entity-state-year map.
    """
    usda = (long.filter(F.col("statisticcat_desc") == "AREA PLANTED")
            .withColumn("Value", tolerant_number(F.col("Value")))
            .filter(F.col("Value").isNotNull()))
    if commodities is None:
        # the crop dimension: a handful of names (bounded), needed to name columns
        commodities = sorted(r[0] for r in usda.select("commodity_desc").distinct().collect())
    piv = (usda.groupBy(F.col("year").alias("Year"), F.col("state_alpha").alias("State"))
           .pivot("commodity_desc", commodities).agg(_first("Value", order_col)))
    w = Window.partitionBy("State").orderBy("Year")
    lagged = piv.select("Year", "State", *[F.lag(F.col(c), 1).over(w).alias(f"{c}_Acres_prior_year")
                                           for c in commodities])
    return entity_state_year.join(lagged, ["State", "Year"], "left")


def entity_names(dim: DataFrame, gaz: DataFrame, *, overrides: dict[str, str] | None = None,
                 id_col: str = "FIPS", name_col: str = "County",
                 gaz_id: str = "GEOID", gaz_name: str = "NAME") -> DataFrame:
    """Names from the workbook dimension, else the gazetteer, then manual overrides.

    Duplicate ids keep the smallest name (a deterministic stand-in for file order).
    """
    overrides = MANUAL_NAMES if overrides is None else overrides
    tbl = (dim.select(zfill_id(F.col(id_col)).alias(ENTITY), F.col(name_col).alias("_t"))
           .groupBy(ENTITY).agg(F.min("_t").alias("_t")))
    gz = (gaz.select(zfill_id(F.col(gaz_id)).alias(ENTITY), F.col(gaz_name).alias("_g"))
          .groupBy(ENTITY).agg(F.min("_g").alias("_g")))
    names = tbl.join(gz, ENTITY, "full").select(
        ENTITY, F.coalesce("_t", "_g").alias("County_Name"))
    ov = names.sparkSession.createDataFrame(sorted(overrides.items()),
                                           "FIPS string, County_Name string")
    # upsert = (names without an override) + overrides; the literal table has
    # a fixed size, so it is safe to broadcast
    return names.join(F.broadcast(ov.select(ENTITY)), ENTITY, "left_anti").unionByName(ov)


def economic(macro: DataFrame, prices: DataFrame) -> DataFrame:
    """Macro series full-outer-joined with crop prices on month."""
    return macro.join(prices, MONTH, "full")


def economic_changes(econ: DataFrame, months: DataFrame, *, family: str = "Family") -> DataFrame:
    """The series of every month of a family, with ``{c}_lag1`` and ``{c}_chg3m`` inside the family's months (row based).

    A series has one value a month, so its changes are worked out once a family, not once an entity.
    """
    cols = [c for c in econ.columns if c != MONTH]
    w = Window.partitionBy(family).orderBy(MONTH)
    out = {}
    for c in cols:
        out[f"{c}_lag1"] = F.lag(F.col(c), 1).over(w)
        out[f"{c}_chg3m"] = F.col(c) - F.lag(F.col(c), 3).over(w)
    return months.select(family, MONTH).join(econ, MONTH, "left").withColumns(out)
