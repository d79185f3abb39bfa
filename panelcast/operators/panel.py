"""Dense monthly panel and its time-safe features.

Layout: after the monthly aggregate the panel is hash-partitioned by the
entity id once. The grid join, every lag/rolling window, the per-entity
static aggregates and the weather / acreage / name joins are all keyed by a
superset of it, so they reuse that partitioning instead of shuffling again
(see ``spark.sql.requireAllClusterKeysForCoPartition`` in
:mod:`panelcast.session`). One entity holds at most families x months rows,
so the partitioning cannot skew after the aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import calendar_columns, time_index
from panelcast.functions.fiscal import calendar_year, fiscal_year, month_number
from panelcast.functions.ids import id_error, normalize_id

FAMILY, ENTITY, MONTH = "Family", "FIPS", "date"
LAGS = (1, 2, 3, 6, 12)
ROLL_WINDOWS = (3, 6, 12)


def load_raw(raw: DataFrame, *, year: str = "Year", month: str = "Month",
             entity: str = ENTITY) -> DataFrame:
    """Sales workbook rows -> fiscal parts, month-start ``date`` and normalised id.

    Month names match exactly (upper case). Unknown names give a null date.
    """
    fy = fiscal_year(F.col(year))
    m = month_number(F.col(month))
    return (raw.withColumn("fy", fy).withColumn("m", m)
            .withColumn("calendar_year", calendar_year(F.col("fy"), F.col("m")))
            .withColumn(MONTH, F.make_date(F.col("calendar_year"), F.col("m"), F.lit(1)))
            .withColumn(entity, normalize_id(F.col(entity))))


def monthly_panel(sales: DataFrame, *, measures: dict[str, str] | None = None,
                  attrs: tuple[str, ...] = ("State",), family: str = FAMILY,
                  entity: str = ENTITY, month: str = MONTH,
                  combine_first: bool = True) -> DataFrame:
    """Dense grid: every (family, entity, attrs) x every month of the family's span.

    Actuals are summed per (family, entity, month) (attributes are *not* in
    that key, like the source), left-joined onto the grid and zero-filled.
    The family span comes from a one-row-per-family aggregate that is
    broadcast: its size is the number of families.

    Partitioning: everything after this step is keyed by the entity.
    ``combine_first=True`` (default) aggregates first (map-side combine, so
    a hot entity never crosses the shuffle unaggregated) and then
    repartitions the small aggregate by entity. ``combine_first=False``
    shuffles ``sales`` by entity once and aggregates inside that partitioning
    — one exchange instead of two, right when ``sales`` rows are already
    about one per (family, entity, month), as a pre-aggregated source is.
    """
    measures = measures or {"Sales_QTY": "Sales QTY", "Returns_QTY": "Returns/Credits QTY"}
    keys = [family, entity]
    span = sales.groupBy(family).agg(F.min(month).alias("_d0"), F.max(month).alias("_d1"))
    if not combine_first:
        sales = sales.repartition(entity)
    sales = sales.filter(F.col(entity).isNotNull() & F.col(month).isNotNull())
    actual = (sales.groupBy(*keys, month)
              .agg(*[F.sum(F.col(src)).alias(dst) for dst, src in measures.items()]))
    members = sales.select(*keys, *attrs).distinct()
    if combine_first:
        actual, members = actual.repartition(entity), members.repartition(entity)
    grid = (members.join(F.broadcast(span), family)
            .select(*keys, *attrs,
                    F.explode(F.sequence("_d0", "_d1", F.expr("INTERVAL 1 MONTH"))).alias(month)))
    # an entity has one row per family and month: hashed in its partition, so the grid (mostly empty cells) is not sorted
    full = grid.join(actual.hint("shuffle_hash"), [*keys, month], "left")
    return full.select(*keys, *attrs, month,
                       *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in measures])


def family_months(sales: DataFrame, *, family: str = FAMILY, month: str = MONTH) -> DataFrame:
    """Every month of each family's span (bounded by the calendar)."""
    span = sales.groupBy(family).agg(F.min(month).alias("_d0"), F.max(month).alias("_d1"))
    return span.select(family, F.explode(F.sequence("_d0", "_d1", F.expr("INTERVAL 1 MONTH"))).alias(month))


def entity_window(family: str = FAMILY, entity: str = ENTITY, month: str = MONTH):
    return Window.partitionBy(family, entity).orderBy(month)


def shifted_rolling(x: Column, w, k: int, fn) -> Column:
    """``fn`` over the k rows before the current one, null unless all k exist."""
    frame = w.rowsBetween(-k, -1)
    return F.when(F.count(x).over(frame) == k, fn(x).over(frame))


def add_lags(df: DataFrame, col: str = "Sales_QTY", ks=LAGS, prefix: str = "fips_lag_",
             w=None) -> DataFrame:
    w = w or entity_window()
    return df.withColumns({f"{prefix}{k}": F.lag(col, k).over(w) for k in ks})


def add_rolling(df: DataFrame, col: str = "Sales_QTY", ws=ROLL_WINDOWS,
                prefix: str = "fips_roll", w=None) -> DataFrame:
    """Mean and sample std of the previous w values (full windows only)."""
    w = w or entity_window()
    x = F.col(col)
    out = {}
    for k in ws:
        out[f"{prefix}mean_{k}"] = shifted_rolling(x, w, k, F.avg)
        out[f"{prefix}std_{k}"] = shifted_rolling(x, w, k, F.stddev_samp)
    return df.withColumns(out)


def entity_state_years(sales: DataFrame, *, family: str = FAMILY, entity: str = ENTITY,
                       month: str = MONTH) -> DataFrame:
    """Distinct (entity, State, Year) of the dense grid, from members x family span years."""
    span = sales.groupBy(family).agg(F.year(F.min(month)).alias("_y0"),
                                     F.year(F.max(month)).alias("_y1"))
    members = sales.select(family, entity, "State").distinct()
    return (members.join(F.broadcast(span), family)
            .select(entity, "State", F.explode(F.sequence("_y0", "_y1")).alias("Year"))
            .distinct())


def national_series(sales: DataFrame, *, measure: str = "Sales QTY", family: str = FAMILY,
                    month: str = MONTH) -> DataFrame:
    """National monthly total per family from raw rows (months without sales are absent)."""
    return sales.filter(F.col(month).isNotNull()).groupBy(family, month).agg(F.sum(measure).alias("Sales_QTY"))


def rejects(sales: DataFrame, *, entity: str = ENTITY, month: str = MONTH) -> DataFrame:
    """How many parsed sales rows cannot be used, by reason: no entity id, or no known month."""
    reasons = {"entity_id": id_error(F.col(entity)).isNotNull(), "month": F.col(month).isNull()}
    counts = sales.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(r) for r, c in reasons.items()])
    one = F.explode(F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n_rejected")) for r in reasons]))
    return counts.select("n_rows", one.alias("_r")).select("_r.reason", "_r.n_rejected", "n_rows")


def national_features(national: DataFrame, *, family: str = FAMILY,
                      month: str = MONTH) -> DataFrame:
    """Lag 1, lag 12 and shifted 3-month mean of the national series (row based).

    Partitioned by family; each partition holds one row per month.
    """
    w = Window.partitionBy(family).orderBy(month)
    x = F.col("Sales_QTY")
    return national.select(family, month,
                           F.lag(x, 1).over(w).alias("national_lag_1"),
                           F.lag(x, 12).over(w).alias("national_lag_12"),
                           shifted_rolling(x, w, 3, F.avg).alias("national_rollmean_3"))


def add_calendar(df: DataFrame, month: str = MONTH) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(month)))


def add_time_index(df: DataFrame, *, base=None, family: str = FAMILY,
                   month: str = MONTH) -> DataFrame:
    """``(date - base) days // 30``; base = first month of the family's panel.

    The per-family base is a one-row-per-family aggregate, broadcast.
    """
    if base is not None:
        return df.withColumn("time_idx", time_index(F.col(month), F.lit(base).cast("date")))
    b = df.groupBy(family).agg(F.min(month).alias("_base"))
    return (df.join(F.broadcast(b), family)
            .withColumn("time_idx", time_index(F.col(month), F.col("_base"))).drop("_base"))


def internal_features(panel: DataFrame, national: DataFrame) -> DataFrame:
    """Calendar, time index, entity lags/rolling, returns lag, national context."""
    w = entity_window()
    # the first month of a family's panel is the first month of its national series
    base = national.groupBy(FAMILY).agg(F.min(MONTH).alias("_base"))
    df = (add_calendar(panel).join(F.broadcast(base), FAMILY)
          .withColumn("time_idx", time_index(F.col(MONTH), F.col("_base"))).drop("_base"))
    df = add_lags(df, w=w)
    df = add_rolling(df, w=w)
    df = df.withColumn("returns_lag_1", F.lag("Returns_QTY", 1).over(w))
    nat = national_features(national)
    # one row per (family, month): bounded by families x months of the calendar
    return df.join(F.broadcast(nat), [FAMILY, MONTH], "left")
