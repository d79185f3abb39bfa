"""Binding of the shared driver tables to the panel's raw inputs.

Each builder returns the DataFrame a user would otherwise load from the
sales workbook, the weather/acreage/economic CSVs or the county dimension;
:data:`SQL` holds the same derivations as DuckDB CTEs for the oracle.

Concepts (fixed choices of this binding):

* family      = ``l_linestatus``              (two values, like two product families)
* entity FIPS = supplier key (dense panel) or customer key (sparse panel)
* State       = nation name of the entity, County = supplier / customer name
* month       = ship month (order month for the sparse panel)
* Sales QTY   = ``l_quantity``; Returns = quantity of lines with ``l_returnflag = 'R'``

Every builder pre-aggregates ``lineitem`` before joining a dimension, so a
hot key collapses in the map-side combine and never reaches a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.calendar import month_start
from panelcast.functions.fiscal import fiscal_label, month_name
from panelcast.session import materialize
from panelcast.sources.tables import table

RAW_SALES_COLUMNS = ["Year", "Month", "FIPS", "State", "Family", "Sales QTY",
                     "Returns/Credits QTY"]

# Fixed values of this binding: part-type word -> crop, order priority -> macro series. A word or
# priority that is not named here is a crop or series under its own name; none is left out.
CROP_OF_TYPE = {"ECONOMY": "CORN", "STANDARD": "SOYBEANS", "PROMO": "WHEAT", "SMALL": "COTTON"}
PRICE_OF_TYPE = {"ECONOMY": "Corn_Price_USDPerMT", "STANDARD": "Soybeans_Price_USDPerMT",
                 "PROMO": "Wheat_Price_USDPerMT", "SMALL": "Cotton_Price_USCentsPerLb"}
MACRO_OF_PRIORITY = {"1-URGENT": "CPI_AllUrban", "2-HIGH": "Fertilizer_PPI",
                     "3-MEDIUM": "WTI_Oil_Price"}
WEATHER_TYPES = ["PRCP", "TAVG", "TMAX", "TMIN"]


def _nation(spark, sf):
    # 25 rows by definition of the schema: safe to broadcast.
    return F.broadcast(table(spark, sf, "nation", "n_nationkey", "n_name"))


def _labels(monthly: DataFrame, id_col: str, float_text: F.Column) -> DataFrame:
    """Turn (id, state, family, month, sums) into the workbook's raw row shape.

    Ids of rows where ``float_text`` holds are written the way a spreadsheet
    exports a float (``'17.0'``), so the id normaliser has work to do.
    """
    fid = F.col(id_col).cast("string")
    return monthly.select(
        fiscal_label(F.col("month")).alias("Year"),
        month_name(F.col("month")).alias("Month"),
        F.when(float_text, F.concat(fid, F.lit(".0"))).otherwise(fid).alias("FIPS"),
        F.col("State"), F.col("Family"),
        F.col("qty").alias("Sales QTY"), F.col("ret").alias("Returns/Credits QTY"))


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Dense panel source: one row per (supplier, family, fiscal month)."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_quantity", "l_returnflag",
               "l_linestatus", "l_shipdate")
    monthly = (li.groupBy(F.col("l_suppkey"), F.col("l_linestatus").alias("Family"),
                          month_start(F.col("l_shipdate")).alias("month"))
               .agg(F.sum("l_quantity").alias("qty"),
                    F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
                          .otherwise(F.lit(0.0))).alias("ret")))
    sup = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    dim = sup.join(_nation(spark, sf), F.col("s_nationkey") == F.col("n_nationkey")) \
        .select("s_suppkey", F.col("n_name").alias("State"))
    joined = monthly.join(dim, F.col("l_suppkey") == F.col("s_suppkey"))
    return _labels(joined, "l_suppkey", F.col("Family") == "O")


def raw_sales_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse panel source: customers x order month (most cells empty)."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    per_order = (li.groupBy("l_orderkey", F.col("l_linestatus").alias("Family"))
                 .agg(F.sum("l_quantity").alias("qty"),
                      F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
                            .otherwise(F.lit(0.0))).alias("ret")))
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    monthly = (per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
               .groupBy("o_custkey", "Family", month_start(F.col("o_orderdate")).alias("month"))
               .agg(F.sum("qty").alias("qty"), F.sum("ret").alias("ret")))
    cust = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    dim = cust.join(_nation(spark, sf), F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", F.col("n_name").alias("State"))
    joined = monthly.join(dim, F.col("o_custkey") == F.col("c_custkey"))
    return _labels(joined, "o_custkey", F.col("Family") == "O")


def county_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Workbook county sheet: suppliers in good standing (balance >= 0)."""
    sup = table(spark, sf, "supplier", "s_suppkey", "s_name", "s_acctbal")
    return sup.filter(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").cast("string").alias("FIPS"), F.col("s_name").alias("County"))


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Gazetteer: every supplier, named ``'<name> County'``."""
    sup = table(spark, sf, "supplier", "s_suppkey", "s_name")
    return sup.select(F.col("s_suppkey").alias("GEOID"),
                      F.concat(F.col("s_name"), F.lit(" County")).alias("NAME"))


def weather_long(spark: SparkSession, sf: str) -> DataFrame:
    """Long weather table (FIPS, date, datatype, value) per supplier-month.

    TAVG only where the month had a returned line, TMIN only with >= 3 lines,
    so some months lack temperatures the way station records do.
    """
    li = table(spark, sf, "lineitem", "l_suppkey", "l_quantity", "l_discount",
               "l_returnflag", "l_shipdate")
    agg = (li.groupBy("l_suppkey", month_start(F.col("l_shipdate")).alias("date"))
           .agg((F.avg("l_discount") * 100).alias("PRCP"),
                F.when(F.count_if(F.col("l_returnflag") == "R") > 0,
                       F.avg("l_quantity") + 25).alias("TAVG"),
                (F.max("l_quantity") + 30).alias("TMAX"),
                F.when(F.count(F.lit(1)) >= 3, F.min("l_quantity")).alias("TMIN")))
    long = agg.select(F.col("l_suppkey").cast("string").alias("FIPS"), "date",
                      F.expr("stack(4, 'PRCP', PRCP, 'TAVG', TAVG, 'TMAX', TMAX, 'TMIN', TMIN)")
                      .alias("datatype", "value"))
    return long.filter(F.col("value").isNotNull())


def _type_word(col: str = "p_type") -> F.Column:
    return F.split(F.col(col), " ").getItem(0)


def _named(names: dict[str, str], key: F.Column, other: F.Column) -> F.Column:
    """The name that the binding gives to ``key``, else ``other``."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key), other)


def acreage_long(spark: SparkSession, sf: str) -> DataFrame:
    """Survey-style acreage: (year, state_alpha, commodity_desc, statisticcat_desc, Value).

    ``Value`` is text with thousands separators; cells backed by fewer than
    three lines are withheld as ``'(D)'``. A second statistic (AREA
    HARVESTED) is present so the category filter matters.
    """
    li = table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    part = table(spark, sf, "part", "p_partkey", "p_type")
    crops = part.select("p_partkey", _named(CROP_OF_TYPE, _type_word(), _type_word()).alias("crop")) \
        .filter(F.col("crop").isNotNull())
    # aggregated before the join, so a hot part is one row per supplier and year
    per_part = (li.groupBy(F.year("l_shipdate").alias("year"), "l_suppkey", "l_partkey")
                .agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n")))
    per_supp = (per_part.join(crops, F.col("l_partkey") == F.col("p_partkey"))
                .groupBy("year", "l_suppkey", "crop").agg(F.sum("q").alias("q"), F.sum("n").alias("n")))
    sup = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    dim = sup.join(_nation(spark, sf), F.col("s_nationkey") == F.col("n_nationkey")) \
        .select("s_suppkey", F.col("n_name").alias("state_alpha"))
    cells = (per_supp.join(dim, F.col("l_suppkey") == F.col("s_suppkey"))
             .groupBy("year", "state_alpha", F.col("crop").alias("commodity_desc"))
             .agg(F.sum("q").alias("q"), F.sum("n").alias("n")))
    text = F.when(F.col("n") < 3, F.lit("(D)")).otherwise(F.format_number(F.col("q"), 0))
    harvested = F.when(F.col("n") < 3, F.lit("(D)")).otherwise(
        F.format_number(F.col("q") * 0.9, 0))
    return cells.select(
        F.col("year").cast("int").alias("year"), "state_alpha", "commodity_desc",
        F.expr("stack(2, 'AREA PLANTED', 0, 'AREA HARVESTED', 1)").alias("statisticcat_desc", "k"),
        text.alias("_p"), harvested.alias("_h")) \
        .select("year", "state_alpha", "commodity_desc", "statisticcat_desc",
                F.when(F.col("k") == 0, F.col("_p")).otherwise(F.col("_h")).alias("Value"))


def _as_columns(long: DataFrame) -> DataFrame:
    """(date, series, v), unique by date and series, with one column per series found.

    The values (months x series) are written once: finding the names would else work them out a second time.
    """
    return materialize(long, "series").groupBy("date").pivot("series").agg(F.first("v"))


def economic_macro(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly macro series, one column per priority class found: mean order value in thousands."""
    o = table(spark, sf, "orders", "o_totalprice", "o_orderdate", "o_orderpriority")
    other = F.concat(F.lit("Orders_"), F.regexp_replace("o_orderpriority", "[^A-Za-z0-9]+", "_"))
    long = (o.select(month_start(F.col("o_orderdate")).alias("date"),
                     _named(MACRO_OF_PRIORITY, F.col("o_orderpriority"), other).alias("series"),
                     (F.col("o_totalprice") / 1000).alias("v"))
            .filter(F.col("series").isNotNull())
            .groupBy("date", "series").agg(F.avg("v").alias("v")))
    return _as_columns(long)


def crop_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly crop prices, one column per part-type word found: mean unit price of shipped parts."""
    li = table(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    part = table(spark, sf, "part", "p_partkey", "p_type")
    other = F.concat(F.initcap(_type_word()), F.lit("_Price"))
    ptype = part.select("p_partkey", _named(PRICE_OF_TYPE, _type_word(), other).alias("series")) \
        .filter(F.col("series").isNotNull())
    per_part = (li.groupBy("l_partkey", month_start(F.col("l_shipdate")).alias("date"))
                .agg(F.sum("l_extendedprice").alias("px"), F.sum("l_quantity").alias("q")))
    return _as_columns(per_part.join(ptype, F.col("l_partkey") == F.col("p_partkey"))
                       .groupBy("date", "series").agg((F.sum("px") / F.sum("q")).alias("v")))


# ---------------------------------------------------------------------------
# DuckDB oracle: the same derivations as CTEs. ``sql_with(names, body)``
# prepends the named CTEs (and their dependencies) to a final SELECT.
# ---------------------------------------------------------------------------

_MONTH_CASE = "CASE month({d}) " + " ".join(
    f"WHEN {i} THEN '{n}'" for i, n in enumerate(
        ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST",
         "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"], start=1)) + " END"


def _labels_sql(id_col: str) -> str:
    return f"""SELECT 'F' || CAST(year(month) + CASE WHEN month(month) >= 10 THEN 1 ELSE 0 END AS VARCHAR) AS "Year",
  {_MONTH_CASE.format(d='month')} AS "Month",
  CASE WHEN Family = 'O' THEN CAST({id_col} AS VARCHAR) || '.0' ELSE CAST({id_col} AS VARCHAR) END AS FIPS,
  State, Family, qty AS "Sales QTY", ret AS "Returns/Credits QTY\""""


SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_sales": ((), _labels_sql("l_suppkey") + """
FROM (SELECT l_suppkey, l_linestatus AS Family, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
             sum(l_quantity) AS qty, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS ret
      FROM lineitem GROUP BY ALL) m
JOIN supplier ON l_suppkey = s_suppkey JOIN (SELECT n_nationkey, n_name AS State FROM nation) n ON s_nationkey = n_nationkey"""),
    "raw_sales_sparse": ((), _labels_sql("o_custkey") + """
FROM (SELECT o_custkey, Family, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             sum(qty) AS qty, sum(ret) AS ret
      FROM (SELECT l_orderkey, l_linestatus AS Family, sum(l_quantity) AS qty,
                   sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS ret
            FROM lineitem GROUP BY ALL) po JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) m
JOIN customer ON o_custkey = c_custkey JOIN (SELECT n_nationkey, n_name AS State FROM nation) n ON c_nationkey = n_nationkey"""),
    "county_dimension": ((), """SELECT CAST(s_suppkey AS VARCHAR) AS FIPS, s_name AS County
FROM supplier WHERE s_acctbal >= 0"""),
    "gazetteer": ((), """SELECT s_suppkey AS GEOID, s_name || ' County' AS NAME FROM supplier"""),
    "weather_long": ((), """SELECT FIPS, date, datatype, value FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS FIPS, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         avg(l_discount) * 100 AS PRCP,
         CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN avg(l_quantity) + 25 END AS TAVG,
         max(l_quantity) + 30 AS TMAX,
         CASE WHEN count(*) >= 3 THEN min(l_quantity) END AS TMIN
  FROM lineitem GROUP BY ALL) a
UNPIVOT (value FOR datatype IN (PRCP, TAVG, TMAX, TMIN))"""),
    # Numeric form of the acreage survey after the tolerant parse: withheld
    # cells ('(D)') are already gone; only AREA PLANTED survives the filter.
    "acreage_planted": ((), """SELECT year, state_alpha, commodity_desc, q AS Value FROM (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, n_name AS state_alpha,
         CASE split_part(p_type, ' ', 1) WHEN 'ECONOMY' THEN 'CORN' WHEN 'STANDARD' THEN 'SOYBEANS'
              WHEN 'PROMO' THEN 'WHEAT' WHEN 'SMALL' THEN 'COTTON' ELSE split_part(p_type, ' ', 1) END AS commodity_desc,
         sum(l_quantity) AS q, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL) c WHERE commodity_desc IS NOT NULL AND n >= 3"""),
    "economic_macro": ((), """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  avg(o_totalprice / 1000) FILTER (WHERE o_orderpriority = '1-URGENT') AS CPI_AllUrban,
  avg(o_totalprice / 1000) FILTER (WHERE o_orderpriority = '2-HIGH') AS Fertilizer_PPI,
  avg(o_totalprice / 1000) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS WTI_Oil_Price,
  avg(o_totalprice / 1000) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS Orders_4_NOT_SPECIFIED,
  avg(o_totalprice / 1000) FILTER (WHERE o_orderpriority = '5-LOW') AS Orders_5_LOW
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1"""),
    "crop_prices": ((), """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
  sum(l_extendedprice) FILTER (WHERE w = 'SMALL') / sum(l_quantity) FILTER (WHERE w = 'SMALL') AS Cotton_Price_USCentsPerLb,
  sum(l_extendedprice) FILTER (WHERE w = 'ECONOMY') / sum(l_quantity) FILTER (WHERE w = 'ECONOMY') AS Corn_Price_USDPerMT,
  sum(l_extendedprice) FILTER (WHERE w = 'STANDARD') / sum(l_quantity) FILTER (WHERE w = 'STANDARD') AS Soybeans_Price_USDPerMT,
  sum(l_extendedprice) FILTER (WHERE w = 'PROMO') / sum(l_quantity) FILTER (WHERE w = 'PROMO') AS Wheat_Price_USDPerMT,
  sum(l_extendedprice) FILTER (WHERE w = 'MEDIUM') / sum(l_quantity) FILTER (WHERE w = 'MEDIUM') AS Medium_Price,
  sum(l_extendedprice) FILTER (WHERE w = 'LARGE') / sum(l_quantity) FILTER (WHERE w = 'LARGE') AS Large_Price
FROM lineitem JOIN (SELECT p_partkey, split_part(p_type, ' ', 1) AS w FROM part) p ON l_partkey = p_partkey
WHERE w IS NOT NULL GROUP BY 1"""),
}


RECURSIVE_COLUMNS: dict[str, str] = {}


def register_sql(name: str, deps: tuple[str, ...], body: str, recursive_columns: str = "") -> None:
    SQL[name] = (deps, body)
    if recursive_columns:
        RECURSIVE_COLUMNS[name] = recursive_columns


def sql_with(names, final: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in SQL[n][0]:
            visit(d)
        order.append(n)

    for n in ([names] if isinstance(names, str) else names):
        visit(n)
    if not order:
        return final
    ctes = ",\n".join(
        f"{n}({RECURSIVE_COLUMNS[n]}) AS (\n{SQL[n][1]}\n)" if n in RECURSIVE_COLUMNS
        else f"{n} AS (\n{SQL[n][1]}\n)" for n in order)
    head = "WITH RECURSIVE" if any(n in RECURSIVE_COLUMNS for n in order) else "WITH"
    return f"{head} {ctes}\n{final}"
