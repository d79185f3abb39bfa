"""DuckDB versions of the pipeline steps, as named CTEs (the SQL oracle).

Built on :data:`panelcast.sources.bindings.SQL`; ``sql_with`` assembles a
statement from the CTEs a query needs.
"""

from __future__ import annotations

from panelcast.sources.bindings import SQL, register_sql, sql_with  # noqa: F401

_MONTH_NUM = "CASE \"Month\" " + " ".join(
    f"WHEN '{n}' THEN {i}" for i, n in enumerate(
        ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST",
         "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"], start=1)) + " END"

NORM_ID = "CASE WHEN length({s}) < 5 THEN lpad({s}, 5, '0') ELSE {s} END"


def _panel(prefix: str, raw: str) -> None:
    """sales / monthly / members / span / grid / panel CTEs for one raw source."""
    register_sql(f"{prefix}sales", (raw,), f"""SELECT "Year", "Month", {NORM_ID.format(s='s')} AS FIPS, State, Family,
  "Sales QTY", "Returns/Credits QTY", fy, m,
  CASE WHEN m >= 10 THEN fy - 1 ELSE fy END AS calendar_year,
  make_date(CASE WHEN m >= 10 THEN fy - 1 ELSE fy END, m, 1) AS date
FROM (SELECT *, regexp_replace(trim(FIPS), '\\.0$', '') AS s,
             TRY_CAST(replace("Year", 'F', '') AS INTEGER) AS fy, {_MONTH_NUM} AS m
      FROM {raw}) x""")
    register_sql(f"{prefix}monthly", (f"{prefix}sales",), f"""SELECT Family, FIPS, date,
  sum("Sales QTY") AS Sales_QTY, sum("Returns/Credits QTY") AS Returns_QTY
FROM {prefix}sales GROUP BY Family, FIPS, date""")
    register_sql(f"{prefix}grid", (f"{prefix}sales",), f"""SELECT Family, FIPS, State, CAST(d AS DATE) AS date FROM (
  SELECT m.Family, m.FIPS, m.State,
         unnest(generate_series(CAST(s.d0 AS TIMESTAMP), CAST(s.d1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS d
  FROM (SELECT DISTINCT Family, FIPS, State FROM {prefix}sales) m
  JOIN (SELECT Family, min(date) AS d0, max(date) AS d1 FROM {prefix}sales GROUP BY Family) s
  USING (Family)) g""")
    register_sql(f"{prefix}panel", (f"{prefix}grid", f"{prefix}monthly"), f"""SELECT g.Family, g.FIPS, g.State, g.date,
  coalesce(a.Sales_QTY, 0.0) AS Sales_QTY, coalesce(a.Returns_QTY, 0.0) AS Returns_QTY
FROM {prefix}grid g LEFT JOIN {prefix}monthly a USING (Family, FIPS, date)""")


_panel("", "raw_sales")
_panel("sp_", "raw_sales_sparse")

# Timeline scalars of the dense panel.
register_sql("tl", ("sales",), """SELECT max(date) AS last_month,
  CAST(max(date) + INTERVAL 1 MONTH AS DATE) AS fc_start,
  CAST(max(date) + INTERVAL 24 MONTH AS DATE) AS fc_end,
  CAST(max(date) - INTERVAL 12 MONTH AS DATE) AS cutoff,
  CAST(max(date) - INTERVAL 11 MONTH AS DATE) AS val_start,
  min(date) AS first_month
FROM sales""")

register_sql("national", ("sales",), """SELECT Family, date, sum("Sales QTY") AS Sales_QTY
FROM sales GROUP BY Family, date""")

register_sql("national_feats", ("national",), """SELECT Family, date,
  lag(Sales_QTY, 1) OVER w AS national_lag_1,
  lag(Sales_QTY, 12) OVER w AS national_lag_12,
  CASE WHEN count(Sales_QTY) OVER w3 = 3 THEN avg(Sales_QTY) OVER w3 END AS national_rollmean_3
FROM national
WINDOW w AS (PARTITION BY Family ORDER BY date),
       w3 AS (PARTITION BY Family ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""")


def _roll(k: int, fn: str) -> str:
    return (f"CASE WHEN count(Sales_QTY) OVER w{k} = {k} THEN {fn}(Sales_QTY) OVER w{k} END")


CAL_SQL = """CAST(month(date) AS INTEGER) AS calendar_month,
  CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(((month(date) - 10) % 12 + 12) % 12 + 1 AS INTEGER) AS fiscal_month_idx,
  sin(month(date) * 2 * pi() / 12) AS month_sin,
  cos(month(date) * 2 * pi() / 12) AS month_cos,
  sin((((month(date) - 10) % 12 + 12) % 12 + 1) * 2 * pi() / 12) AS fiscal_sin,
  cos((((month(date) - 10) % 12 + 12) % 12 + 1) * 2 * pi() / 12) AS fiscal_cos,
  greatest(sin((month(date) - 3) * pi() / 7), 0.0) AS growing_season_proxy,
  CAST(month(date) IN (3, 4, 5) AS INTEGER) AS is_planting_season,
  CAST(month(date) IN (4, 5, 6, 7, 8) AS INTEGER) AS is_application_season,
  CAST(month(date) IN (9, 10, 11) AS INTEGER) AS is_harvest_season,
  CAST(month(date) IN (12, 1, 2) AS INTEGER) AS is_dormant_season"""

register_sql("internal", ("panel", "national_feats"), f"""SELECT p.*,
  {CAL_SQL},
  CAST(floor(date_diff('day', min(date) OVER (PARTITION BY Family), date) / 30) AS INTEGER) AS time_idx,
  lag(Sales_QTY, 1) OVER w AS fips_lag_1, lag(Sales_QTY, 2) OVER w AS fips_lag_2,
  lag(Sales_QTY, 3) OVER w AS fips_lag_3, lag(Sales_QTY, 6) OVER w AS fips_lag_6,
  lag(Sales_QTY, 12) OVER w AS fips_lag_12,
  {_roll(3, 'avg')} AS fips_rollmean_3, {_roll(3, 'stddev_samp')} AS fips_rollstd_3,
  {_roll(6, 'avg')} AS fips_rollmean_6, {_roll(6, 'stddev_samp')} AS fips_rollstd_6,
  {_roll(12, 'avg')} AS fips_rollmean_12, {_roll(12, 'stddev_samp')} AS fips_rollstd_12,
  lag(Returns_QTY, 1) OVER w AS returns_lag_1,
  n.national_lag_1, n.national_lag_12, n.national_rollmean_3
FROM panel p LEFT JOIN national_feats n USING (Family, date)
WINDOW w AS (PARTITION BY Family, FIPS ORDER BY date),
  w3 AS (PARTITION BY Family, FIPS ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
  w6 AS (PARTITION BY Family, FIPS ORDER BY date ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING),
  w12 AS (PARTITION BY Family, FIPS ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)""")

register_sql("static", ("panel", "tl"), """SELECT m.Family, m.FIPS, m.State,
  coalesce(CASE WHEN f.ftot > 0 THEN e.etot / f.ftot END, 0.0) AS county_alltime_share,
  coalesce(CASE WHEN f.frec > 0 THEN e.erec / f.frec END, 0.0) AS county_recent_share,
  coalesce(CASE WHEN f.ftot > 0 THEN s.stot / f.ftot END, 0.0) AS state_share,
  CAST(coalesce(e.eactive, 0) AS DOUBLE) AS county_active_months,
  CAST(coalesce(e.eactive, 0) < 6 AS INTEGER) AS county_is_sparse
FROM (SELECT DISTINCT Family, FIPS, State FROM panel) m
LEFT JOIN (SELECT Family, FIPS, sum(Sales_QTY) AS etot,
                  sum(CASE WHEN date >= CAST(tl.cutoff - INTERVAL 36 MONTH AS DATE) THEN Sales_QTY END) AS erec,
                  count(*) FILTER (WHERE Sales_QTY > 0) AS eactive
           FROM panel, tl WHERE date <= tl.cutoff GROUP BY Family, FIPS) e USING (Family, FIPS)
LEFT JOIN (SELECT Family, sum(Sales_QTY) AS ftot,
                  sum(CASE WHEN date >= CAST(tl.cutoff - INTERVAL 36 MONTH AS DATE) THEN Sales_QTY END) AS frec
           FROM panel, tl WHERE date <= tl.cutoff GROUP BY Family) f USING (Family)
LEFT JOIN (SELECT Family, State, sum(Sales_QTY) AS stot
           FROM panel, tl WHERE date <= tl.cutoff GROUP BY Family, State) s USING (Family, State)""")

register_sql("static_last", ("panel", "tl"), SQL["static"][1].replace("tl.cutoff", "tl.last_month"))
# The shares as of every month c: each month adds up the rows up to it anew.
register_sql("shares_any", ("panel",), """SELECT m.Family, m.FIPS, m.State, m.c AS as_of,
  coalesce(CASE WHEN f.ftot > 0 THEN e.etot / f.ftot END, 0.0) AS county_alltime_share,
  coalesce(CASE WHEN f.frec > 0 THEN e.erec / f.frec END, 0.0) AS county_recent_share,
  coalesce(CASE WHEN f.ftot > 0 THEN s.stot / f.ftot END, 0.0) AS state_share,
  CAST(coalesce(e.eactive, 0) AS DOUBLE) AS county_active_months,
  CAST(coalesce(e.eactive, 0) < 6 AS INTEGER) AS county_is_sparse
FROM (SELECT DISTINCT Family, FIPS, State, date AS c FROM panel) m
LEFT JOIN (SELECT c.c, p.Family, p.FIPS, sum(Sales_QTY) AS etot,
                  sum(CASE WHEN date >= CAST(c.c - INTERVAL 36 MONTH AS DATE) THEN Sales_QTY END) AS erec,
                  count(*) FILTER (WHERE Sales_QTY > 0) AS eactive
           FROM panel p JOIN (SELECT DISTINCT Family, date AS c FROM panel) c ON p.Family = c.Family AND p.date <= c.c
           GROUP BY ALL) e USING (c, Family, FIPS)
LEFT JOIN (SELECT c.c, p.Family, sum(Sales_QTY) AS ftot,
                  sum(CASE WHEN date >= CAST(c.c - INTERVAL 36 MONTH AS DATE) THEN Sales_QTY END) AS frec
           FROM panel p JOIN (SELECT DISTINCT Family, date AS c FROM panel) c ON p.Family = c.Family AND p.date <= c.c
           GROUP BY ALL) f USING (c, Family)
LEFT JOIN (SELECT c.c, p.Family, p.State, sum(Sales_QTY) AS stot
           FROM panel p JOIN (SELECT DISTINCT Family, date AS c FROM panel) c ON p.Family = c.Family AND p.date <= c.c
           GROUP BY ALL) s USING (c, Family, State)""")

# ---------------------------------------------------------------- stage 2: external tables

ZFILL = "CASE WHEN length(trim({s})) < 5 THEN lpad(trim({s}), 5, '0') ELSE trim({s}) END"

register_sql("wpiv", ("weather_long",), f"""SELECT FIPS, CAST(date_trunc('month', date) AS DATE) AS date,
  PRCP, TAVG, TMAX, TMIN FROM (
  SELECT {ZFILL.format(s='FIPS')} AS FIPS, date,
    first(value) FILTER (WHERE datatype = 'PRCP') AS PRCP,
    first(value) FILTER (WHERE datatype = 'TAVG') AS TAVG,
    first(value) FILTER (WHERE datatype = 'TMAX') AS TMAX,
    first(value) FILTER (WHERE datatype = 'TMIN') AS TMIN
  FROM weather_long GROUP BY 1, 2) p""")

_TC = "((TMAX - 32) * 5 / 9)"
_NC = "((TMIN - 32) * 5 / 9)"
_YMIN = f"(1.8 * ({_NC} - 4.4) * (1 - 0.0195 * pow({_NC} - 10, 2)))"
_YMAX = f"(3.33 * ({_TC} - 10) - 0.084 * pow({_TC} - 10, 2))"


def _clip0(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN 0.0 ELSE {x} END)"


register_sql("weather", ("wpiv",), f"""SELECT FIPS, date, PRCP, TAVG, TMAX, TMIN,
  {_clip0('TAVG - 50')} AS GDD_proxy,
  CASE WHEN TMAX IS NOT NULL AND TMIN IS NOT NULL THEN ({_clip0(_YMIN)} + {_clip0(_YMAX)}) / 2 END AS CHU_proxy,
  PRCP - avg(PRCP) OVER (PARTITION BY FIPS, month(date)) AS Precip_Anomaly,
  CAST(TAVG IS NOT NULL AS DOUBLE) AS has_temperature_data
FROM wpiv""")

CROPS = ["CORN", "COTTON", "SOYBEANS", "WHEAT", "MEDIUM", "LARGE"]

register_sql("acreage_piv", ("acreage_planted",), "SELECT year AS \"Year\", state_alpha AS State, "
             + ", ".join(f"first(Value) FILTER (WHERE commodity_desc = '{c}') AS {c}_Acres" for c in CROPS)
             + " FROM acreage_planted GROUP BY 1, 2")

register_sql("esy", ("internal",), """SELECT DISTINCT FIPS, State, CAST(year(date) AS INTEGER) AS "Year" FROM internal""")

register_sql("acreage", ("acreage_piv", "esy"), "SELECT e.FIPS, e.State, e.\"Year\", "
             + ", ".join(f"a.{c}_Acres_prior_year" for c in CROPS)
             + " FROM esy e LEFT JOIN (SELECT \"Year\", State, "
             + ", ".join(f"lag({c}_Acres, 1) OVER (PARTITION BY State ORDER BY \"Year\") AS {c}_Acres_prior_year"
                         for c in CROPS)
             + " FROM acreage_piv) a USING (State, \"Year\")")

_OVERRIDES = ", ".join(f"('{k}', '{v}')" for k, v in [
    ("09001", "Fairfield County"), ("09003", "Hartford County"), ("09005", "Litchfield County"),
    ("09007", "Middlesex County"), ("09009", "New Haven County"), ("09011", "New London County"),
    ("09013", "Tolland County"), ("09015", "Windham County"), ("12025", "Dade County")])

register_sql("names", ("county_dimension", "gazetteer"), f"""SELECT coalesce(n.FIPS, o.FIPS) AS FIPS,
  coalesce(o.nm, n.County_Name) AS County_Name
FROM (SELECT coalesce(t.FIPS, g.FIPS) AS FIPS, coalesce(t.nm, g.nm) AS County_Name
      FROM (SELECT {ZFILL.format(s='FIPS')} AS FIPS, min(County) AS nm FROM county_dimension GROUP BY 1) t
      FULL JOIN (SELECT {ZFILL.format(s='CAST(GEOID AS VARCHAR)')} AS FIPS, min(NAME) AS nm FROM gazetteer GROUP BY 1) g
      ON t.FIPS = g.FIPS) n
FULL JOIN (VALUES {_OVERRIDES}) o(FIPS, nm) ON n.FIPS = o.FIPS""")

ECON = ["CPI_AllUrban", "Fertilizer_PPI", "WTI_Oil_Price", "Cotton_Price_USCentsPerLb",
        "Corn_Price_USDPerMT", "Soybeans_Price_USDPerMT", "Wheat_Price_USDPerMT",
        "Orders_4_NOT_SPECIFIED", "Orders_5_LOW", "Medium_Price", "Large_Price"]

register_sql("econ", ("economic_macro", "crop_prices"), "SELECT coalesce(a.date, b.date) AS date, "
             + ", ".join(ECON) + " FROM economic_macro a FULL JOIN crop_prices b ON a.date = b.date")

WEATHER_COLS = ["PRCP", "TAVG", "TMAX", "TMIN", "GDD_proxy", "CHU_proxy", "Precip_Anomaly",
                "has_temperature_data"]
ACRE_COLS = [f"{c}_Acres_prior_year" for c in CROPS]
# the four crops of the reporting contract
ACRE_FACT = ["CORN_Acres_prior_year", "COTTON_Acres_prior_year", "SOYBEANS_Acres_prior_year", "WHEAT_Acres_prior_year"]
ECON_CHG = [f"{c}_{s}" for c in ECON for s in ("lag1", "chg3m")]

register_sql("merged", ("internal", "weather", "acreage", "econ"), "SELECT i.*, "
             + ", ".join(f"w.{c}" for c in WEATHER_COLS) + ", "
             + ", ".join(f"a.{c}" for c in ACRE_COLS) + ", "
             + ", ".join(f"e.{c}" for c in ECON) + ", "
             + ", ".join(f"lag(e.{c}, 1) OVER w AS {c}_lag1, e.{c} - lag(e.{c}, 3) OVER w AS {c}_chg3m"
                         for c in ECON)
             + """ FROM internal i
LEFT JOIN weather w ON i.FIPS = w.FIPS AND i.date = w.date
LEFT JOIN acreage a ON i.FIPS = a.FIPS AND CAST(year(i.date) AS INTEGER) = a."Year"
LEFT JOIN econ e ON i.date = e.date
WINDOW w AS (PARTITION BY i.Family, i.FIPS ORDER BY i.date)""")

register_sql("full_panel", ("merged", "static", "names"), """SELECT m.*, s.county_alltime_share,
  s.county_recent_share, s.state_share, s.county_active_months, s.county_is_sparse, n.County_Name
FROM merged m JOIN static s USING (Family, FIPS, State) LEFT JOIN names n USING (FIPS)""")

# ---------------------------------------------------------------- stage 3: holdout + metrics

from panelcast.operators.scoring import CHALLENGER, CHAMPION  # noqa: E402

register_sql("val", ("full_panel", "tl"), """SELECT f.* FROM full_panel f, tl
WHERE f.date >= tl.val_start AND f.date <= tl.last_month""")
register_sql("train", ("full_panel", "tl"), """SELECT f.* FROM full_panel f, tl WHERE f.date <= tl.cutoff""")

register_sql("val_pred", ("val",), f"""SELECT FIPS, County_Name, State, date, Sales_QTY AS Actual_QTY,
  greatest({CHAMPION.sql()}, 0.0) AS Predicted_QTY, Family, 'champion' AS ModelRole, '{CHAMPION.name}' AS ModelName
FROM val
UNION ALL
SELECT FIPS, County_Name, State, date, Sales_QTY AS Actual_QTY,
  greatest({CHALLENGER.sql()}, 0.0) AS Predicted_QTY, Family, 'challenger' AS ModelRole, '{CHALLENGER.name}' AS ModelName
FROM val""")

_R2 = """CASE WHEN n < 2 THEN NULL WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END
  ELSE 1 - sse / sst END"""

register_sql("nat_metrics", ("val_pred",), f"""SELECT Family, ModelRole, ModelName, {_R2} AS r2,
  sqrt(sse / n) AS rmse, sabs / n AS mae, CASE WHEN say > 0 THEN sabs / say END AS wmape,
  CAST(n AS INTEGER) AS n_months
FROM (SELECT Family, ModelRole, ModelName, count(*) AS n, sum(pow(a - p, 2)) AS sse,
             var_pop(a) * count(*) AS sst, sum(abs(a - p)) AS sabs, sum(abs(a)) AS say
      FROM (SELECT Family, ModelRole, ModelName, date, sum(Actual_QTY) AS a, sum(Predicted_QTY) AS p
            FROM val_pred GROUP BY ALL) m GROUP BY ALL) g""")

# Model registry: one version per (family, role) for each month that ends twelve months of the panel.
register_sql("reg_rows", ("full_panel", "tl", "shares_any"), """SELECT r.run_end, f.* REPLACE (
  coalesce(s.county_alltime_share, 0.0) AS county_alltime_share, coalesce(s.county_recent_share, 0.0) AS county_recent_share,
  coalesce(s.state_share, 0.0) AS state_share, coalesce(s.county_active_months, 0.0) AS county_active_months,
  coalesce(s.county_is_sparse, 1) AS county_is_sparse)
FROM full_panel f
JOIN (SELECT CAST(tl.last_month - to_months(k) AS DATE) AS run_end
      FROM tl, (SELECT min(date) AS first_month FROM full_panel) p, range(0, 10000) t(k)
      WHERE k <= date_diff('month', p.first_month, tl.last_month) - 11) r
  ON f.date <= r.run_end AND f.date >= CAST(r.run_end - INTERVAL 11 MONTH AS DATE)
LEFT JOIN shares_any s ON s.Family = f.Family AND s.FIPS = f.FIPS AND s.State = f.State
  AND s.as_of = CAST(r.run_end - INTERVAL 12 MONTH AS DATE)""")
register_sql("reg_pred", ("reg_rows",), "\nUNION ALL\n".join(
    f"""SELECT f.run_end, f.date, f.Family, f.Sales_QTY AS Actual_QTY, greatest({m.sql('f')}, 0.0) AS Predicted_QTY,
  '{role}' AS ModelRole, '{m.name}' AS ModelName
FROM reg_rows f"""
    for role, m in (("champion", CHAMPION), ("challenger", CHALLENGER))))
register_sql("registry", ("reg_pred",), f"""SELECT lower(Family) || '_' || ModelRole AS "group",
  strftime(run_end, '%Y-%m-%d') AS version, run_end AS created, ModelName, {_R2} AS r2,
  coalesce({_R2} >= 0.7, false) AS approved
FROM (SELECT run_end, Family, ModelRole, ModelName, count(*) AS n, sum(pow(a - p, 2)) AS sse,
             var_pop(a) * count(*) AS sst
      FROM (SELECT run_end, Family, ModelRole, ModelName, date, sum(Actual_QTY) AS a, sum(Predicted_QTY) AS p
            FROM reg_pred GROUP BY ALL) m GROUP BY ALL) g""")

register_sql("eval_records", ("nat_metrics", "train", "val", "tl"), """SELECT m.*, t.train_size, v.val_size,
  strftime(tl.cutoff, '%Y-%m-%d') AS train_cutoff, strftime(tl.val_start, '%Y-%m-%d') AS val_start,
  strftime(tl.last_month, '%Y-%m-%d') AS val_end
FROM nat_metrics m
LEFT JOIN (SELECT Family, count(*) AS train_size FROM train GROUP BY 1) t USING (Family)
LEFT JOIN (SELECT Family, count(*) AS val_size FROM val GROUP BY 1) v USING (Family), tl""")

register_sql("entity_acc", ("val_pred",), f"""SELECT FIPS, County_Name, State, Family, ModelRole,
  R2, WMAPE, Actual_Total, Volume_Tier, R2_Category,
  CASE WHEN Volume_Tier IN ('Near-zero', 'Low') THEN 'Directional Only (Low Volume)'
       WHEN R2_Category = 'Good' THEN 'High Confidence'
       WHEN R2_Category = 'Poor' THEN 'Moderate Confidence' ELSE 'Low Confidence' END AS Confidence_Tier
FROM (SELECT *,
  CASE WHEN Actual_Total < 10 THEN 'Near-zero' WHEN Actual_Total < 100 THEN 'Low'
       WHEN Actual_Total < 1000 THEN 'Moderate' ELSE 'Established' END AS Volume_Tier,
  CASE WHEN R2 < -1 THEN 'Edge Case' WHEN R2 < 0.3 THEN 'Poor' ELSE 'Good' END AS R2_Category
  FROM (SELECT FIPS, County_Name, State, Family, ModelRole, round({_R2}, 4) AS R2,
               round(CASE WHEN say > 0 THEN sabs / say END, 4) AS WMAPE, round(sy, 2) AS Actual_Total
        FROM (SELECT FIPS, County_Name, State, Family, ModelRole, count(*) AS n, sum(Actual_QTY) AS sy,
                     sum(pow(Actual_QTY - Predicted_QTY, 2)) AS sse, var_pop(Actual_QTY) * count(*) AS sst,
                     sum(abs(Actual_QTY - Predicted_QTY)) AS sabs, sum(abs(Actual_QTY)) AS say
              FROM val_pred
              WHERE FIPS IS NOT NULL AND County_Name IS NOT NULL AND State IS NOT NULL
                AND Family IS NOT NULL AND ModelRole IS NOT NULL
              GROUP BY ALL) g
        WHERE sy <> 0 AND n >= 2) r) t""")

# ---------------------------------------------------------------- stage 4: lookups + forecast

from panelcast.operators.forecast import RECURSIVE  # noqa: E402
from panelcast.operators.scoring import MODEL_SPEC, LinearModel  # noqa: E402

STATIC_COLS = ["county_alltime_share", "county_recent_share", "state_share",
               "county_active_months", "county_is_sparse"]
EXT_BASE = WEATHER_COLS + ACRE_COLS + ECON

register_sql("hist", ("full_panel",), """SELECT Family, FIPS, date, Sales_QTY, Returns_QTY FROM (
  SELECT *, row_number() OVER (PARTITION BY Family, FIPS ORDER BY date DESC) AS rn FROM full_panel) x
WHERE rn <= 24""")
register_sql("state", ("hist",), """SELECT Family, FIPS, list(Sales_QTY ORDER BY date) AS h,
  max(date) AS last_date, arg_max(Returns_QTY, date) AS last_returns FROM hist GROUP BY Family, FIPS""")
register_sql("bounds", ("full_panel",), """SELECT Family, FIPS, CAST(month(date) AS INTEGER) AS calendar_month,
  max(Sales_QTY) AS max_qty FROM full_panel GROUP BY ALL""")
register_sql("static_l", ("full_panel", "static_last"), "SELECT n.*, " + ", ".join(f"s.{c}" for c in STATIC_COLS)
             + """ FROM (SELECT Family, FIPS, arg_min(County_Name, date) FILTER (WHERE County_Name IS NOT NULL) AS County_Name,
  arg_min(State, date) FILTER (WHERE State IS NOT NULL) AS State FROM full_panel GROUP BY Family, FIPS) n
LEFT JOIN static_last s USING (Family, FIPS, State)""")
register_sql("nat_f", ("full_panel",), """SELECT Family, min(date) AS base_date, max(date) AS national_last_date,
  coalesce(max(CASE WHEN rd = 1 THEN s END), 0.0) AS national_lag_1,
  CASE WHEN count(*) >= 12 THEN max(CASE WHEN rd = 12 THEN s END)
       ELSE coalesce(max(CASE WHEN ru = 1 THEN s END), 0.0) END AS national_lag_12,
  coalesce(avg(CASE WHEN rd <= 3 THEN s END), 0.0) AS national_rollmean_3
FROM (SELECT Family, date, s, row_number() OVER (PARTITION BY Family ORDER BY date DESC) AS rd,
             row_number() OVER (PARTITION BY Family ORDER BY date) AS ru
      FROM (SELECT Family, date, sum(Sales_QTY) AS s FROM full_panel GROUP BY ALL) a) b
GROUP BY Family""")

register_sql("ext", ("full_panel",), "SELECT Family, FIPS, date, " + ", ".join(EXT_BASE)
             + " FROM full_panel")
register_sql("ext_fut", ("ext", "tl"), "SELECT f.Family, f.FIPS, f.date, "
             + ", ".join(f"CASE WHEN s.n_{c} >= 2 THEN s.m_{c} END AS {c}" for c in EXT_BASE)
             + """ FROM (SELECT Family, FIPS, CAST(d AS DATE) AS date FROM (
    SELECT l.Family, l.FIPS, unnest(generate_series(CAST(l.last + INTERVAL 1 MONTH AS TIMESTAMP),
                                                    CAST(tl.fc_end AS TIMESTAMP), INTERVAL 1 MONTH)) AS d
    FROM (SELECT Family, FIPS, max(date) AS last FROM ext GROUP BY ALL) l, tl WHERE l.last < tl.fc_end) g) f
LEFT JOIN (SELECT Family, FIPS, month(date) AS cm, """
             + ", ".join(f"avg({c}) AS m_{c}, count({c}) AS n_{c}" for c in EXT_BASE)
             + " FROM ext GROUP BY ALL) s ON f.Family = s.Family AND f.FIPS = s.FIPS AND month(f.date) = s.cm")
register_sql("ext_x", ("ext", "ext_fut"), "SELECT Family, FIPS, date, "
             + ", ".join(f"CASE WHEN is_extended THEN last_value({c} IGNORE NULLS) OVER w ELSE {c} END AS {c}"
                         for c in EXT_BASE)
             + """, is_extended FROM (SELECT *, false AS is_extended FROM ext
  UNION ALL BY NAME SELECT *, true AS is_extended FROM ext_fut) u
WINDOW w AS (PARTITION BY Family, FIPS ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
register_sql("ext_s", ("ext_x",), "SELECT *, "
             + ", ".join(
                 f"CASE WHEN coalesce(lag(date, 1) OVER w = date - INTERVAL 1 MONTH, false) THEN lag({c}, 1) OVER w ELSE {c} END AS {c}_lag1, "
                 f"CASE WHEN coalesce(lag(date, 3) OVER w = date - INTERVAL 3 MONTH, false) AND {c} IS NOT NULL "
                 f"THEN {c} - lag({c}, 3) OVER w ELSE 0.0 END AS {c}_chg3m" for c in ECON)
             + " FROM ext_x WINDOW w AS (PARTITION BY Family, FIPS ORDER BY date)")

_DEFAULTS = {"county_alltime_share": "0.0", "county_recent_share": "0.0", "state_share": "0.0",
             "county_active_months": "0.0", "county_is_sparse": "1"}


def serving_rows_sql(name: str, targets: str, deps: tuple[str, ...]) -> None:
    """Serving features for a targets CTE with columns (Family, FIPS, date)."""
    register_sql(name, deps + ("ext_s", "static_l", "nat_f", "bounds"), f"""SELECT *, {CAL_SQL},
  CAST(floor(date_diff('day', base_date, date) / 30) AS INTEGER) AS time_idx,
  CASE WHEN max_qty IS NULL OR max_qty = 0 THEN NULL ELSE max_qty * 1.15 END AS _hi
FROM (SELECT t.Family, t.FIPS, t.date, e.* EXCLUDE (Family, FIPS, date, is_extended),
  {", ".join(f"coalesce(st.{c}, {v}) AS {c}" for c, v in _DEFAULTS.items())},
  n.base_date, n.national_lag_1, n.national_lag_12, n.national_rollmean_3, b.max_qty
  FROM {targets} t
  LEFT JOIN ext_s e ON t.Family = e.Family AND t.FIPS = e.FIPS AND t.date = e.date
  LEFT JOIN static_l st ON t.Family = st.Family AND t.FIPS = st.FIPS
  LEFT JOIN nat_f n ON t.Family = n.Family
  LEFT JOIN bounds b ON t.Family = b.Family AND t.FIPS = b.FIPS AND month(t.date) = b.calendar_month) r""")


register_sql("targets", ("state", "tl"), """SELECT Family, FIPS, CAST(d AS DATE) AS date FROM (
  SELECT s.Family, s.FIPS, unnest(generate_series(CAST(s.last_date + INTERVAL 1 MONTH AS TIMESTAMP),
                                                  CAST(tl.fc_end AS TIMESTAMP), INTERVAL 1 MONTH)) AS d
  FROM state s, tl) g""")
serving_rows_sql("srows", "targets", ("targets",))

REC_FEATS = sorted({f for m in MODEL_SPEC.values() for f, c in m.coefs.items()
                    if f in RECURSIVE and c != 0.0})


def _fixed(m: LinearModel) -> LinearModel:
    return LinearModel(m.name, {f: c for f, c in m.coefs.items() if f not in RECURSIVE}, m.intercept)


def steps_sql(rows: str) -> str:
    parts = []
    for role, m in MODEL_SPEC.items():
        rc = ", ".join(f"{float(m.coefs.get(f, 0.0))!r} AS rc_{f}" for f in REC_FEATS)
        parts.append(f"SELECT Family, FIPS, date, _hi AS hi, '{role}' AS ModelRole, '{m.name}' AS ModelName, "
                     f"{_fixed(m).sql()} AS off" + (f", {rc}" if rc else "") + f" FROM {rows}")
    return "\nUNION ALL\n".join(parts)


register_sql("steps", ("srows",), steps_sql("srows"))


def rec_feature_sql(f: str, h: str = "r.h", ret: str = "r.ret") -> str:
    if f.startswith("fips_lag_"):
        k = int(f.rsplit("_", 1)[1])
        return f"(CASE WHEN len({h}) >= {k} THEN {h}[-{k}] ELSE 0.0 END)"
    if f == "returns_lag_1":
        return ret
    kind, w = f[len("fips_roll"):].split("_")
    tail = f"list_slice({h}, greatest(len({h}) - {w} + 1, 1), len({h}))"
    if kind == "mean":
        return f"(CASE WHEN len({h}) >= 1 THEN list_avg({tail}) ELSE 0.0 END)"
    return f"(CASE WHEN len({tail}) > 1 THEN list_stddev_samp({tail}) ELSE 0.0 END)"


def _pred_sql() -> str:
    raw = "st.off" + "".join(f" + st.rc_{f} * {rec_feature_sql(f)}" for f in REC_FEATS)
    return (f"(CASE WHEN st.hi IS NULL THEN greatest({raw}, 0.0) "
            f"ELSE least(greatest({raw}, 0.0), st.hi) END)")


register_sql("fc_rec", ("state", "steps"), f"""SELECT s.Family, s.FIPS, r.ModelRole, r.ModelName, 0, s.h,
         s.last_returns, s.last_date, CAST(NULL AS DATE), CAST(NULL AS DOUBLE)
  FROM state s JOIN (SELECT DISTINCT ModelRole, ModelName FROM steps) r ON true
  UNION ALL
  SELECT r.Family, r.FIPS, r.ModelRole, r.ModelName, r.step + 1, list_append(r.h, {_pred_sql()}), 0.0,
         r.last_date, st.date, {_pred_sql()}
  FROM fc_rec r JOIN steps st ON st.Family = r.Family AND st.FIPS = r.FIPS AND st.ModelRole = r.ModelRole
   AND st.date = CAST(r.last_date + to_months(CAST(r.step + 1 AS INTEGER)) AS DATE)""",
             recursive_columns="Family, FIPS, ModelRole, ModelName, step, h, ret, last_date, date, pred")
register_sql("fc", ("fc_rec", "tl"), """SELECT Family, FIPS, ModelRole, ModelName, date, pred AS Predicted_QTY
FROM fc_rec, tl WHERE step > 0 AND date >= tl.fc_start AND date <= tl.fc_end""")
register_sql("fc_named", ("fc", "static_l"), """SELECT fc.FIPS, s.County_Name, s.State, fc.date, fc.Predicted_QTY,
  fc.Family, upper(substr(fc.ModelRole, 1, 1)) || lower(substr(fc.ModelRole, 2)) AS ModelRole, fc.ModelName
FROM fc LEFT JOIN static_l s ON fc.Family = s.Family AND fc.FIPS = s.FIPS""")

# What-if targets: every entity six months into the horizon; history at the
# target is the recursion state one step before it.
register_sql("sc_t", ("state", "tl"), """SELECT s.Family, s.FIPS,
  CAST(tl.fc_start + INTERVAL 5 MONTH AS DATE) AS date FROM state s, tl""")
serving_rows_sql("sc_rows", "sc_t", ("sc_t",))
register_sql("sc_h", ("fc_rec", "sc_t"), """SELECT r.Family, r.FIPS, r.ModelRole, r.ModelName, r.h, r.ret
FROM fc_rec r JOIN sc_t t ON r.Family = t.Family AND r.FIPS = t.FIPS
WHERE r.step = date_diff('month', r.last_date, t.date) - 1""")
register_sql("sc_x", ("sc_rows", "sc_h"), "SELECT w.*, r.ModelRole, r.ModelName, "
             + ", ".join(f"{rec_feature_sql(f, 'r.h', 'r.ret')} AS {f}" for f in sorted(RECURSIVE))
             + " FROM sc_rows w JOIN sc_h r ON w.Family = r.Family AND w.FIPS = r.FIPS")

# ---------------------------------------------------------------- stage 5: attribution + reporting

from panelcast.functions.features import FRIENDLY_FEATURE_NAMES  # noqa: E402

CAL_NAMES = ["calendar_month", "quarter", "fiscal_month_idx", "month_sin", "month_cos", "fiscal_sin",
             "fiscal_cos", "growing_season_proxy", "is_planting_season", "is_application_season",
             "is_harvest_season", "is_dormant_season"]
FEATURES = sorted(CAL_NAMES + ["time_idx"] + sorted(RECURSIVE)
                  + ["national_lag_1", "national_lag_12", "national_rollmean_3"]
                  + WEATHER_COLS + ACRE_COLS + ECON + ECON_CHG + STATIC_COLS)
EXTERNAL = sorted(WEATHER_COLS + ACRE_COLS + ECON + ECON_CHG)
DISPLAY_EXTERNAL = sorted(WEATHER_COLS + ACRE_COLS + ECON)

register_sql("targets1", ("state", "tl"), """SELECT s.Family, s.FIPS, tl.fc_start AS date FROM state s, tl
WHERE CAST(s.last_date + INTERVAL 1 MONTH AS DATE) = tl.fc_start""")
serving_rows_sql("srows1", "targets1", ("targets1",))
register_sql("x1", ("srows1", "state"), "SELECT r.*, "
             + ", ".join(f"{rec_feature_sql(f, 's.h', 's.last_returns')} AS {f}" for f in sorted(RECURSIVE))
             + " FROM srows1 r JOIN state s ON r.Family = s.Family AND r.FIPS = s.FIPS")


def _contrib_sql() -> str:
    parts = []
    for role, m in MODEL_SPEC.items():
        cols = ", ".join(f"{float(m.coefs.get(f, 0.0))!r} * coalesce(CAST({f} AS DOUBLE), 0.0) AS {f}"
                         for f in FEATURES)
        parts.append(f"SELECT Family, FIPS, date, '{role}' AS ModelRole, '{m.name}' AS ModelName, {cols} FROM x1")
    wide = "\nUNION ALL\n".join(parts)
    return (f"SELECT Family, FIPS, date, ModelRole, ModelName, Feature, v FROM ({wide}) w "
            f"UNPIVOT (v FOR Feature IN ({', '.join(FEATURES)}))")


register_sql("contrib", ("x1",), _contrib_sql())
_EXT_LIST = ", ".join(f"'{f}'" for f in EXTERNAL)
register_sql("ranked", ("contrib",), f"""SELECT Family, FIPS, date, ModelRole, ModelName, Feature,
  round(v, 2) AS SHAP_Value, External_Factors_Share_Pct,
  row_number() OVER (PARTITION BY Family, FIPS, date, ModelRole ORDER BY round(abs(v), 9) DESC, Feature ASC) AS "Rank"
FROM (SELECT *, CASE WHEN sum(abs(v)) OVER g > 0
                     THEN round(sum(CASE WHEN Feature IN ({_EXT_LIST}) THEN abs(v) ELSE 0.0 END) OVER g
                                / sum(abs(v)) OVER g * 100, 1) ELSE 0.0 END AS External_Factors_Share_Pct
      FROM contrib WINDOW g AS (PARTITION BY Family, FIPS, date, ModelRole)) c
WHERE Feature IN ({_EXT_LIST})""")
register_sql("wide", ("ranked",), "SELECT Family, FIPS, date, ModelRole, ModelName, External_Factors_Share_Pct, "
             + ", ".join(f'max(CASE WHEN "Rank" = {i} THEN Feature END) AS Top{i}_Feature, '
                         f'max(CASE WHEN "Rank" = {i} THEN SHAP_Value END) AS Top{i}_SHAP' for i in range(1, 6))
             + ' FROM ranked WHERE "Rank" <= 5 GROUP BY ALL')
register_sql("chunk", ("fc_named", "wide"), "SELECT f.*, coalesce(w.External_Factors_Share_Pct, 0.0) AS External_Factors_Share_Pct, "
             + ", ".join(f"coalesce(w.Top{i}_Feature, '') AS Top{i}_Feature, coalesce(w.Top{i}_SHAP, 0.0) AS Top{i}_SHAP"
                         for i in range(1, 6))
             + """ FROM fc_named f LEFT JOIN wide w ON f.Family = w.Family AND f.FIPS = w.FIPS AND f.date = w.date
  AND f.ModelRole = upper(substr(w.ModelRole, 1, 1)) || lower(substr(w.ModelRole, 2))""")

_FRIENDLY = "CASE Feature " + " ".join(
    "WHEN '{}' THEN '{}'".format(k, v.replace("'", "''")) for k, v in FRIENDLY_FEATURE_NAMES.items()) + " ELSE Feature END"
_INITCAP = "upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"

register_sql("imp_county", ("ranked", "static_l"), f"""SELECT 'County' AS Level, r.FIPS, s.County_Name, s.State,
  r.Family, {_INITCAP.format(c='r.ModelRole')} AS ModelRole, r.ModelName, r.Feature,
  {_FRIENDLY.replace('Feature', 'r.Feature').replace("CASE r.Feature", "CASE r.Feature")} AS Friendly_Name,
  r.SHAP_Value, true AS Is_External, CAST(r."Rank" AS INTEGER) AS "Rank"
FROM ranked r LEFT JOIN static_l s ON r.Family = s.Family AND r.FIPS = s.FIPS""")

register_sql("top30", ("hist",), """SELECT Family, FIPS FROM (
  SELECT Family, FIPS, row_number() OVER (PARTITION BY Family ORDER BY v DESC, FIPS ASC) AS rn
  FROM (SELECT Family, FIPS, sum(Sales_QTY) AS v FROM hist GROUP BY ALL) t) r WHERE rn <= 30""")


def _national_sql() -> str:
    means = ", ".join(f"avg(coalesce(CAST({f} AS DOUBLE), 0.0)) AS {f}" for f in FEATURES)
    parts = []
    disp = set(DISPLAY_EXTERNAL)
    for role, m in MODEL_SPEC.items():
        for f in FEATURES:
            fr = FRIENDLY_FEATURE_NAMES.get(f, f).replace("'", "''")
            parts.append(
                f"SELECT 'National' AS Level, CAST(NULL AS VARCHAR) AS FIPS, CAST(NULL AS VARCHAR) AS County_Name, "
                f"CAST(NULL AS VARCHAR) AS State, Family, '{role.capitalize()}' AS ModelRole, '{m.name}' AS ModelName, "
                f"'{f}' AS Feature, '{fr}' AS Friendly_Name, "
                f"round(abs({float(m.coefs.get(f, 0.0))!r} * {f}), 4) AS SHAP_Value, "
                f"{'true' if f in disp else 'false'} AS Is_External, CAST(NULL AS INTEGER) AS \"Rank\" FROM means")
    return ("SELECT * FROM (WITH means AS (SELECT x.Family, " + means
            + " FROM x1 x SEMI JOIN top30 t ON x.Family = t.Family AND x.FIPS = t.FIPS GROUP BY x.Family) "
            + "\nUNION ALL\n".join(parts) + ") n")


register_sql("imp_national", ("x1", "top30"), _national_sql())
register_sql("imp_state", ("imp_county", "chunk", "tl"), """SELECT 'State' AS Level, CAST(NULL AS VARCHAR) AS FIPS,
  CAST(NULL AS VARCHAR) AS County_Name, State, Family, ModelRole, min(ModelName) AS ModelName, Feature,
  min(Friendly_Name) AS Friendly_Name, round(sum(SHAP_Value * w) / sum(w), 3) AS SHAP_Value,
  true AS Is_External, CAST(NULL AS INTEGER) AS "Rank"
FROM (SELECT c.*, greatest(coalesce(k.Predicted_QTY, 0.01), 0.01) AS w
      FROM imp_county c LEFT JOIN (SELECT k.* FROM chunk k, tl WHERE k.date = tl.fc_start) k
      ON c.FIPS = k.FIPS AND c.Family = k.Family AND c.ModelRole = k.ModelRole) j
GROUP BY State, Family, ModelRole, Feature""")

FORECAST_SQL = f"""WITH RECURSIVE rec(Family, FIPS, ModelRole, ModelName, step, h, ret, last_date, date, pred) AS (
  SELECT s.Family, s.FIPS, r.ModelRole, r.ModelName, 0, s.h, s.last_returns, s.last_date,
         CAST(NULL AS DATE), CAST(NULL AS DOUBLE)
  FROM state s JOIN (SELECT DISTINCT ModelRole, ModelName FROM steps) r ON true
  UNION ALL
  SELECT r.Family, r.FIPS, r.ModelRole, r.ModelName, r.step + 1, list_append(r.h, {_pred_sql()}), 0.0,
         r.last_date, st.date, {_pred_sql()}
  FROM rec r JOIN steps st ON st.Family = r.Family AND st.FIPS = r.FIPS AND st.ModelRole = r.ModelRole
   AND st.date = CAST(r.last_date + to_months(CAST(r.step + 1 AS INTEGER)) AS DATE)
)
SELECT Family, FIPS, ModelRole, ModelName, date, pred AS Predicted_QTY FROM rec, tl
WHERE step > 0 AND date >= tl.fc_start AND date <= tl.fc_end"""

LOOKUP_COLS = ["CPI_AllUrban", "Fertilizer_PPI", "Cotton_Price_USCentsPerLb", "Corn_Price_USDPerMT",
               "Soybeans_Price_USDPerMT", "Wheat_Price_USDPerMT", "WTI_Oil_Price", "PRCP", "TAVG", "TMAX",
               "TMIN", "GDD_proxy", "CHU_proxy", "Precip_Anomaly", "has_temperature_data",
               "CORN_Acres_prior_year", "COTTON_Acres_prior_year", "SOYBEANS_Acres_prior_year",
               "WHEAT_Acres_prior_year"]
W_METRICS = ["TAVG", "TMAX", "TMIN", "PRCP", "GDD_proxy", "CHU_proxy", "Precip_Anomaly"]
P_COLS = ["CPI_AllUrban", "Fertilizer_PPI", "Cotton_Price_USCentsPerLb", "Corn_Price_USDPerMT",
          "Soybeans_Price_USDPerMT", "Wheat_Price_USDPerMT", "WTI_Oil_Price"]
TOPS = [f"Top{i}_{k}" for i in range(1, 6) for k in ("Feature", "SHAP")]
_NULL_TOPS = ", ".join(f"CAST(NULL AS {'VARCHAR' if c.endswith('Feature') else 'DOUBLE'}) AS {c}" for c in TOPS)

register_sql("uweather", ("full_panel",), "SELECT * EXCLUDE (rn, Family) FROM (SELECT Family, FIPS, date, "
             + ", ".join(LOOKUP_COLS)
             + """, row_number() OVER (PARTITION BY FIPS, date
                 ORDER BY Family) AS rn FROM full_panel) x WHERE rn = 1""")
register_sql("hist_rows", ("sales", "val_pred"), f"""SELECT s.FIPS, n.County_Name, s.State, s.date, s.Family,
  r.ModelRole, CAST(NULL AS VARCHAR) AS ModelName, s."Sales QTY" AS Actual_QTY, CAST(NULL AS DOUBLE) AS Predicted_QTY,
  'Historical' AS DataType, CAST(NULL AS DOUBLE) AS External_Factors_Share_Pct, {_NULL_TOPS}
FROM sales s
LEFT JOIN (SELECT FIPS, arg_min(County_Name, date) FILTER (WHERE County_Name IS NOT NULL) AS County_Name
           FROM val_pred GROUP BY FIPS) n ON s.FIPS = n.FIPS
CROSS JOIN (VALUES ('Champion'), ('Challenger')) r(ModelRole)""")
register_sql("val_rows", ("val_pred",), f"""SELECT FIPS, County_Name, State, date, Family,
  {_INITCAP.format(c='ModelRole')} AS ModelRole, ModelName, Actual_QTY, Predicted_QTY, 'Validation' AS DataType,
  CAST(NULL AS DOUBLE) AS External_Factors_Share_Pct, {_NULL_TOPS} FROM val_pred""")
register_sql("fc_rows", ("chunk",), """SELECT FIPS, County_Name, State, date, Family, ModelRole, ModelName,
  CAST(NULL AS DOUBLE) AS Actual_QTY, Predicted_QTY, 'Forecast' AS DataType, External_Factors_Share_Pct, """
             + ", ".join(TOPS) + " FROM chunk")
register_sql("fact_full", ("hist_rows", "val_rows", "fc_rows", "uweather", "static_l", "bounds"), """SELECT f.*, """
             + ", ".join(f"w.{c}" for c in LOOKUP_COLS) + ", "
             + ", ".join(f"s.{c}" for c in STATIC_COLS) + """, b.max_qty
FROM (SELECT u.*, CAST(month(u.date) AS INTEGER) AS calendar_month FROM (
        SELECT * FROM hist_rows UNION ALL BY NAME SELECT * FROM val_rows UNION ALL BY NAME SELECT * FROM fc_rows) u) f
LEFT JOIN uweather w ON f.FIPS = w.FIPS AND f.date = w.date
LEFT JOIN static_l s ON f.FIPS = s.FIPS AND f.Family = s.Family
LEFT JOIN bounds b ON f.FIPS = b.FIPS AND f.Family = b.Family AND f.calendar_month = b.calendar_month""")
register_sql("ff_last", ("fact_full",), "SELECT max(date) AS last FROM fact_full WHERE DataType = 'Validation'")
register_sql("ff_hist", ("fact_full", "ff_last"), "SELECT f.* FROM fact_full f, ff_last WHERE f.date <= ff_last.last")
register_sql("ff_fut", ("fact_full", "ff_last", "ff_hist"), "SELECT f.* REPLACE ("
             + ", ".join(f"coalesce(f.{c}, entity.{c}, everywhere.{c}) AS {c}" for c in W_METRICS) + ", "
             + ", ".join(f"coalesce(f.{c}, price.{c}) AS {c}" for c in P_COLS)
             + """) FROM (SELECT f.* FROM fact_full f, ff_last WHERE f.date > ff_last.last) f
LEFT JOIN (SELECT FIPS, calendar_month, """ + ", ".join(f"avg({c}) AS {c}" for c in W_METRICS)
             + """ FROM ff_hist, ff_last WHERE date >= ff_last.last - INTERVAL 120 MONTH GROUP BY FIPS, calendar_month) entity
  ON f.FIPS = entity.FIPS AND f.calendar_month = entity.calendar_month
LEFT JOIN (SELECT calendar_month, """ + ", ".join(f"avg({c}) AS {c}" for c in W_METRICS)
             + """ FROM ff_hist, ff_last WHERE date >= ff_last.last - INTERVAL 120 MONTH GROUP BY calendar_month) everywhere
  ON f.calendar_month = everywhere.calendar_month
LEFT JOIN (SELECT calendar_month, """ + ", ".join(f"avg({c}) AS {c}" for c in P_COLS)
             + """ FROM ff_hist, ff_last WHERE date >= ff_last.last - INTERVAL 12 MONTH GROUP BY calendar_month) price
  ON f.calendar_month = price.calendar_month""")
register_sql("ff", ("ff_hist", "ff_fut"), "SELECT * EXCLUDE (has_temperature_data) REPLACE ("
             + ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in ACRE_FACT)
             + """) FROM (SELECT * FROM ff_hist UNION ALL BY NAME SELECT * FROM ff_fut) u
WINDOW w AS (PARTITION BY FIPS, Family ORDER BY date, DataType, ModelRole
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

FF_COLS = (["FIPS", "County_Name", "State", "date", "Family", "ModelRole", "ModelName", "Actual_QTY",
            "Predicted_QTY", "DataType", "External_Factors_Share_Pct"] + TOPS + ["calendar_month"]
           + [c for c in LOOKUP_COLS if c != "has_temperature_data"] + STATIC_COLS + ["max_qty"])
register_sql("null_profile", ("ff",), """SELECT "column", null_count, round(null_count * 100.0 / n, 1) AS null_pct,
  CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY null_count DESC, "column" ASC) AS rank FROM (
    WITH a AS (SELECT count(*) AS n, """
             + ", ".join(f"count(*) - count({c}) AS nn_{i}" for i, c in enumerate(FF_COLS))
             + " FROM ff) "
             + " UNION ALL ".join(f"SELECT n, '{c}' AS \"column\", nn_{i} AS null_count FROM a"
                                  for i, c in enumerate(FF_COLS))
             + ") b) c WHERE rank <= 10")

# ---------------------------------------------------------------- fitted ridge

# Rows in long form, their standardised values (population std; a constant column is 0), the normal equations with the
# penalty 1 on the diagonal as a list of rows, and their elimination column by column.
_RX = [*FEATURES, "Sales_QTY"]
_K = len(FEATURES)
register_sql("ridge_long", ("train",), "SELECT Family, rid, j, v FROM (SELECT Family, row_number() OVER () AS rid, unnest(["
             + ", ".join(f"coalesce(CAST({f} AS DOUBLE), 0.0)" for f in _RX) + f"]) AS v, unnest(range(1, {_K + 2})) AS j FROM train) u")
register_sql("ridge_stat", ("ridge_long",), "SELECT Family, j, avg(v) AS mean, stddev_pop(v) AS sd FROM ridge_long GROUP BY ALL")
register_sql("ridge_z", ("ridge_long", "ridge_stat"), f"""SELECT l.Family, l.rid, l.j,
  CASE WHEN s.sd > 0 THEN (l.v - s.mean) / CASE WHEN l.j <= {_K} THEN s.sd ELSE 1.0 END ELSE 0.0 END AS z
FROM ridge_long l JOIN ridge_stat s USING (Family, j)""")
register_sql("ridge_gram", ("ridge_z",), f"""SELECT a.Family, a.j AS i, b.j AS j,
  sum(a.z * b.z) + max(CASE WHEN a.j = b.j THEN 1.0 ELSE 0.0 END) AS g
FROM ridge_z a JOIN ridge_z b ON a.Family = b.Family AND a.rid = b.rid AND a.j <= {_K} GROUP BY ALL""")
register_sql("ridge_rows", ("ridge_gram",), """SELECT Family, list(line ORDER BY i) AS m
FROM (SELECT Family, i, list(g ORDER BY j) AS line FROM ridge_gram GROUP BY Family, i) r GROUP BY Family""")
register_sql("ridge_elim", ("ridge_rows",), f"""SELECT Family, 1, m FROM ridge_rows
  UNION ALL
  SELECT Family, k + 1, list_transform(m, lambda line, i: CASE WHEN i = k THEN line
    ELSE list_transform(line, lambda x, j: x - line[k] * m[k][j] / m[k][k]) END)
  FROM ridge_elim WHERE k <= {_K}""", recursive_columns="Family, k, m")
register_sql("ridge_w", ("ridge_elim", "ridge_stat"), f"""SELECT e.Family, e.j, CASE WHEN s.sd > 0 THEN e.w / s.sd ELSE 0.0 END AS coef, s.mean
FROM (SELECT Family, unnest(range(1, {_K + 1})) AS j,
             unnest(list_transform(range(1, {_K + 1}), lambda j: m[j][{_K + 1}] / m[j][j])) AS w
      FROM ridge_elim WHERE k = {_K + 1}) e
JOIN ridge_stat s USING (Family, j)""")
register_sql("ridge_coef", ("ridge_w", "ridge_stat"), "SELECT Family, (["
             + ", ".join(f"'{f}'" for f in FEATURES) + f"""])[j] AS Feature, coef FROM ridge_w
UNION ALL
SELECT w.Family, '(intercept)', s.mean - sum(w.coef * w.mean) FROM ridge_w w JOIN ridge_stat s ON s.Family = w.Family AND s.j = {_K + 1}
GROUP BY w.Family, s.mean""")
register_sql("ridge_wide", ("ridge_coef",), "SELECT Family, max(coef) FILTER (WHERE Feature = '(intercept)') AS c0, "
             + ", ".join(f"max(coef) FILTER (WHERE Feature = '{f}') AS c_{f}" for f in FEATURES) + " FROM ridge_coef GROUP BY Family")


def _ridge_sum(row: str, features) -> str:
    return " + ".join(["c.c0", *(f"c.c_{f} * coalesce(CAST({row}.{f} AS DOUBLE), 0.0)" for f in features)])


register_sql("ridge_pred", ("val", "ridge_wide"), f"""SELECT v.FIPS, v.County_Name, v.State, v.date, v.Sales_QTY AS Actual_QTY,
  greatest({_ridge_sum('v', FEATURES)}, 0.0) AS Predicted_QTY, v.Family, 'challenger' AS ModelRole, 'Ridge' AS ModelName
FROM val v JOIN ridge_wide c USING (Family)""")
register_sql("ridge_metrics", ("ridge_pred",), SQL["nat_metrics"][1].replace("val_pred", "ridge_pred"))
register_sql("ridge_records", ("ridge_metrics", "train", "val", "tl"), SQL["eval_records"][1].replace("nat_metrics", "ridge_metrics"))
_RIDGE_REC = sorted(RECURSIVE)
register_sql("ridge_steps", ("srows", "ridge_wide"), f"""SELECT s.Family, s.FIPS, s.date, s._hi AS hi,
  {_ridge_sum('s', [f for f in FEATURES if f not in RECURSIVE])} AS off, {", ".join(f"c.c_{f} AS rc_{f}" for f in _RIDGE_REC)}
FROM srows s JOIN ridge_wide c USING (Family)""")
_RIDGE_RAW = "st.off" + "".join(f" + st.rc_{f} * {rec_feature_sql(f)}" for f in _RIDGE_REC)
_RIDGE_PRED = f"(CASE WHEN st.hi IS NULL THEN greatest({_RIDGE_RAW}, 0.0) ELSE least(greatest({_RIDGE_RAW}, 0.0), st.hi) END)"
register_sql("ridge_rec", ("state", "ridge_steps"), f"""SELECT s.Family, s.FIPS, 0, s.h, s.last_returns, s.last_date, CAST(NULL AS DATE), CAST(NULL AS DOUBLE)
  FROM state s
  UNION ALL
  SELECT r.Family, r.FIPS, r.step + 1, list_append(r.h, {_RIDGE_PRED}), 0.0, r.last_date, st.date, {_RIDGE_PRED}
  FROM ridge_rec r JOIN ridge_steps st ON st.Family = r.Family AND st.FIPS = r.FIPS
   AND st.date = CAST(r.last_date + to_months(CAST(r.step + 1 AS INTEGER)) AS DATE)""",
             recursive_columns="Family, FIPS, step, h, ret, last_date, date, pred")
register_sql("ridge_fc", ("ridge_rec", "tl"), """SELECT Family, FIPS, 'challenger' AS ModelRole, 'Ridge' AS ModelName, date, pred AS Predicted_QTY
FROM ridge_rec, tl WHERE step > 0 AND date >= tl.fc_start AND date <= tl.fc_end""")
