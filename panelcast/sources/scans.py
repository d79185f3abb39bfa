"""File scans with declared schemas: the raw inputs, the serving lookups and the feature panel.

Ids are text in every schema, so leading zeros survive; dates are parsed by the
reader; headers are matched after trimming. Nothing is inferred, so a scan never
reads a file twice and columns that are not asked for are never parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.functions.calendar import month_start
from panelcast.functions.ids import normalize_id
from panelcast.sources.sinks import require_columns

# Columns of the input files and their types.
SCHEMAS = {
    "weather": "FIPS string, date date, datatype string, value double",
    "acreage": "year int, state_alpha string, commodity_desc string, statisticcat_desc string, Value string",
    "gazetteer": "GEOID string, NAME string",
    "county_dimension": "FIPS string, County string",
    "sales": "Year string, Month string, FIPS string, State string, Family string, `Sales QTY` double, `Returns/Credits QTY` double",
}
LOOKUPS = ("history", "national", "static", "external", "bounds")


def read_delimited(spark: SparkSession, path: str, name: str, sep: str = ",") -> DataFrame:
    """A file of :data:`SCHEMAS` with a header, whose names may be padded and in any order."""
    wanted = StructType.fromDDL(SCHEMAS[name])
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    require_columns(raw, wanted.names)
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted])


def read_series(spark: SparkSession, path: str, date_col: str = "date", sep: str = ",") -> DataFrame:
    """Monthly series as found: every column but the date is a number, dates become month starts."""
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    require_columns(raw, [date_col])
    return raw.select(month_start(F.col(date_col)).alias("date"),
                      *[F.col(f"`{c}`").try_cast("double").alias(c) for c in raw.columns if c != date_col])


def read_panel(spark: SparkSession, path: str, features: list[str] | None = None) -> DataFrame:
    """The written feature panel: month-start dates, normalised ids, flags as numbers, features in their stored order."""
    panel = spark.read.parquet(path)
    require_columns(panel, ["FIPS", "Family", "date", *(features or [])])
    flags = [f.name for f in panel.schema if f.dataType.simpleString() == "boolean"]
    panel = panel.withColumns({"date": month_start(F.col("date")), "FIPS": normalize_id(F.col("FIPS")),
                               **{c: F.col(c).cast("int") for c in flags}})
    if features is None:
        return panel
    rest = [c for c in panel.columns if c not in set(features)]
    return panel.select(*rest, *features)


def read_features(spark: SparkSession, path: str) -> list[str]:
    """The feature list as it was written: the order in which a model takes its columns."""
    return list(spark.read.schema("features array<string>").json(path).first()["features"])


def read_lookups(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The five serving lookups; all that are missing are named at once."""
    gone = [n for n in LOOKUPS if f"lookup_{n}" not in paths]
    if gone:
        raise KeyError(f"lookups not written: {gone}")
    return {n: spark.read.parquet(paths[f"lookup_{n}"]) for n in LOOKUPS}
