"""Helpers shared by registered queries: timeline scalars, rounding."""

from __future__ import annotations

from dataclasses import dataclass
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType

DIGITS = 6


def _scale_round(x, k: int):
    """Round half away from zero by scaling in double arithmetic (as DuckDB does)."""
    p = float(10 ** k)
    return F.when(x >= 0, F.floor(x * p + 0.5)).otherwise(-F.floor(-x * p + 0.5)) / p


def present(x, digits: int = DIGITS):
    """Two-stage rounding: to digits+3 (drops summation-order noise), then to digits."""
    return _scale_round(_scale_round(x, digits + 3), digits) + F.lit(0.0)  # -0.0 -> 0.0


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Presentation step of a registered query: doubles rounded, dates as ``yyyy-MM-dd``."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType):
            c = present(c, digits)
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)


def rsql(*cols: str, digits: int = DIGITS) -> str:
    """``round(c, 6) AS c, ...`` for an oracle select list."""
    return ", ".join(f"round(round({c}, {digits + 3}), {digits}) + 0.0 AS {c}" for c in cols)


def fin(sql: str, doubles=(), dates=("date",), digits: int = DIGITS) -> str:
    """Wrap an oracle statement with the same presentation as :func:`rounded`."""
    rep = [f"round(round({c}, {digits + 3}), {digits}) + 0.0 AS {c}" for c in doubles] + \
          [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    if not rep:
        return sql
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql}\n) _q"


@dataclass(frozen=True)
class Timeline:
    """Cutoffs of one panel: last actual month, training cutoff, validation and forecast."""
    first: dt.date
    last: dt.date
    holdout_months: int = 12
    horizon: int = 24

    @staticmethod
    def add_months(d: dt.date, k: int) -> dt.date:
        y, m = divmod(d.year * 12 + (d.month - 1) + k, 12)
        return dt.date(y, m + 1, 1)

    @property
    def train_cutoff(self) -> dt.date:
        return self.add_months(self.last, -self.holdout_months)

    @property
    def val_start(self) -> dt.date:
        return self.add_months(self.train_cutoff, 1)

    @property
    def val_end(self) -> dt.date:
        return self.last

    @property
    def forecast_start(self) -> dt.date:
        return self.add_months(self.last, 1)

    @property
    def forecast_end(self) -> dt.date:
        return self.add_months(self.last, self.horizon)


def timeline(sales: DataFrame, month: str = "date", **kw) -> Timeline:
    """Scalar min / max month of a table (one small aggregate action)."""
    row = sales.agg(F.min(month).alias("a"), F.max(month).alias("b")).first()
    return Timeline(row["a"], row["b"], **kw)
