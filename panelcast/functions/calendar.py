"""Calendar features of a month-start DATE column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season membership by calendar month.
PLANTING_MONTHS = [3, 4, 5]
APPLICATION_MONTHS = [4, 5, 6, 7, 8]
HARVEST_MONTHS = [9, 10, 11]
DORMANT_MONTHS = [12, 1, 2]

CALENDAR_FEATURES = ["calendar_month", "quarter", "fiscal_month_idx", "month_sin", "month_cos",
                     "fiscal_sin", "fiscal_cos", "growing_season_proxy", "is_planting_season",
                     "is_application_season", "is_harvest_season", "is_dormant_season"]


def month_start(d: Column) -> Column:
    """Any date/timestamp -> first day of its month as DATE."""
    return F.trunc(F.to_date(d), "month")


def next_month(d: Column, k: int | Column = 1) -> Column:
    return F.add_months(F.trunc(d, "month"), k)


def fiscal_month_index(m: Column) -> Column:
    # pmod, not %: SQL remainder keeps the sign of the dividend.
    return F.pmod(m - 10, F.lit(12)) + 1


def calendar_columns(d: Column) -> dict[str, Column]:
    """The twelve calendar features, keyed by output name."""
    m = F.month(d)
    fm = fiscal_month_index(m)
    two_pi = 2 * math.pi
    return {
        "calendar_month": m.cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "fiscal_month_idx": fm.cast("int"),
        "month_sin": F.sin(m * two_pi / 12),
        "month_cos": F.cos(m * two_pi / 12),
        "fiscal_sin": F.sin(fm * two_pi / 12),
        "fiscal_cos": F.cos(fm * two_pi / 12),
        # sin is never null here, so greatest() cannot invent a value
        "growing_season_proxy": F.greatest(F.sin((m - 3) * math.pi / 7), F.lit(0.0)),
        "is_planting_season": m.isin(PLANTING_MONTHS).cast("int"),
        "is_application_season": m.isin(APPLICATION_MONTHS).cast("int"),
        "is_harvest_season": m.isin(HARVEST_MONTHS).cast("int"),
        "is_dormant_season": m.isin(DORMANT_MONTHS).cast("int"),
    }


def time_index(d: Column, base: Column) -> Column:
    """Whole 30-day periods since ``base`` (not a month index)."""
    return F.floor(F.datediff(d, base) / 30).cast("int")


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")
