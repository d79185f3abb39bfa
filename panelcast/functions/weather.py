"""Agronomic proxies from Fahrenheit temperatures; null-safe clips."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_lower0(x: Column) -> Column:
    """``max(x, 0)`` that keeps null (``greatest(null, 0)`` would give 0)."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def gdd_proxy(tavg: Column) -> Column:
    return clip_lower0(tavg - 50)


def chu_proxy(tmax: Column, tmin: Column) -> Column:
    """Crop heat units from daily max/min in F; null unless both are present."""
    tc = (tmax - 32) * 5 / 9
    nc = (tmin - 32) * 5 / 9
    ymin = clip_lower0(F.lit(1.8) * (nc - 4.4) * (1 - F.lit(0.0195) * F.pow(nc - 10, 2)))
    ymax = clip_lower0(F.lit(3.33) * (tc - 10) - F.lit(0.084) * F.pow(tc - 10, 2))
    return F.when(tmax.isNotNull() & tmin.isNotNull(), (ymin + ymax) / 2)


def presence_flag(x: Column) -> Column:
    return x.isNotNull().cast("double")


def tolerant_number(text: Column) -> Column:
    """``'1,200' -> 1200.0``; marks such as ``'(D)'`` become null (no ANSI error)."""
    return F.regexp_replace(text.cast("string"), ",", "").try_cast("double")
