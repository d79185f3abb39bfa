"""Fiscal label parsing (fiscal year starts in October)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper-case month names in calendar order (January = 1).
MONTH_NAMES = ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY",
               "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"]
FISCAL_START_MONTH = 10


def _month_map() -> Column:
    pairs = []
    for i, name in enumerate(MONTH_NAMES, start=1):
        pairs += [F.lit(name), F.lit(i)]
    return F.create_map(*pairs)


def fiscal_year(label: Column) -> Column:
    """``'F2014' -> 2014``; malformed labels become null (no ANSI error)."""
    return F.regexp_replace(label.cast("string"), "F", "").try_cast("int")


def month_number(name: Column, case_sensitive: bool = True) -> Column:
    """Month name -> 1..12, null when unknown.

    The raw sales scan matches names exactly; the reporting conversion
    upper-cases first (``case_sensitive=False``).
    """
    key = name if case_sensitive else F.upper(F.trim(name))
    return F.try_element_at(_month_map(), key)


def calendar_year(fy: Column, month: Column) -> Column:
    """Fiscal year -> calendar year: months October..December belong to fy-1."""
    return F.when(month >= FISCAL_START_MONTH, fy - 1).otherwise(fy)


def fiscal_to_date(label: Column, month_name: Column, case_sensitive: bool = True) -> Column:
    """``('F2014', 'OCTOBER') -> 2013-10-01`` as DATE (null if unparseable)."""
    fy = fiscal_year(label)
    m = month_number(month_name, case_sensitive)
    return F.make_date(calendar_year(fy, m), m, F.lit(1))


def fiscal_label(d: Column) -> Column:
    """DATE -> fiscal label ``'F2014'`` (inverse of :func:`fiscal_year`)."""
    fy = F.year(d) + F.when(F.month(d) >= FISCAL_START_MONTH, 1).otherwise(0)
    return F.concat(F.lit("F"), fy.cast("string"))


def month_name(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(d))
