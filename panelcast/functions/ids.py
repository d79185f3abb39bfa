"""Entity-id normalisation (county FIPS style: 5 characters, zero padded)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_WIDTH = 5


def normalize_id(raw: Column, width: int = ID_WIDTH) -> Column:
    """Strip blanks, drop one trailing ``.0``, left-pad with zeros to ``width``.

    Never truncates: ``lpad`` cuts longer strings, so it only applies to
    shorter ones. Null stays null (callers reject such rows, see
    :func:`id_error`).
    """
    s = F.regexp_replace(F.trim(raw.cast("string")), r"\.0$", "")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def id_error(raw: Column) -> Column:
    """Reason string when an id cannot be normalised, else null."""
    return F.when(raw.isNull() | (F.trim(raw.cast("string")) == ""), F.lit("id is required"))
