"""Time bucketing and period labels (truncate, parse, format)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The grains the pipeline knows, finest first, and the label
# pattern each grain is written with ("quarter" is built as "<year> Q<n>").
GRAINS = ("hour", "day", "month", "quarter")
LABEL_PATTERNS = {
    "hour": "yyyy-MM-dd HH:mm:ss",
    "day": "yyyy-MM-dd",
    "month": "yyyy-MM",
}
# Output column holding the label of each grain.
LABEL_COLUMNS = {"hour": "datetime", "day": "date", "month": "month", "quarter": "quarter"}


def check_grain(grain: str) -> str:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    return grain


def coarser_or_equal(fine: str, coarse: str) -> bool:
    return GRAINS.index(check_grain(coarse)) >= GRAINS.index(check_grain(fine))


def as_timestamp(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Any stamp column as ``timestamp_ntz``.

    Strings go through ``try_to_timestamp`` (a malformed stamp becomes null
    instead of failing the job under ANSI mode); zoned timestamps are read in
    the session zone, which ``session.settings`` pins to UTC.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.StringType):
        c = F.try_to_timestamp(c)
    return c.cast(T.TimestampNTZType())


def bucket(col: Column | str, grain: str) -> Column:
    """Start of the hour/day/month/quarter holding ``col``, as ``timestamp_ntz``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc(check_grain(grain), c).cast(T.TimestampNTZType())


def period_label(col: Column | str, grain: str) -> Column:
    """Text label of a bucket start: ``2024-10-01 09:00:00``, ``2024-10-01``,
    ``2024-10`` or ``2024 Q4``."""
    c = F.col(col) if isinstance(col, str) else col
    if check_grain(grain) == "quarter":
        return F.concat(F.year(c).cast("string"), F.lit(" Q"), F.quarter(c).cast("string"))
    return F.date_format(c, LABEL_PATTERNS[grain])
