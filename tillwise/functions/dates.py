"""Column expressions that rebuild a day-month-year string as ISO.

The raw date is ``dd?MM?yyyy HH:mm`` with any one-character separator and
maybe padded by spaces; plain casts give null on it.  The repair slices the
trimmed string by position.  ``try_`` forms keep a malformed value as null
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(s: Column):
    t = F.trim(s)
    return F.substring(t, 7, 4), F.substring(t, 4, 2), F.substring(t, 1, 2), F.substring(t, 12, 5)


def repair_date(s: Column, formats: list[str] | None = None) -> Column:
    """Date from the sliced string.  ``formats`` (Spark datetime patterns,
    tried in order on the trimmed string) rescue values the positional
    slicing cannot read, such as ``12/1/2010 8:26`` with ``M/d/yyyy H:mm``."""
    year, month, day, _ = _parts(s)
    out = F.try_to_date(F.concat(year, F.lit("-"), month, F.lit("-"), day))
    for fmt in formats or []:
        out = F.coalesce(out, F.to_date(F.try_to_timestamp(F.trim(s), F.lit(fmt))))
    return out


def repair_timestamp(s: Column, formats: list[str] | None = None) -> Column:
    """Wall-clock timestamp (``timestamp_ntz``).

    The ISO string is cast straight to ``timestamp_ntz`` -- no session time
    zone is involved, so a wall-clock time inside a daylight-saving gap is
    kept as written.  Fallback formats parse through the session zone.
    """
    year, month, day, hhmm = _parts(s)
    iso = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), hhmm, F.lit(":00"))
    out = iso.try_cast("timestamp_ntz")
    for fmt in formats or []:
        out = F.coalesce(out, F.try_to_timestamp(F.trim(s), F.lit(fmt)).cast("timestamp_ntz"))
    return out


def month_start(d: Column) -> Column:
    """``DATE_TRUNC('month', d)`` of a date, as a wall-clock timestamp (the
    first of the month at midnight, whatever the session time zone)."""
    return F.trunc(d, "month").cast("timestamp_ntz")
