"""Date differences that count crossed boundaries, not elapsed time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed from start to end; NULL if either side is NULL."""
    return F.datediff(F.to_date(end), F.to_date(start))


def _full_minute(ts: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def minutes_between(start: Column, end: Column) -> Column:
    """Full-minute marks crossed from start to end.

    Subtracting wall-clock times gives an interval, so the session time zone
    plays no part (a cast to an instant would, around clock changes).
    """
    gap = _full_minute(end) - _full_minute(start)

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), gap)

    return (part("DAY") * 1440 + part("HOUR") * 60 + part("MINUTE")).cast("int")


def since_days(ts: Column, now: Column, days: int) -> Column:
    """True for timestamps in the last ``days`` days before ``now``."""
    return ts >= now - F.make_dt_interval(F.lit(days))
