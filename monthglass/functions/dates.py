"""Date expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tried in turn after ISO text; a day and month written with slashes is month first.
DATE_FORMATS = ("M/d/yyyy", "yyyy/M/d", "yyyyMMdd", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text to timestamp: ISO first, then the formats; NULL where none fits."""
    text = F.trim(c)
    return F.coalesce(text.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def months_between_calendar(later: Column, earlier: Column) -> Column:
    """Whole calendar months, days ignored."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def plus_months(c: Column, months: int) -> Column:
    """Same day ``months`` later, cut to the month's end; the time of day is kept."""
    return c + F.make_ym_interval(F.lit(0), F.lit(months))


def month_label(c: Column) -> Column:
    """``yyyy-MM``; a missing date is filed under ``NaT``."""
    return F.coalesce(F.date_format(c, "yyyy-MM"), F.lit("NaT"))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Full 24-hour days between two instants."""
    return F.timestamp_diff("DAY", earlier, later)
