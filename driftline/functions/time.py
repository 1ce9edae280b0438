"""Days and minutes since the epoch, in UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MAX = 65_535


def seconds(ts) -> Column:
    """Epoch seconds of a timestamp without zone, read as UTC whatever the session's zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60 + F.second(c)


def day_of_seconds(secs: str) -> Column:
    """Epoch day; truncates toward zero."""
    return F.expr(f"cast({secs} div 86400 as int)")


def minute_of_seconds(secs: str) -> Column:
    """Epoch minute; truncates toward zero."""
    return F.expr(f"{secs} div 60")


def day_of_minute(minute: str = "minute") -> Column:
    return F.expr(f"cast({minute} div 1440 as int)")


def checked_day(day: Column) -> Column:
    """The day, or an error outside 0..65535."""
    return F.when((day >= 0) & (day <= DAY_MAX), day).otherwise(F.raise_error(F.concat(F.lit("day out of range: "), day.cast("string"))))


def date_of_day(day) -> Column:
    return F.date_from_unix_date(day)


def year_of_day(day) -> Column:
    return F.year(F.date_from_unix_date(day))


def month_of_day(day) -> Column:
    return F.month(F.date_from_unix_date(day))


def iso_date(day) -> Column:
    """YYYY-MM-DD."""
    return F.date_format(F.date_from_unix_date(day), "yyyy-MM-dd")


def day_of_iso(text) -> Column:
    return F.unix_date(F.to_date(text))


def epoch_day(text: str) -> int:
    return (dt.date.fromisoformat(text) - dt.date(1970, 1, 1)).days


def day_key(day: int) -> str:
    return (dt.date(1970, 1, 1) + dt.timedelta(days=day)).isoformat()


def months_in_range(first: str, last: str) -> list[str]:
    """YYYY-MM of each month that the range touches."""
    a, b = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(a.year * 12 + a.month - 1, b.year * 12 + b.month)]


def default_window(last: str, months: int = 4) -> tuple[str, str]:
    """The range of ``months`` calendar months that ends with the month of ``last``."""
    b = dt.date.fromisoformat(last)
    m = b.year * 12 + b.month - months
    return dt.date(m // 12, m % 12 + 1, 1).isoformat(), last
