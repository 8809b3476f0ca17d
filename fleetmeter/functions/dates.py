"""Driver-side date parameters: plain Python, evaluated once per job."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

# The reporting zone and the first day of usage history.
REPORT_TZ = "Asia/Tokyo"
FIRST_HISTORY_DAY = dt.date(2024, 10, 25)


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def monday(day: str | dt.date) -> dt.date:
    day = as_date(day)
    return day - dt.timedelta(days=day.weekday())


def yesterday(now: dt.datetime, tz: str = REPORT_TZ) -> dt.date:
    """The last complete day in ``tz`` at the aware instant ``now``."""
    return now.astimezone(ZoneInfo(tz)).date() - dt.timedelta(days=1)


def utc_midnight(day: dt.date, tz: str = REPORT_TZ) -> dt.datetime:
    """The start of a local day, as zone-naive UTC."""
    local = dt.datetime.combine(day, dt.time(), ZoneInfo(tz))
    return local.astimezone(dt.UTC).replace(tzinfo=None)


def previous_week(end: str | dt.date) -> tuple[dt.date, dt.date]:
    """The ISO week before the one ``end`` is in, as ``[Monday, next Monday)``."""
    stop = monday(end)
    return stop - dt.timedelta(days=7), stop


def last_complete_week_end(target: str | dt.date) -> dt.date:
    """The Saturday that closes the last Sunday-to-Saturday week before ``target``'s Monday."""
    return monday(target) - dt.timedelta(days=2)


def report_range(
    start: str | dt.date | None,
    end: str | dt.date | None,
    last_day: dt.date,
) -> tuple[dt.date, dt.date]:
    """Fill in missing bounds and check their order.

    Neither bound given means ``last_day`` alone; only ``end`` given means the
    whole history up to it; only ``start`` given means up to ``last_day``.
    """
    if end is None:
        first = last_day if start is None else as_date(start)
        last = last_day
    else:
        first = FIRST_HISTORY_DAY if start is None else as_date(start)
        last = as_date(end)
    if first > last:
        raise ValueError("the report range is empty: it starts after its end")
    return first, last
