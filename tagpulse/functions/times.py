"""Epoch seconds, calendar periods and the stamps used in row keys."""

from __future__ import annotations

READABLE = "yyyy-MM-dd HH:mm:ss"

# period -> (calendar unit, stamp format in row keys)
PERIODS = {
    "hourly": ("hour", "yyyyMMddHH"),
    "daily": ("day", "yyyyMMdd"),
    "monthly": ("month", "yyyyMM"),
}

# Seconds of 0001-01-01 and 9999-12-31 23:59:59; outside them there is no calendar date.
_FIRST, _LAST = -62135596800, 253402300799


def event_time(seconds: str) -> str:
    """Epoch seconds as a timestamp, null when out of range.

    Direct, not through text: a text round trip loses an hour where clocks go back.
    """
    return f"CASE WHEN {seconds} BETWEEN {_FIRST} AND {_LAST} THEN timestamp_seconds({seconds}) END"


def readable(seconds: str) -> str:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in the session zone.

    Null gives '', a number that is no date its digits.
    """
    return (
        f"coalesce(date_format({event_time(seconds)}, '{READABLE}'), "
        f"CAST({seconds} AS STRING), '')"
    )


def readable_text(seconds: str) -> str:
    """Like :func:`readable` for text input; text that is no number stays as it is."""
    number = f"try_cast({seconds} AS BIGINT)"
    return f"coalesce(date_format({event_time(number)}, '{READABLE}'), {seconds}, '')"


def stamp(period: str, timestamp: str) -> str:
    return f"date_format({timestamp}, '{PERIODS[period][1]}')"
