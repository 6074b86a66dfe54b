"""Dates, calendar parts, ages and event distances. All clocks are UTC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Halving dates, market cycle ends, bar lengths, weekday names.
HALVING_DATES = ("2020-05-11", "2024-04-20", "2028-03-26")
NO_EVENT_AHEAD = 999
MARKET_CYCLES = (
    ("2018-12-31", "2017-2018 Bull & Bear"),
    ("2021-12-31", "2019-2021 Cycle"),
    ("2023-12-31", "2022-2023 Bear"),
)
LAST_CYCLE = "2024-2026 Bull"
BAR_LENGTHS = {
    "1m": "1 minute",
    "5m": "5 minutes",
    "15m": "15 minutes",
    "1h": "1 hour",
    "4h": "4 hours",
    "1d": "1 day",
}
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
MINUTES_PER_BLOCK = 10


def epoch_date(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds))


def bar_start(ts: Column, bar: str) -> Column:
    return F.window(ts, BAR_LENGTHS[bar]).getField("start")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Hour, minute, weekday (Monday 0) and weekend flag."""
    weekday = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "day_of_week": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
    }


def slot_label(weekday: Column, hour: Column) -> Column:
    """Label such as ``Fri 11:00``."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    return F.concat(F.element_at(names, (weekday + 1).cast("int")), F.lit(" "),
                    F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def cycle_label(date: Column, cycles: Sequence[tuple[str, str]] = MARKET_CYCLES,
                last: str = LAST_CYCLE) -> Column:
    """Market regime whose inclusive last day is the first one not before ``date``."""
    label = F.lit(last)
    for end, name in reversed(list(cycles)):
        label = F.when(date <= F.lit(dt.date.fromisoformat(end)), name).otherwise(label)
    return label


def days_to_next(date: Column, events: Sequence[str] = HALVING_DATES,
                 none_ahead: int = NO_EVENT_AHEAD) -> Column:
    """Days to the nearest event strictly after ``date``."""
    gaps = F.array(*[F.datediff(F.lit(dt.date.fromisoformat(e)), date) for e in events])
    return F.coalesce(F.array_min(F.filter(gaps, lambda d: d > 0)), F.lit(none_ahead))


def age_days(block_seconds: Column, as_of_seconds: Column) -> Column:
    """Age from real block time at an explicit reference time."""
    return (as_of_seconds - block_seconds) / F.lit(86_400.0)


def age_days_from_height(height: Column, tip: Column) -> Column:
    """Approximate age, ten minutes per block."""
    return (tip - height) * MINUTES_PER_BLOCK / F.lit(1_440.0)


def age_years_from_height(height: Column, tip: Column) -> Column:
    return age_days_from_height(height, tip) / F.lit(365.0)
