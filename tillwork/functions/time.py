"""Business days, windows, lenient parsing, zones and durations.

``as_of`` is always an argument; nothing here reads the wall clock except ``run_stamp``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import as_col

# The trading day starts at 09:00 in this zone.
BUSINESS_ZONE = "Asia/Kolkata"
CUTOFF_HOUR = 9


@dataclass(frozen=True)
class Period:
    """A named closed interval of local wall-clock time."""

    name: str
    start: datetime
    end: datetime

    def shifted(self, name: str, days: int) -> Period:
        return Period(name, self.start - timedelta(days=days), self.end - timedelta(days=days))

    def contains(self, ts: Column | str) -> Column:
        return as_col(ts).between(ntz(self.start), ntz(self.end))


def ntz(value: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S.%f}'")


def report_day(as_of: date) -> date:
    """The reported day is the day before ``as_of``."""
    return as_of - timedelta(days=1)


def month_bounds(day: date) -> tuple[date, date]:
    return day.replace(day=1), day


def month_days(day: date) -> list[date]:
    first, last = month_bounds(day)
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def month_sequence(day: Column | str) -> Column:
    """Every day from the first of the month to ``day``."""
    day = as_col(day)
    return F.sequence(F.trunc(day, "MM"), day)


def in_month_to(day_col: Column | str, day: date) -> Column:
    first, last = month_bounds(day)
    return as_col(day_col).between(F.lit(first), F.lit(last))


def business_day(local_ts: Column | str, cutoff_hour: int = CUTOFF_HOUR) -> Column:
    """Trading day of a local time: before the cutoff it is still the previous day."""
    return F.to_date(as_col(local_ts) - F.expr(f"INTERVAL '{int(cutoff_hour)}' HOUR"))


def business_periods(
    as_of: datetime, cutoff_hour: int = CUTOFF_HOUR, shifts: Sequence[tuple[str, int]] = (("LW", 7), ("L2W", 14))
) -> list[Period]:
    """CURRENT from the cutoff of the business day to ``as_of``, and the same window shifted back."""
    day = as_of.date() if as_of.hour >= cutoff_hour else as_of.date() - timedelta(days=1)
    current = Period("CURRENT", datetime.combine(day, time(cutoff_hour)), as_of)
    return [current] + [current.shifted(name, days) for name, days in shifts]


def period_days(periods: Sequence[Period], cutoff_hour: int = CUTOFF_HOUR) -> list[date]:
    """The business days the windows touch: the day partitions a report has to read."""
    days = set()
    for p in periods:
        first, last = ((t - timedelta(hours=cutoff_hour)).date() for t in (p.start, p.end))
        days |= {first + timedelta(days=i) for i in range((last - first).days + 1)}
    return sorted(days)


def tag_period(df: DataFrame, ts: str, periods: Sequence[Period], name: str = "period") -> DataFrame:
    """Keep rows inside any window and name the window.

    The union of ranges is a plain filter on the time column, so it reaches the scan.
    Disjoint windows use a CASE; overlapping ones repeat the row once per window.
    """
    keep = periods[0].contains(ts)
    for p in periods[1:]:
        keep = keep | p.contains(ts)
    df = df.filter(keep)
    ordered = sorted(periods, key=lambda p: p.start)
    if all(a.end < b.start for a, b in zip(ordered, ordered[1:])):
        chain = None
        for p in periods:
            chain = F.when(p.contains(ts), p.name) if chain is None else chain.when(p.contains(ts), p.name)
        return df.withColumn(name, chain)
    hits = F.array_compact(F.array(*[F.when(p.contains(ts), F.lit(p.name)) for p in periods]))
    return df.withColumn(name, F.explode(hits))


def parse_ts(x: Column | str) -> Column:
    """Lenient wall-clock parse: unreadable text becomes NULL."""
    return as_col(x).try_cast("timestamp_ntz")


def parse_utc(x: Column | str) -> Column:
    """Text to UTC wall clock: an offset is applied, text without one already is UTC."""
    text = F.trim(as_col(x).cast("string"))
    shifted = F.convert_timezone(None, F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.contains(":"), shifted).otherwise(
        text.try_cast("timestamp_ntz")
    )


def utc_to_zone(utc: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_col(utc))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from start to end as a double, independent of the session zone."""
    span = (as_col(end).cast("timestamp_ntz") - as_col(start).cast("timestamp_ntz")).cast("interval second")
    return span.cast("decimal(18,6)").cast("double") / 60.0


def month_label(x: Column | str) -> Column:
    return F.date_format(as_col(x), "yyyy-MM")


def day_label(x: Column | str) -> Column:
    return F.date_format(as_col(x), "dd-MM-yyyy")


def window_label(start: Column | str, end: Column | str) -> Column:
    """09:00 AM - 05:30 PM"""
    return F.concat_ws(" - ", F.date_format(as_col(start), "hh:mm a"), F.date_format(as_col(end), "hh:mm a"))


def run_stamp() -> Column:
    return F.current_timestamp()
