"""Dates, windows and clocks as Column expressions.  Every clock is a parameter (as_of)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/New_York"


def et_date(ts: Column, zone: str = ZONE) -> Column:
    """Calendar day of a UTC time in the zone that days are cut by."""
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), zone))


def days_before(as_of: Column, n: int, zone: str = ZONE) -> Column:
    return F.date_sub(et_date(as_of, zone), n)


def next_day(day: Column) -> Column:
    """F51."""
    return F.date_add(day, 1)


def window_dates(as_of: Column, n: int, zone: str = ZONE) -> Column:
    """The last n days, oldest first, today included."""
    return F.sequence(days_before(as_of, n - 1, zone), et_date(as_of, zone))


def in_window(ts: Column, as_of: Column, n: int, today: bool = True, zone: str = ZONE) -> Column:
    """P10: Whether a time lies on one of the last n days, with or without today."""
    day, now = et_date(ts, zone), et_date(as_of, zone)
    return day.between(F.date_sub(now, n - 1), now) if today else day.between(F.date_sub(now, n), F.date_sub(now, 1))


def age_seconds(ts: Column, as_of: Column) -> Column:
    return F.unix_micros(as_of.cast("timestamp")) / 1e6 - F.unix_micros(ts.cast("timestamp")) / 1e6


def within_hours(ts: Column, as_of: Column, hours: int, future: bool = False) -> Column:
    """Younger than so many hours; times after as_of count only with future."""
    age = age_seconds(ts, as_of)
    return (age < hours * 3600) & (F.lit(True) if future else age >= 0)


def minutes_since(ts: Column, as_of: Column) -> Column:
    """F57."""
    return F.floor(age_seconds(ts, as_of) / 60).cast("bigint")


def lifecycle(last: Column, as_of: Column) -> Column:
    """active up to 12 quiet hours, monitoring up to 36, then resolved."""
    quiet = age_seconds(last, as_of)
    return F.when(quiet <= 12 * 3600, "active").when(quiet <= 36 * 3600, "monitoring").otherwise("resolved")


def congress_at(day: Column) -> Column:
    """Number of the congress that sits on a day; it changes on 3 January of odd years."""
    year = F.year(day) - F.when((F.year(day) % 2 == 1) & (F.dayofyear(day) < 3), 1).otherwise(0)
    return F.floor((year - 1789) / 2).cast("int") + 1


def parse_date(text: Column) -> Column:
    """ISO 8601, RFC 822 or a bare day; null for anything else."""
    zoned = F.regexp_replace(F.regexp_replace(F.trim(text), r"(?i)\s*(GMT|UTC|UT|Z)$", " +0000"), r"\s*\+0000$", " +0000")
    tries = [(zoned, f) for f in ("EEE, d MMM yyyy HH:mm:ss xx", "EEE, d MMM yyyy HH:mm xx", "d MMM yyyy HH:mm:ss xx", "yyyy-MM-dd'T'HH:mm:ss xx", "yyyy-MM-dd'T'HH:mm:ss.SSS xx")]
    iso = F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.trim(text)))
    # weekday names add nothing, and the parser rejects wrong ones
    return F.coalesce(iso, *[F.try_to_timestamp(F.regexp_replace(c, r"^[A-Za-z]{3}, ", "") if "EEE" in f else c, F.lit(f.replace("EEE, ", ""))) for c, f in tries])


def clock_valid(text: Column) -> Column:
    """A time that names its zone."""
    return text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$") & F.try_to_timestamp(F.regexp_replace(text, r"(T\d{2}:\d{2})(Z|[+-])", "$1:00$2")).isNotNull()


def date_valid(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull()


def et_when(ts: Column, pattern: str = "MMM d, h:mm a") -> Column:
    """F52, F58."""
    return F.date_format(F.from_utc_timestamp(ts.cast("timestamp"), ZONE), pattern)
