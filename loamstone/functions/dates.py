"""Days, weeks, business days and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(text: Column) -> Column:
    """The day a date text names as written: any zone is dropped, not converted. Null where no form fits."""
    t = F.trim(text)
    iso = F.regexp_extract(t, r"^(\d{4})[-_/](\d{2})[-_/](\d{2})", 0)
    us = F.regexp_extract(t, r"^(\d{1,2}/\d{1,2}/\d{4})", 1)
    return F.coalesce(F.try_to_date(F.regexp_replace(iso, "[_/]", "-"), "yyyy-MM-dd"), F.try_to_date(us, "M/d/yyyy"))


def business_days(a: Column, b: Column) -> Column:
    """Weekdays from the earlier day up to, not including, the later one: arithmetic on whole weeks, no sequence."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    span = F.datediff(hi, lo)
    first = F.weekday(lo)  # Monday is 0
    rest = span % 7
    # of the days after the whole weeks, those that fall on days 5 and 6 are no business days
    weekend = F.greatest(F.lit(0), F.least(first + rest, F.lit(7)) - F.greatest(first, F.lit(5))) + F.greatest(F.lit(0), first + rest - 12)
    return (F.floor(span / 7) * 5 + rest - weekend).cast("int")


def week_start(day: Column) -> Column:
    """The Monday of the day's week."""
    return F.date_sub(day, F.weekday(day))


def age_hours(instant: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(instant)) / 3_600_000_000


def linear_decay(age: Column, full: float, missing: float = 0.0) -> Column:
    """100 at age 0 or less, 0 from `full` on; `missing` for null ages."""
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 * (1 - age / full))), F.lit(missing))
