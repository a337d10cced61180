"""Dates and times. Nothing here reads the clock: reference dates are arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(c: Column) -> Column:
    """A day from text that starts with yyyy-mm-dd or dd/mm/yyyy; null for anything else."""
    t = F.trim(c.cast("string"))
    iso = F.regexp_extract(t, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    day_first = F.regexp_extract(t, r"^([0-9]{2}/[0-9]{2}/[0-9]{4})", 1)
    return F.coalesce(F.try_to_date(F.nullif(iso, F.lit("")), "yyyy-MM-dd"), F.try_to_date(F.nullif(day_first, F.lit("")), "dd/MM/yyyy"))


def day_in_text(c: Column) -> Column:
    """The first dd/mm/yyyy, dd.mm.yyyy, dd-mm-yyyy or yyyy-mm-dd inside a text, for titles."""
    t = c.cast("string")
    d = F.regexp_extract(t, r"([0-9]{2})[/.-]([0-9]{2})[/.-]([0-9]{4})", 0)
    iso = F.regexp_extract(t, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return F.coalesce(F.try_to_date(F.nullif(F.translate(d, ".-", "//"), F.lit("")), "dd/MM/yyyy"), F.try_to_date(F.nullif(iso, F.lit("")), "yyyy-MM-dd"))


def local_moment(c: Column, hours_behind_utc: int = 3) -> Column:
    """UTC time of ``dd/mm/yyyy [hh:mm[:ss]]`` written in a fixed zone (X14). Without a time it is midnight there."""
    t = c.cast("string")
    date = F.regexp_extract(t, r"([0-9]{2}/[0-9]{2}/[0-9]{4})", 1)
    time = F.regexp_extract(t, r"[0-9]{4}\D+([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)", 1)
    full = F.when(time == "", "00:00:00").when(F.length(time) <= 5, F.concat(F.lpad(time, 5, "0"), F.lit(":00"))).otherwise(F.lpad(time, 8, "0"))
    moment = F.try_to_timestamp(F.concat(F.nullif(date, F.lit("")), F.lit(" "), full), F.lit("dd/MM/yyyy HH:mm:ss"))
    return moment + F.expr(f"INTERVAL {hours_behind_utc} HOURS")


def safe_moment(c: Column) -> Column:
    """A timestamp, or null where the text is none."""
    return F.try_to_timestamp(c.cast("string"))


def age_days(day: Column, reference: Column) -> Column:
    """Whole days from a day to the reference."""
    return F.datediff(reference, day)


def delay_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two times, rounded down."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000)).cast("long")


def add_years(day: Column, years: int) -> Column:
    """The same day some years on; 29 February becomes the 28th."""
    return F.add_months(day, 12 * years)


def months_until(reference: Column, deadline: Column) -> Column:
    """Months from the reference to a deadline, begun months counting whole, never below 0; null without a deadline."""
    whole = (F.year(deadline) - F.year(reference)) * 12 + F.month(deadline) - F.month(reference)
    months = whole + F.when(F.dayofmonth(deadline) > F.dayofmonth(reference), 1).otherwise(0)
    return F.when(months.isNotNull(), F.greatest(months, F.lit(0)))


def window_floor(reference: Column, days: int) -> Column:
    """First day of a window of ``days`` before the reference; null (no window) for 0."""
    return F.date_sub(reference, days) if days else F.lit(None).cast("date")
