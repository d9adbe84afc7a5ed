"""Dates kept as text in two spellings, and the three ways of computing an age."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FIRST = "dd-MM-yyyy"


def _two_digits(part: Column) -> Column:
    return F.when(F.length(part) < 2, F.concat(F.lit("0"), part)).otherwise(part)


def day_first_text(value: Column) -> Column:
    """Rewrite ``M/d/yyyy`` text as ``dd-MM-yyyy``; text without a slash is kept.

    Already padded parts stay as they are.  The year is copied, so a two-digit
    year survives here and is rejected by :func:`parse_day`.
    """
    parts = F.split(value, "/")
    month, day, year = (F.get(parts, F.lit(i)) for i in range(3))
    return F.when(
        value.contains("/"),
        F.concat(_two_digits(day), F.lit("-"), _two_digits(month), F.lit("-"), year),
    ).otherwise(value)


def parse_day(value: Column) -> Column:
    """``dd-MM-yyyy`` text as a date, NULL where it is none."""
    return F.try_to_date(value, DAY_FIRST)


def day_or_today(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def age_by_calendar_year(dob: Column, as_of: dt.date | None = None) -> Column:
    """Difference of the two year numbers."""
    return F.year(day_or_today(as_of)) - F.year(parse_day(dob))


def age_in_full_years(dob: Column, as_of: dt.date | None = None) -> Column:
    """Birthdays passed."""
    return F.timestamp_diff("YEAR", parse_day(dob), day_or_today(as_of)).cast("int")


def age_in_365_days(dob: Column, as_of: dt.date | None = None) -> Column:
    """Whole blocks of 365 days, which runs ahead of the birthdays by the leap days."""
    return (F.datediff(day_or_today(as_of), parse_day(dob)) / 365).cast("int")
