"""Calendar expressions on zone-free dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import pad_left


def week_block(day: Column) -> Column:
    """Seven-day blocks counted from January 1 (not the ISO week)."""
    return (F.floor((F.dayofyear(day) - 1) / 7) + 1).cast("int")


def weekday_zero(day: Column) -> Column:
    """Weekday 0-6, Sunday is 0."""
    return F.dayofweek(day) - 1


def weekday_text(day: Column) -> Column:
    """H9: weekday 1-7 as text, Sunday is 1."""
    return F.dayofweek(day).cast("string")


def month_text(day: Column) -> Column:
    """Two-digit month."""
    return F.date_format(day, "MM")


def date_of_year_day(year: Column, day_of_year: Column) -> Column:
    """Year and day-of-year to a date; a day the year does not have gives NULL."""
    text = F.concat(
        year.cast("string"), F.lit("-"), pad_left(day_of_year.cast("string"), 3)
    )
    return F.try_to_timestamp(text, F.lit("yyyy-DDD")).cast("date")


def is_major_holiday(day: Column) -> Column:
    """Seven major US holidays on their actual (unshifted) date, decided by rule."""
    month, number, weekday = F.month(day), F.dayofmonth(day), F.dayofweek(day)
    fixed_day = (
        ((month == 1) & (number == 1))
        | ((month == 7) & (number == 4))
        | ((month == 12) & (number == 25))
    )
    monday, thursday = weekday == 2, weekday == 5
    floating = (
        ((month == 1) & monday & number.between(15, 21))
        | ((month == 5) & monday & (number >= 25))
        | ((month == 9) & monday & (number <= 7))
        | ((month == 11) & thursday & number.between(22, 28))
    )
    return fixed_day | floating
